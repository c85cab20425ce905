"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass looks at each
block alone: blocks inside boilerplate elements (by tag, or by the words of
their class, id and role) and blocks made of links are bad; headings and long
blocks are good if they hold many stop words, where an article element halves
what is asked; what is short or holds too few stays open. Never is more asked
than half of what the page's own long blocks hold together: stop words are
known for some languages only, and a page without any is judged by length and
links alone. A letter of a script without spaces counts as three. The second
pass gives open blocks the label of the nearest decided block, ties to the one
before; a long block without links looks past boilerplate elements. In an
article that is the nearest in the same article, past boilerplate elements; if
none is decided there, its open blocks are good. Good blocks are joined by a
line feed.

The parser reads a page in linear time, however deep or unclosed: where the
last open element of each name stands is kept, and an element is taken off the
stack once.

Markup is read leniently: unclosed and stray tags, a page cut off inside a
tag, entities without an end. Scripts, styles and comments are skipped whole.

Defined results: NULL, empty and text-free pages give an empty text. A page
without any tag is one block. Whole pages are read; each row for itself.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

# Element names and words of the markup language's use, and common words of nine languages.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
 noscript ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg math object canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAGS = frozenset("""aside button datalist dialog fieldset footer form head header label menu nav optgroup option
 select""".split())
BAD_WORDS = frozenset("""ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs byline comment
 comments consent contentinfo cookie cookies copyright dialog disqus footer form gdpr header legal login masthead menu
 modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted promotion related replies
 reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget
 widgets""".split())
GOOD_WORDS = frozenset("article articlebody post story entry".split())
STOP_WORDS = frozenset("""a an and are as at be by for from have he in is it of on or that the this to was with which you
 der die das und ist in von zu den mit für auf ein eine im dem nicht als auch es an
 le la les de des et un une est que dans pour qui sur pas au aux ce il elle
 el los las del y en no se por con para su una lo más como mi
 di che è il gli della per sono non ma anche nel alla dei questo
 o os as do da em um uma que não com mais foi pelo também
 het een van dat zijn niet aan met voor hij maar om ook deze
 w z i na się nie do jest to że jak po oraz kiedy będzie
 и в не на что с как по это из но для был когда всем""".split())

LONG = 70
LINKS = 0.4
STOPS = 0.1
#: what stands in an article needs less
STOPS_IN_ARTICLE = 0.05

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[^\W\d_]+")
_NO_SPACES = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_LISTS = ("ul", "ol", "dl", "table", "select")
_CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                  "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    linked: int
    bad: bool
    article: bool
    heading: bool
    part: int       # number of the outermost article element it stands in


def _role(tag: str, attributes: str, in_article: bool) -> bool | None:
    """Whether an element is an article's (True), boilerplate (False) or neither (None)."""
    if tag in BAD_TAGS and not (tag == "header" and in_article):
        return False
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.strip("\"'").lower() == "true":
            return False
        if name in ("class", "id", "role", "itemprop"):
            words.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
            words.update(re.split(r"[^a-z]+", value.lower()))
    if words & BAD_WORDS and tag not in ("html", "body"):
        return False
    if tag in ("article", "main") or tag in ("div", "section") and words & GOOD_WORDS:
        return True
    return None


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order."""
    out: list[Block] = []
    open_tags: list[tuple[str, bool, bool, bool]] = []      # name, inside boilerplate, inside an article, by its words
    places: dict[str, list[int]] = defaultdict(list)        # where open elements of a name stand
    block_places: list[int] = []                            # where open block elements stand
    open_headings = 0
    parts: list[str] = []
    linked, in_link, heading = 0, 0, False
    bad = article = named = False
    part = 0

    def end_block() -> None:
        nonlocal linked, parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, linked, bad, article, heading, part))
        parts, linked = [], 0

    def back_to(depth: int) -> None:
        nonlocal bad, article, named, in_link, heading, open_headings
        while len(open_tags) > depth:
            name = open_tags.pop()[0]
            places[name].pop()
            if name in BLOCK_TAGS:
                block_places.pop()
            open_headings -= name in HEADINGS
        _, bad, article, named = open_tags[-1] if open_tags else ("", False, False, False)
        in_link, heading = bool(places["a"]), open_headings > 0

    def last(names) -> int:
        return max((places[n][-1] for n in names if places[n]), default=-1)

    def text(chunk: str) -> None:
        nonlocal linked
        if chunk:
            parts.append(chunk)
            if in_link:
                linked += len("".join(chunk.split()))

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag == "br":
            parts.append(" ")
            continue
        if closing:
            depth = last((tag,))
            if tag in BLOCK_TAGS:
                end_block()
            if depth >= 0 and (tag in BLOCK_TAGS or not block_places or block_places[-1] < depth):
                back_to(depth)
            continue
        if tag in RAW_TAGS and not attributes.endswith("/"):
            if tag in BLOCK_TAGS:
                end_block()
            shut = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(page, at)
            at = shut.end() if shut else len(page)
            continue
        if tag in VOID_TAGS:
            if tag in BLOCK_TAGS:
                end_block()
            continue
        if tag in BLOCK_TAGS:
            end_block()
            if places["p"]:
                back_to(places["p"][-1])
            closed = last(_CLOSES_ITSELF.get(tag, ()))
            if closed > last(_LISTS):
                back_to(closed)
        role = _role(tag, attributes, article)
        inner_bad, inner_article = bad or role is False, article or role is True
        inner_named = named or role is False and tag not in BAD_TAGS
        if tag in ("article", "main") and role and not article and not named:
            inner_bad = False       # an article begins anew after an unclosed menu, not among comments
        if attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        part += inner_article and not article
        places[tag].append(len(open_tags))
        if tag in BLOCK_TAGS:
            block_places.append(len(open_tags))
        open_headings += tag in HEADINGS
        open_tags.append((tag, inner_bad, inner_article, inner_named))
        bad, article, named = inner_bad, inner_article, inner_named
        in_link, heading = in_link or tag == "a", heading or tag in HEADINGS
    end_block()
    return out


def _linked(block: Block) -> float:
    """The share of a block's letters in links."""
    return block.linked / (len("".join(block.text.split())) or 1)


def _long(text: str) -> bool:
    return len(text) + 2 * len(_NO_SPACES.findall(text)) >= LONG


def _stops(texts: list[str]) -> float:
    """The share of stop words among words."""
    words = [w for t in texts for w in _WORD.findall(t.lower())]
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _first_pass(block: Block, page: float) -> bool | None:
    """Good, bad, or None where the block alone doesn't tell; ``page`` is the stop word share of the page's long blocks."""
    if block.bad or _linked(block) > LINKS:
        return False
    if block.heading and block.article:
        return True
    if _long(block.text):
        return True if _stops([block.text]) >= min(STOPS_IN_ARTICLE if block.article else STOPS, page / 2) else None
    return None


def _nearest(first: list[bool | None], part: list[int] | None = None) -> list[list[tuple[int, int, bool]]]:
    """For each place the nearest decided ones before and after it, of its own part: (distance, side, label)."""
    out: list[list[tuple[int, int, bool]]] = [[] for _ in first]
    for side, places in enumerate((range(len(first)), range(len(first) - 1, -1, -1))):
        last = None
        for i in places:
            if last is not None and part and part[last] != part[i]:
                last = None
            if first[i] is not None:
                last = i
            elif last is not None:
                out[i].append((abs(i - last), side, first[last]))
    return out


def main_text(page: str | None) -> str:
    """The good blocks' texts, joined by line feeds."""
    found = blocks(page or "")
    page_stops = _stops([b.text for b in found if not b.bad and _linked(b) <= LINKS and _long(b.text)])
    first = [_first_pass(b, page_stops) for b in found]
    around = _nearest(first)
    # a long block without links is no menu or footer, whatever stands beside it
    plain = _nearest([None if b.bad else v for b, v in zip(found, first)])
    # boilerplate elements inside an article are no part of its flow, so its open blocks look past them
    flow = [i for i, b in enumerate(found) if b.article and not b.bad]
    inside = dict(zip(flow, _nearest([first[i] for i in flow], [found[i].part for i in flow])))
    keep = []
    for i, (block, v) in enumerate(zip(found, first)):
        if v is None:
            own = plain if not block.linked and _long(block.text) else around
            sides = inside[i] if i in inside else own[i]
            v = min(sides)[-1] if sides else True
        if v:
            keep.append(block.text)
    return "\n".join(keep)


def extract(spark: SparkSession, page: Column) -> Column:
    """A column with the main text of each page."""
    importable(spark)

    @F.pandas_udf("string")
    def made(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return made(page)
