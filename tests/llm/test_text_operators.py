"""BPE, HTML extraction, language identification and quality against references and on odd input."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsgrid.llm import bpe, html_extract, langid, quality
from obsgrid.llm.common import fold, table
from tests.conftest import SF01

P = pytest.importorskip("public_tokenizers")

ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "x"), (4, "x"), (5, "12 34 !!"), (6, "naı̈ve \U0001f600 é\x00\x1c\x85"),
       (7, "word " * 60000), (8, "a" * 50000), (None, "no id")]


def odd(spark):
    """Rows with NULLs, empty and long texts, repeats, and columns that clash with results."""
    return spark.createDataFrame(ODD, "doc_id long, text string").select(
        "*", F.lit("z").alias("score"), F.lit(1).alias("lang_pred"), F.lit("en").alias("lang"), F.lit(2).alias("n_tokens"))


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN, leaf_bytes=1, leaf_chars=4)


@pytest.fixture(scope="module")
def reference(codec):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_bpe_tree_equals_plain_encoding(codec, reference):
    rng = random.Random(4)
    signs = list("abeiorst AB019 '.,!?\n\t\r\x0b\x85   lé中한½😀aaaa    ") + ["'s", "'re", "'ll", "'ve", "ing", "the"]
    for _ in range(3000):
        some = rng.sample(signs, rng.choice([3, 8, len(signs)]))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))
        ids = np.frombuffer(codec.encode(text), dtype="<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, " " * 9000 + "x", "é" * 9000, "!?" * 9000])
def test_bpe_long_matches(codec, reference, text):
    assert np.frombuffer(codec.encode(text), dtype="<u4").tolist() == reference.encode_ordinary(text)


def test_bpe_columns(spark, reference):
    path = P.path("byte_bpe_50k.tiktoken")
    docs = odd(spark)
    rows = docs.select("doc_id", "text", bpe.digests(spark, path, P.PATTERN, F.col("text")).alias("d")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert r.d.n_tokens == len(ids)
        assert r.d.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = docs.withColumn("back", bpe.decode(spark, path, P.PATTERN, bpe.encode(spark, path, P.PATTERN, F.col("text"))))
    assert all(bytes(r.back) == (r.text or "").encode() for r in back.collect())
    assert docs.limit(0).select(bpe.digests(spark, path, P.PATTERN, F.col("text"))).count() == 0


def test_trigram_counts_over_slices(monkeypatch):
    text = "Zwölf Boxkämpfer, 12 jagen Viktor. " * 20
    whole = langid.trigram_counts(text)
    monkeypatch.setattr(langid, "SLICE", 7)
    sliced = langid.trigram_counts(text)
    assert whole[0].tolist() == sliced[0].tolist() and whole[1].tolist() == sliced[1].tolist()


def test_bundles_are_sums_of_bound_vectors():
    codes, n = langid.trigram_counts("the thin thing")
    expected = sum(k * langid.trigram_vectors(np.array([c]))[0].astype(float) for c, k in zip(codes, n))
    for most in (2, 5, 1000):
        got = langid._Bundler(most).bundle([(codes, n), (codes[:1], n[:1])])
        assert np.allclose(got[0], expected)


def test_languages_held_out(spark):
    docs = table(spark, SF01, "documents").withColumn("held", fold(F.col("doc_id"), 4) == 2)
    model = langid.learn(docs.where("NOT held"))
    rows = docs.where("held").select("lang", langid.predict(spark, model, F.col("text")).alias("p")).collect()
    assert np.mean([r.lang == r.p.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.p.score <= 1 for r in rows)


def test_languages_odd_input(spark):
    docs = odd(spark)
    model = langid.learn(docs.where("text IS NULL OR doc_id > 3"))
    got = docs.select("text", "score", langid.predict(spark, model, F.col("text")).alias("p")).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert (r.p.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert langid.learn(docs.limit(0)) == {}
    nothing = docs.select(langid.predict(spark, {}, F.col("text")).alias("p")).collect()
    assert all(tuple(r.p) == ("und", 0.0) for r in nothing)


def test_quality_held_out(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    model = quality.fit(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    held = docs.join(labels.where(fold(F.col("doc_id"), 5) == 0), "doc_id")
    rows = held.select("quality", quality.score(spark, model, F.col("text")).alias("s")).collect()
    assert np.mean([(r.s >= 0.3) == (r.quality == 1) for r in rows]) > 0.95


def test_quality_features_over_slices(monkeypatch):
    text = "One two, three!! four " * 50
    whole = quality.features(text)
    monkeypatch.setattr(quality, "SLICE", 64)
    assert set(whole) - set(range(len(quality.REPEATS))) == set(quality.features(text)) - set(range(len(quality.REPEATS)))


def test_quality_odd_input(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (5, None), (None, 1), (7, 1), (8, 9), (99, 0)],
                                   "doc_id long, quality int")
    for kept in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.fit(docs, kept)
        rows = docs.select(quality.score(spark, model, F.col("text")).alias("s")).collect()
        assert len(rows) == len(ODD) and all(0 <= r.s <= 1 for r in rows)
    assert quality.fit(docs, labels.limit(0)).score(quality.features("x")) == pytest.approx(0.5)


def test_quality_fits_one_row_for_each_id(spark, monkeypatch):
    rows = [(i, ("good words here " if i % 2 else "bad junk there ") + str(i)) for i in range(20)]
    again = [rows[3]] * 30 + [(4, None), (4, "bad other text"), (4, "")] * 10
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    came = []
    monkeypatch.setattr(quality, "fit_rows_model", lambda found, labels: came.append([r.tolist() for r in found]))
    for some in (rows + again, again + rows):
        quality.fit(spark.createDataFrame(some, "doc_id long, text string").repartition(5), labels, fit_rows=12)
    assert len(came[0]) == 12 and came[0] == came[1]


def test_dual_descent_separates():
    rng = np.random.default_rng(3)
    rows = [np.unique(np.concatenate([rng.integers(10, 400, 20), [k]])).astype(np.int32) for k in (5, 6) * 60]
    labels = np.array([1, 0] * 60)
    model = quality.fit_rows_model(rows, labels)
    assert all((model.score(r) > 0.5) == bool(v) for r, v in zip(rows, labels))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><div>Site name</div></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies on this site and you may accept them all or none of them as you wish.</div>
<article class="post"><h1>The title</h1><p>First &amp; best   paragraph<br>goes on, with a <a href="/x">link</a>.
<p>Second<table><tr><td>cell one<td>cell two</table><aside>Side box</aside><form><label>Mail</label><input></form>
<div class="ad">Buy now</div><p>Short.</p></article>
<section id="comments"><article class="comment"><p>A reader says that this is all wrong and that it was better before.</p>
</article></section><footer>&copy; the site and its owners and all that is in it"""


def test_main_text_of_a_page():
    assert html_extract.main_text(PAGE) == "\n".join(
        ["The title", "First & best paragraph goes on, with a link.", "Second", "cell one", "cell two", "Short."])


def test_main_text_without_article():
    page = ("<body><div><a href=1>one</a> <a href=2>two</a></div><div>" + "the sea and the land and the sky of it " * 4
            + "</div><div>Short tail</div><div class=footer>end</div>")
    assert html_extract.main_text(page).split("\n") == [("the sea and the land and the sky of it " * 4).strip(), "Short tail"]


def test_body_beside_an_article_teaser():
    long = "The sea and the land and the sky of it are what we have for the day. " * 3
    page = ("<body><nav><a href=1>Home</a></nav><article><h2>Read next</h2><p>A teaser.</p></article>"
            f"<div><p>{long}</p><p>Short one.</p><p>Another short one.</p><p>{long}</p></div><footer>The end</footer>")
    assert html_extract.main_text(page).split("\n") == ["Read next", "A teaser.", long.strip(), "Short one.", "Another short one.", long.strip()]


def test_density_and_neighbours_decide_in_an_article():
    long = "The sea and the land and the sky of it are what we have for the day. " * 3
    codes = "SKU-1 4711 blue cotton XL warehouse pallet shelf container barcode voucher " * 2
    page = (f"<body><article><p>{long}</p><p>Short.</p><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li>{codes}</li>"
            "<li>More</li><li><a href=3>Three</a></li></ul></article>")
    assert html_extract.main_text(page).split("\n") == [long.strip(), "Short."]
    plain = f"<body><nav>menu</nav><article><p>{codes}</p><div class=ad>Buy</div><p>Tail</p></article><footer>end</footer>"
    assert html_extract.main_text(plain).split("\n") == [codes.strip(), "Tail"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</", "<!--", "<script>x", "<a href='", "&amp", "&#x;", "<p>" * 300 + "x"])
def test_broken_pages(page):
    assert isinstance(html_extract.main_text(page), str)


def test_pages_of_the_table(spark):
    import html
    import re

    pages = table(spark, SF01, "pages").select("html", html_extract.extract(spark, F.col("html")).alias("t")).collect()
    for r in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)\b[^>]*>|<br>(?=<p>)", body)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", "", x)).split()) for x in parts]
        assert r.t == "\n".join(x for x in texts if x)


BODIES = {
    "ru": ["Вчера вечером жители города собрались на площади, чтобы обсудить новый проект набережной и дороги.",
           "Архитектор рассказал, что строительство займёт два года и потребует участия многих местных мастеров.",
           "Обсуждение продолжится весной, когда проект покажут всем желающим жителям города."],
    "zh": ["昨天晚上，市民们聚集在广场上讨论新的滨河项目，并且提出了许多关于道路和公园的意见。", "建筑师说施工将持续两年，需要许多当地工匠的参与，也需要大家的耐心。",
           "讨论将在春天继续进行，届时项目将向所有人展示，欢迎大家前来参观。"],
    "it": ["Ieri sera gli abitanti della città si sono riuniti in piazza per discutere il nuovo progetto del lungomare.",
           "L'architetto ha spiegato che i lavori dureranno due anni e richiederanno molti artigiani del posto.",
           "La discussione continuerà in primavera, quando il progetto sarà mostrato a tutti quanti."],
    "pl": ["Wczoraj wieczorem mieszkańcy miasta zebrali się na placu, aby omówić nowy projekt bulwaru nad rzeką.",
           "Architekt powiedział, że budowa potrwa dwa lata i będzie wymagała udziału wielu miejscowych rzemieślników.",
           "Dyskusja będzie kontynuowana wiosną, kiedy projekt zostanie pokazany wszystkim chętnym."],
    "fi": ["Eilen illalla kaupungin asukkaat kokoontuivat torille keskustelemaan uudesta rantahankkeesta ja teistä.",
           "Arkkitehti kertoi rakentamisen kestävän kaksi vuotta ja vaativan monien paikallisten osaajien työtä.",
           "Keskustelu jatkuu keväällä, kun hanke esitellään kaikille halukkaille kaupunkilaisille."]}


@pytest.mark.parametrize("lang", BODIES)
@pytest.mark.parametrize("frame", ["article", "div", "p"])
def test_articles_of_any_language_come_back_whole(lang, frame):
    """With menu, footer and a list of links in the middle, with and without an article element."""
    menu = "<ul class='menu'>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(6)) + "</ul>"
    links = "<ul>" + "".join(f"<li><a href='/x{i}'>More {i}</a></li>" for i in range(4)) + "</ul>"
    one, two, three = BODIES[lang]
    inner = {"article": "<article><p>{}</p><p>{}</p>%s<p>{}</p></article>", "div": "<div>{}</div><div>{}</div>%s<div>{}</div>",
             "p": "<p>{}</p><p>{}</p>%s<p>{}</p>"}[frame] % links
    page = f"<html><body><nav>{menu}</nav>{inner.format(one, two, three)}<footer>Imprint and contact</footer></body></html>"
    assert html_extract.main_text(page).split("\n") == [one, two, three]


@pytest.mark.parametrize("page", ["<div>" * 100_000, "<div>x</i>" * 60_000, "<p><b>" * 50_000, "<li>" * 100_000, "<a><div>" * 50_000 + "</a>" * 50_000,
                                  "<ul><li>" * 50_000, "</div>" * 100_000, "<td><span>" * 50_000])
def test_deep_and_unclosed_markup_takes_linear_time(page):
    import time

    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 10         # quadratic: many minutes


def test_two_passes_by_brute_force():
    """Labels by a search over all blocks for the nearest decided one, for random pages."""
    import random

    rng = random.Random(12)
    filler = ["the sea and the land and the sky of it " * 3, "zq vx kj wq " * 9, "short one", "Вот и всё, что было на том берегу реки в тот день, и не более того.", "中文" * 30]

    def element(depth):
        tag = rng.choice(["p", "div", "h2", "li", "nav", "article", "section", "footer", "a", "span"])
        inner = "".join(element(depth + 1) for _ in range(rng.randint(1, 3))) if depth < 3 and rng.random() < 0.6 else rng.choice(filler)
        inner = f"<a href=x>{inner}</a>" if rng.random() < 0.15 else inner
        return f"<{tag}>{inner}</{tag}>"

    E = html_extract
    for _ in range(400):
        page = "".join(element(0) for _ in range(rng.randint(1, 6)))
        found = E.blocks(page)

        def long(t):
            return len(t) + 2 * sum(E._NO_SPACES.match(c) is not None for c in t) >= E.LONG

        def linked(b):
            return b.linked / max(1, sum(not c.isspace() for c in b.text))

        def share(texts):
            words = [w for t in texts for w in re.findall(r"[^\W\d_]+", t.lower())]
            return sum(w in E.STOP_WORDS for w in words) / len(words) if words else 0.0

        own = share([b.text for b in found if not b.bad and linked(b) <= E.LINKS and long(b.text)])
        first = []
        for b in found:
            asked = min(E.STOPS_IN_ARTICLE if b.article else E.STOPS, own / 2)
            first.append(False if b.bad or linked(b) > E.LINKS else True if b.heading and b.article else
                         True if long(b.text) and share([b.text]) >= asked else None)
        kept = []
        for i, b in enumerate(found):
            label = first[i]
            if label is None:
                if b.article:
                    flow = [k for k, x in enumerate(found) if x.article and not x.bad]
                    near = [(abs(flow.index(k) - flow.index(i)), k > i, first[k]) for k in flow
                            if found[k].part == b.part and first[k] is not None]
                else:
                    free = not b.linked and long(b.text)
                    near = [(abs(k - i), k > i, v) for k, v in enumerate(first) if v is not None and not (free and found[k].bad)]
                label = min(near)[2] if near else True
            if label:
                kept.append(b.text)
        assert E.main_text(page) == "\n".join(kept), page


def test_html_extraction_on_odd_tables(spark):
    rows = [(1, "<p>" + "the sea and the land " * 5 + "</p>"), (1, "<p>" + "the sea and the land " * 5 + "</p>"), (None, None), (2, ""),
            (3, "<div>" + "the sea and the land of it " * 40_000 + "</div>")]
    df = spark.createDataFrame(rows, "page_id long, html string").select("*", F.lit(1).alias("text"), F.lit(2).alias("made"))
    made = df.select("page_id", html_extract.extract(spark, F.col("html")).alias("t"))
    assert sorted((r.page_id or 0, len(r.t)) for r in made.collect()) == [(0, 0), (1, 104), (1, 104), (2, 0), (3, 27 * 40_000 - 1)]
    assert made.where("false").count() == 0
