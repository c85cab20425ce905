"""Line dedup: equal and nearly equal lines across documents, by a segment-partition edit join.

A line is what stands between line feeds, without spaces, tabs and carriage
returns at its ends. Two lines are linked if they are different texts, both of
``min_chars`` characters or more, within ``edits`` insertions, deletions or
substitutions. A line is dropped if an equal line stands earlier, or a linked
line's first occurrence does; earlier means by (doc_id, line number). So every
dropped line leads, over copies, to one that stays. Blank lines always stay.

The join: a line is cut into ``edits + 1`` even segments. Within ``edits``
edits one segment at least is untouched, so the partner holds it at a place
that lengths and edits bound. Every distinct line puts its segments into an
index keyed by segment number, length and content, and probes the index with
its own substrings at those places, for every length that is shorter by up to
``edits``. What meets there is compared by counts of frequent letters inside
the join (each edit changes them by two in all at most), then verified with a
banded bit-parallel automaton: one word for each number of edits, one bit for
each diagonal of the band.

Everything is DataFrame operations. What is shuffled is hashes and numbers;
texts are read again from the documents. Equal lines are found by a 128-bit
hash, added up before the shuffle, so a very common line is one row per task.
Sides whose counted rows are few are broadcast, beyond that they are shuffled.

Defined results: a NULL text has no lines and stays NULL; an empty text is one
blank line. Rows that repeat a doc_id and a text get the same result, as
neither stands earlier; a NULL doc_id counts as the last. A document may lose
all its lines and stays, with an empty text. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import broadcast_if_small, fresh, keep_in_shared, written

EDITS = 2
MIN_CHARS = 50
#: letters whose counts bound the distance from below, three bits each
LETTERS = "etanoirshdlgbwfu"
#: rows of a few numbers each: some 50 MB to broadcast
BROADCAST_ROWS = 1_000_000
LAST_ID = (1 << 63) - 1
CHUNK = 16


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (d, h, line_no, line, k1, k2) of all lines that aren't blank; d and h tell the document's row."""
    source = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("d"),
                         F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    return (source.select("d", "h", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
            .withColumn("line", F.btrim("line", F.lit(" \t\r"))).where("line <> ''")
            .withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(1), F.col("line"))}))


def _place() -> Column:
    """(d, line_no) as one number, in order."""
    return F.col("d").cast("decimal(38,0)") * F.lit(1 << 31) + F.col("line_no")


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator, so that their users read them and don't work them out again."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _segment(length: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of an even partition; the last ones are longer by one."""
    n = edits + 1
    base = F.floor(length / n).cast("int")
    plain = F.lit(n) - length % n
    return i * base + F.greatest(F.lit(0), i - plain), base + F.when(i >= plain, 1).otherwise(0)


def _keys(places: list[tuple[int, int, int]], edits: int) -> Column:
    """Keys of a line's substrings: each place is a segment, by how much the partner is shorter, and a shift.

    Reads ``line``, its ``length``, its bytes ``raw`` and whether these are all
    ASCII (``plain``): then characters are bytes, which are cut without counting.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(less).alias("less"), F.lit(shift).alias("shift"))
                       for i, less, shift in places])

    def key(place: Column) -> Column:
        length = F.col("length") - place["less"]
        start, size = _segment(length, place["i"], edits)
        at = start + place["shift"] + 1
        return F.when(F.col("plain"), F.xxhash64(F.substring(F.col("raw"), at, size), place["i"], length)).otherwise(
            F.xxhash64(F.substring(F.col("line"), at, size), place["i"], length))

    return F.transform(listed, key)


def _index_places(edits: int) -> list[tuple[int, int, int]]:
    return [(i, 0, 0) for i in range(edits + 1)]


def _probe_places(edits: int) -> list[tuple[int, int, int]]:
    """Where a segment of a line shorter by 0 to ``edits`` can stand, with edits to its left and right bounded.

    Without the index places, which are probed too.
    """
    return [(i, less, shift) for less in range(edits + 1) for i in range(edits + 1)
            for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1) if (less, shift) != (0, 0)]


def _letter_counts() -> Column:
    """Counts of frequent letters modulo 8, three bits each; every letter counted leaves less text to look through."""
    counts, rest = F.lit(0).cast("long"), F.col("line")
    before = F.octet_length(rest)
    for i, letter in enumerate(LETTERS):
        rest = F.replace(rest, F.lit(letter), F.lit(""))
        after = F.octet_length(rest)
        counts = counts.bitwiseOR(F.shiftleft(((before - after) % 8).cast("long"), 3 * i))
        before = after
    return counts


def _count_gap(a: Column, b: Column) -> Column:
    """Sum over letters of the distance of two counts around the circle of 8, never above that of the counts."""
    def gap(i: int) -> Column:
        d = (F.shiftright(a, 3 * i) - F.shiftright(b, 3 * i)).bitwiseAND(F.lit(7).cast("long"))
        return F.least(d, 8 - d)

    return reduce(lambda x, y: x + y, [gap(i) for i in range(len(LETTERS))])


def _common_chunks(a: Column, b: Column) -> Column:
    """Characters of the whole chunks that two texts have in common at their start."""
    whole = F.floor(F.least(F.length(a), F.length(b)) / CHUNK).cast("int")
    same = F.transform(F.sequence(F.lit(0), whole),
                       lambda i: F.substring(a, i * CHUNK + 1, F.lit(CHUNK)) == F.substring(b, i * CHUNK + 1, F.lit(CHUNK)))
    first = F.array_position(same, False)
    return (F.when(first > 0, F.least(first - 1, whole)).otherwise(whole) * CHUNK).cast("int")


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """The edit distance of two character arrays if it is at most ``edits``, else NULL.

    Bit d + edits of word e is set if the first i characters of ``a`` become
    the first i + d of ``b`` by at most e edits. Words go on by one character
    of ``a``: along the diagonal if the characters agree, else from word e - 1
    by substitution, deletion (next higher diagonal) or insertion (next lower).
    """
    m, n, band = F.size(a), F.size(b), (1 << (2 * edits + 1)) - 1

    def masks(i: Column) -> Column:
        """Diagonals on which the characters at i agree, and those inside ``b``."""
        letter = F.get(a, i - 1)
        match = reduce(lambda x, y: x.bitwiseOR(y),
                       [F.when(F.get(b, i - 1 + d) == letter, 1 << (d + edits)).otherwise(0) for d in range(-edits, edits + 1)])
        inside = reduce(lambda x, y: x.bitwiseOR(y),
                        [F.when(i + d <= n, 1 << (d + edits)).otherwise(0) for d in range(-edits, edits + 1)])
        return F.struct(match.alias("match"), inside.alias("inside"))

    def step(words: Column, mask: Column) -> Column:
        new, low = [], None
        for e in range(edits + 1):
            word = words[f"w{e}"].bitwiseAND(mask["match"])
            if e:
                old = words[f"w{e - 1}"]
                word = word.bitwiseOR(old).bitwiseOR(F.shiftright(old, 1)).bitwiseOR(F.shiftleft(low, 1))
            low = word.bitwiseAND(mask["inside"])
            new.append(low.alias(f"w{e}"))
        return F.struct(*new)

    start = F.struct(*[F.lit(((1 << (e + 1)) - 1) << edits & band).alias(f"w{e}") for e in range(edits + 1)])

    def read(words: Column) -> Column:
        goal = reduce(lambda x, y: x.bitwiseOR(y),
                      [F.when(n - m == d, 1 << (d + edits)).otherwise(0) for d in range(-edits, edits + 1)])
        return F.coalesce(*[F.when(words[f"w{e}"].bitwiseAND(goal) != 0, e) for e in range(edits + 1)])

    walked = F.aggregate(F.transform(F.sequence(F.lit(1), m), masks), start, step, read)
    return F.when(F.abs(n - m) > edits, F.lit(None)).when(m == 0, n).otherwise(walked)


def verified(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """The pairs whose texts ``a`` and ``b`` are within ``edits``; common chunks at both ends are passed over."""
    left, right = a, b
    for _ in range(2):
        cut, x, y = fresh("cut"), fresh("x"), fresh("y")
        pairs = _fixed(pairs, **{cut: _common_chunks(F.col(left), F.col(right))})
        pairs = _fixed(pairs, **{x: F.reverse(F.expr(f"substring(`{left}`, `{cut}` + 1)")),
                                 y: F.reverse(F.expr(f"substring(`{right}`, `{cut}` + 1)"))})
        left, right = x, y

    def chars(c: str) -> Column:
        return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(c), ""))

    x, y = fresh("x"), fresh("y")
    pairs = _fixed(pairs, **{x: chars(left), y: chars(right)})
    return (pairs.select(*[c for c in pairs.columns if not c.startswith("__")],
                         edit_distance(F.col(x), F.col(y), edits).alias("distance")).where("distance IS NOT NULL"))


def links(distinct_lines: DataFrame, again: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (k1, k2, line, place) twice, as a_ and b_, and their distance: all linked pairs, each once.

    ``distinct_lines`` and ``again`` are the same rows, computed anew for each use.
    """
    measured = _fixed(distinct_lines, length=F.length("line"), raw=F.col("line").cast("binary"))
    measured = _fixed(measured.where(F.col("length") >= max(min_chars, edits + 1)), plain=F.octet_length("raw") == F.col("length"))
    keyed = written(measured.select(F.col("k1").alias("id"), "length", _letter_counts().alias("counts"),
                            _keys(_index_places(edits), edits).alias("index"), _keys(_probe_places(edits), edits).alias("probes")),
                    "line-keys")
    index = keyed.select(F.explode("index").alias("key"), F.col("id").alias("a"), F.col("length").alias("a_length"),
                         F.col("counts").alias("a_counts"))
    probes = keyed.select(F.explode(F.concat("index", "probes")).alias("key"), F.col("id").alias("b"), F.col("length").alias("b_length"),
                          F.col("counts").alias("b_counts"))
    met = (index.join(probes, (index["key"] == probes["key"])
                      & ((F.col("a_length") < F.col("b_length")) | (F.col("a") < F.col("b")))
                      & (_count_gap(F.col("a_counts"), F.col("b_counts")) <= 2 * edits))
           .select("a", "b").distinct())
    met = keep_in_shared(met)
    ids = met.select(F.col("a").alias("k1")).unionByName(met.select(F.col("b").alias("k1"))).distinct()
    texts = written(again.join(broadcast_if_small(ids, met.count() * 2, BROADCAST_ROWS), "k1", "left_semi"), "lines")
    sides = [texts.select(*[F.col(c).alias(f"{s}_{c}") for c in ("k1", "k2", "line", "place")]) for s in "ab"]
    pairs = (met.join(sides[0], F.col("a") == F.col("a_k1")).join(sides[1], F.col("b") == F.col("b_k1")))
    return verified(pairs, "a_line", "b_line", edits).drop("a", "b")


def verdicts(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Rows (d, h, dropped array of line numbers, links) of documents that have a copied or linked line.

    ``d`` is the id (NULL as the largest long), ``h`` the hash of the text.
    """
    lines = _lines(docs, doc_id, text)
    copied = written(lines.withColumn("place", _place()).groupBy("k1", "k2")
                     .agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("k1", "k2", "first"),
                     "copied-lines")
    n_copied = copied.count()
    small = broadcast_if_small(copied, n_copied, BROADCAST_ROWS)

    def distinct_lines() -> DataFrame:
        own = lines.withColumn("place", _place()).join(small, ["k1", "k2"], "left")
        return (own.where(F.col("first").isNull() | (F.col("first") == F.col("place")))
                .select("k1", "k2", "line", "place"))

    found = keep_in_shared(links(distinct_lines(), distinct_lines(), edits, min_chars)
                           .select("a_k1", "a_k2", "a_place", "b_k1", "b_k2", "b_place").distinct())
    both = found.unionByName(found.select(*[F.col(f"{t}_{c}").alias(f"{s}_{c}") for s, t in (("a", "b"), ("b", "a"))
                                            for c in ("k1", "k2", "place")]))
    later = F.struct("b_place", "b_k1", "b_k2") < F.struct("a_place", "a_k1", "a_k2")
    near = both.groupBy(F.col("a_k1").alias("k1"), F.col("a_k2").alias("k2")).agg(
        F.max(later.cast("int")).alias("near_earlier"), F.count("*").alias("links"))
    known = written(copied.join(near, ["k1", "k2"], "full"), "line-verdicts")
    # both sides plain, so a very common line can be split among tasks
    hits = (lines.select("d", "h", "line_no", "k1", "k2")
            .join(broadcast_if_small(known, known.count(), BROADCAST_ROWS), ["k1", "k2"]))
    gone = (F.coalesce(_place() > F.col("first"), F.lit(False)) | (F.coalesce("near_earlier", F.lit(0)) == 1))
    return (hits.groupBy("d", "h", "line_no").agg(F.max(gone).alias("gone"), F.max(F.coalesce("links", F.lit(0))).alias("links"))
            .groupBy("d", "h").agg(F.collect_list(F.when(F.col("gone"), F.col("line_no"))).alias("dropped"),
                                   F.sum("links").alias("links")))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, doc_id: str = "doc_id",
                text: str = "text", dropped: str = "dropped_lines", n_links: str = "line_links") -> DataFrame:
    """The documents with ``text`` without its dropped lines, and two more columns:
    the numbers (from 0) of dropped lines, and how many different texts its lines are linked with."""
    found = written(verdicts(docs, edits, min_chars, doc_id, text), "document-lines")
    size = found.agg(F.coalesce(F.sum(F.size("dropped") + 3), F.lit(0))).first()[0]
    d, h, gone, links_ = fresh("d"), fresh("h"), fresh("gone"), fresh("links")
    side = found.select(F.col("d").alias(d), F.col("h").alias(h), F.sort_array("dropped").alias(gone), F.col("links").alias(links_))
    joined = docs.join(broadcast_if_small(side, size, 4 * BROADCAST_ROWS),
                       (F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)) == F.col(d))
                       & (F.xxhash64(docs[text]) == F.col(h)), "left")
    # the lines that stay, by number: cheap for a text of many lines that loses many
    parts = fresh("parts")
    joined = _fixed(joined, **{parts: F.when(F.size(gone) > 0, F.split(docs[text], "\n", -1))})
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    new = F.when(F.size(gone) > 0, F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n")).otherwise(docs[text])
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns],
                         F.coalesce(F.col(gone), F.array().cast("array<int>")).alias(dropped),
                         F.coalesce(F.col(links_), F.lit(0)).alias(n_links))
