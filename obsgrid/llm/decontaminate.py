"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, exact to the word.

Words are maximal runs of letters, digits and characters beyond ASCII, with
A-Z in lower case. A benchmark item is cut into windows of ``window``
consecutive words (an item of fewer words, but not none, is one window), and a
window into its shingles of ``SHINGLE`` words, hashed to longs. A window is
contained in a document only if all its shingles are, so one of them is a
necessary prefix: with the shingles ordered by rarity, counted over all
documents, it is the rarest. Only prefixes are joined:

1. Count, over all documents, the shingles that occur in the benchmark
   (added up in every task before the shuffle).
2. Index each distinct window under its rarest shingle and that shingle's place.
3. Join the documents' shingles with the index. A shingle ``pos`` words into
   the text and ``at`` words into the window puts the window's first word at
   ``pos - at``: the positional bound asks that to be 0 or more, the length bound
   that the window ends within the text. What is left is verified word by word
   on the item-sized slice of the text.
4. The intervals of the verified windows are united per document.

The documents never shuffle whole: each pass explodes hashes inside a task
against a broadcast index. An index over ``BLOCK_BYTES`` is dealt into blocks,
each broadcast for a pass of its own over all documents, so its size bounds a
block and never drops a window. What is shuffled is one narrow row for each
document, and the verified windows, put together per document first.

Defined results: a NULL or empty text, and one without words, has zero words and
no hit. Repeated rows each have their own result row. Rows of one item id are one
item; an item with a NULL id counts, with the empty string in the list of ids.
Items without words occur nowhere. An empty documents table gives no rows, an
empty benchmark leaves all documents clean. Very long texts are one row like any
other. Columns beside the named ones are neither read nor returned, whatever
their names.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import broadcast_if_small, keep_in_shared, settled, written

WINDOW = 10
SHINGLE = 5
#: bytes of one broadcast block of the index, words included
BLOCK_BYTES = 16_000_000
#: contaminated documents whose result is broadcast to all rows; more are joined by a shuffle
BROADCAST_ROWS = 200_000

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_OF_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Only texts with letters beyond ASCII need the slower letter by letter form."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lowered(text), F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """The number of words, without the cost of lower case."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD_OF_ANY_CASE)), F.lit(0)).cast("long")


def shingle_keys(w: Column, size: int) -> Column:
    """A long for the shingle at each word. The last ones, cut short, are keys that no full shingle's place bound lets through."""
    return F.transform(w, lambda x, i: F.xxhash64(F.lit(size), x, *[F.get(w, i + j) for j in range(1, size)]))


def item_windows(items: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """Distinct windows: (w, items), the words and the ids of the items that have them."""
    w = settled(items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("all")))
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1))),
                      lambda i: F.slice("all", i, window))
    return (w.where(F.size("all") > 0).select("item", F.explode(cut).alias("w"))
            .groupBy("w").agg(F.collect_set("item").alias("items")))


def _shingles_of_windows(windows: DataFrame, size: int) -> DataFrame:
    """(w, items, at, key): the full shingles of each window; windows shorter than ``SHINGLE`` have one, their own length."""
    length = F.least(F.size("w"), F.lit(SHINGLE))
    keyed = windows.where(length == size).select("*", F.posexplode(shingle_keys(F.col("w"), size)).alias("at", "key"))
    return keyed.where(F.col("at") + size <= F.size("w"))


def _met(docs: DataFrame, sizes: list[int], blocks: list[DataFrame], carried: list[str], then) -> DataFrame:
    """``then`` of the joins of all documents' shingles (carried..., w, pos, key) with each block on ``key``.

    One join for each shingle length, below their union: there explode, probe and verification are one piece of generated
    code, which reads a document's words where they are and copies only what ``then`` lets through.
    """
    prepared = settled(docs.select(*carried, words(F.col("text")).alias("w")), **{f"k{n}": shingle_keys(F.col("w"), n) for n in sizes})
    return reduce(DataFrame.unionByName, [then(prepared.select(*carried, "w", F.posexplode(f"k{n}").alias("pos", "key")).join(block, "key"))
                                          for n in sizes for block in blocks])


def _blocks(index: DataFrame, n_bytes: int, by: str) -> list[DataFrame]:
    """The index as broadcast blocks of about ``BLOCK_BYTES`` or less."""
    n = -(-n_bytes // BLOCK_BYTES)
    if n <= 1:
        return [F.broadcast(index)]
    return [F.broadcast(index.where(F.pmod(F.xxhash64(by), F.lit(n)) == i)) for i in range(n)]


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, text_key, spans, items): documents that contain windows, with the word intervals (start, end) and item ids.

    Documents of equal id and text share one row; ``text_key`` is the text's SHA-256.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_key"),
                         F.col(text).alias("text"))
    windows = written(item_windows(items, window, item_id, item_text), "windows")
    sizes = [r["size"] for r in windows.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("size")).distinct().collect()]  # SHINGLE numbers at most
    none = source.limit(0).select("doc_id", "text_key", F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
                                  F.array().cast("array<string>").alias("items"))
    if not sizes:
        return none
    shingles = written(reduce(DataFrame.unionByName, [_shingles_of_windows(windows, n) for n in sizes]), "item-shingles")
    keys = written(shingles.select("key").distinct(), "shingle-keys")
    n_keys = keys.count()

    # 1: rarity, over all documents
    counted = (_met(source, sizes, _blocks(keys, 16 * n_keys, "key"), [], lambda met: met.select("key"))
               .groupBy("key").agg(F.count("*").alias("n")))
    rarity = keep_in_shared(counted)

    # 2: each window under its rarest shingle; a window with a shingle that no document has is in no document
    index = written(shingles.join(broadcast_if_small(rarity, n_keys, BROADCAST_ROWS), "key", "left")
                    .groupBy("w").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "at")).alias("prefix"),
                                      F.first("items").alias("items"))
                    .where("prefix.n > 0").select("prefix.key", "prefix.at", F.col("w").alias("words"), "items"), "window-index")
    n_bytes = index.select(F.sum(F.length(F.concat_ws(" ", "words")) + F.length(F.concat_ws(" ", "items")) + 64)).first()[0]
    if not n_bytes:
        return none

    # 3: join prefixes, bounds, exact words
    start, end = F.col("pos") - F.col("at"), F.col("pos") - F.col("at") + F.size("words")
    met = _met(source, sizes, _blocks(index, n_bytes, "words"), ["doc_id", "text_key"], lambda met: met
               .where((start >= 0) & (end <= F.size("w"))).where(F.slice("w", start + 1, F.size("words")) == F.col("words"))
               .select("doc_id", "text_key", F.struct(start.alias("start"), end.alias("end")).alias("span"), "items"))
    # 4: sets, so that equal rows of a document give one result
    return (met.groupBy("doc_id", "text_key")
            .agg(F.collect_set("span").alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))


def covered(spans: Column) -> Column:
    """The number of words in the union of intervals."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, span: Column) -> Column:
        fresh_words = F.greatest(span["end"] - F.greatest(span["start"], state["to"]), F.lit(0))
        return F.struct(F.greatest(state["to"], span["end"]).alias("to"), (state["n"] + fresh_words).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda state: state["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, items (the ids of items with occurring windows), contaminated."""
    found = keep_in_shared(occurrences(docs, items, window, doc_id, text, item_id, item_text)
                           .select("doc_id", "text_key", covered(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("items")))
    # NULL ids meet as well: equal structs
    key = F.struct("doc_id", "text_key")
    found = found.select(key.alias("key"), "n_hit", "items")
    rows = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_key")).alias("key"),
                       word_count(F.col(text)).alias("n_words"))
    out = rows.join(broadcast_if_small(found, found.count(), BROADCAST_ROWS), "key", "left")
    return out.select("key.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.col("n_hit").isNotNull().alias("contaminated"))
