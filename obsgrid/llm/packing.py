"""Best-fit-decreasing packing of documents into sequences of bounded length.

Tokenising yields pieces of at most ``capacity`` tokens. Pieces of one length
are interchangeable to the packer, so best fit decreasing needs only how many
pieces each length has: at most ``capacity`` numbers, whatever the corpus.
``plan`` runs it on them. Lengths go in decreasing order; a segment tree over
remaining capacities finds the tightest open bins in logarithmic time, and all
pieces of a length that go to bins of one fill move at once, as a run of ranks
onto a run of bins. The outcome is exactly that of placing one piece at a time.

Spark numbers the pieces of each length: each task counts its own per length,
running sums over these counts give every task its first rank, and within a
task ranks follow in order. No length, however common, meets in one task.

Defined results: a NULL or empty text is one piece, the closing id alone.
Repeated rows are packed each for itself. An empty table gives no rows. Which
of equally long pieces goes where follows their place in the input.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import fresh, importable, written

CAPACITY = 4096
CLOSING_ID = 1
#: words whose ids a worker remembers before it starts anew
REMEMBERED = 400_000

# The rules of a vocabulary file under which the ids of a text are those of its words in a row.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                                   {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

_state: dict = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class WordIds(dict):
    """Ids of words, as little-endian unsigned 32-bit bytes, worked out when first asked for.

    A tokenizer with the rules ``_NORMALIZER`` and ``_SPLIT`` lower-cases, parts words at white space and drops it, so the
    ids of a text are those of its words in a row. A word of plain letters,
    with or without commas and stops after it, is one match of the tokenizer's
    pattern and goes straight to its merges; any other goes through the whole
    tokenizer. So do whole texts that hold one of the file's added tokens, and
    all texts of a file with other rules.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task keeps to its own core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        added = rules.get("added_tokens") or []
        #: strings that the library takes out of a raw text before anything else: texts with one go through it whole
        self.added = [t["content"] for t in added]
        self.by_words = (rules.get("normalizer"), rules.get("pre_tokenizer")) == (_NORMALIZER, _SPLIT) and not any(
            t.get(k) for t in added for k in ("normalized", "lstrip", "rstrip", "single_word"))
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(",.")
        low = stem.lower()
        if not stem.isalpha() or max(low) >= "\u0300":
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        elif stem != word:
            ids = self[stem] + self[word[len(stem):]]
        elif low != word:
            ids = self[low]
        else:
            letters = stem if stem.isascii() else "".join([self.letters[b] for b in stem.encode()])
            found = [t.id for t in self.merges.tokenize(letters)]
            ids = struct.pack(f"<{len(found)}I", *found)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if not self.by_words or any(a in text for a in self.added):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(found)}I", *found)
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


def word_ids(path: str) -> WordIds:
    """The worker's own encoder for a vocabulary file."""
    if path not in _state:
        _state[path] = WordIds(path)
    return _state[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, task, nr): nr counts a task's pieces of that length."""
    importable(docs.sparkSession)
    width, closing = 4 * capacity, np.array([closing_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = word_ids(vocabulary).encode, np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            ids, part, start, length, crc, nr = [], [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                raw = encode(t.as_py() or "") + closing
                for k, at in enumerate(range(0, len(raw), width)):
                    piece = raw[at:at + width]
                    n = len(piece) // 4
                    ids.append(i)
                    part.append(k)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(piece))
                    nr.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(part, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), batch.column(2).take(pa.array(ids, pa.int64())),
                 pa.array(nr, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nr"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.spark_partition_id().alias("task"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nr long")


class _Tightest:
    """Segment tree over remaining capacities: the number of open bins of each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, bins: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += bins
            at //= 2

    def at_least(self, room: int) -> int:
        """The smallest remaining capacity of an open bin that is ``room`` or more; 0 if none."""
        at = room + self.size
        if self.count[at]:
            return room
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return 0


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit decreasing on counts per length: runs (length, first rank, pieces, first bin, offset)."""
    tree, open_bins, runs, bins = _Tightest(capacity), {}, [], 0

    def close(room: int, first: int, n: int) -> None:
        """Bins ``first`` to ``first + n - 1`` now have this room."""
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room:
                first, have = open_bins[room].pop()
                tree.add(room, -have)
            else:
                room, first, have = capacity, bins, left
            # a bin that took a piece is the tightest that fits, so it fills before the next one
            per = room // length
            full = min(have, left // per)
            used = full
            for k in range(per if full else 0):
                runs.append((length, rank + k * full, full, first, capacity - room + k * length))
            rank, left = rank + per * full, left - per * full
            close(room - per * length, first, full)
            if left and used < have and left < per:
                runs.extend((length, rank + k, 1, first + used, capacity - room + k * length) for k in range(left))
                close(room - left * length, first + used, 1)
                used, rank, left = used + 1, rank + left, 0
            if room < capacity or first < bins:
                close(room, first + used, have - used)
            else:
                bins += used
    return runs


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, closing_id: int = CLOSING_ID,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = written(pieces(docs, vocabulary, capacity, closing_id, doc_id, text), "pieces")
    each = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    # at most ``capacity`` numbers come to the driver
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(plan(counts, capacity), dtype=np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = each.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shared = docs.sparkSession.sparkContext.broadcast(runs)
    span = int(max(counts.values(), default=0)) + 1

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        r, of, k = shared.value, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        row = np.searchsorted(-r[:, 0] * span + r[:, 1], -of * span + k, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(r[row, 3] + k - r[row, 1]), pa.array(r[row, 4])], names=["sequence_id", "offset"])

    to = fresh("place")
    return (cut.join(firsts, ["length", "task"]).withColumn(to, place("length", F.col("nr") + F.col("base")))
            .select("doc_id", "piece", "start", "length", "ids_crc32", f"{to}.sequence_id", f"{to}.offset"))
