"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the bytes of one text differently. Every token, of either,
points to the farthest-right token that overlaps it, and to itself where both
tokenizers end a token at its end. Doubling the pointers (each takes its
target's target, whole arrays at a time) reaches, after as many rounds as the
logarithm of the longest chain, each component's terminal token; tokens of one
terminal are one group. A and B tokens whose bytes overlap are linked.

First pass, in Arrow batches: ids, groups and links of each document, with its
distinct linked id pairs and how often each occurs, written to the shared
folder. The pairs' document counts are added up in every task before they
are shuffled, and the highest count of each A id is marked (a window of at most
B's vocabulary). Then each document's pairs meet the counts: broadcast while
the counted pairs are at most ``BROADCAST_PAIRS``, else by a shuffle whose two
plain sides adaptive execution splits where a pair is in every document; in both cases the sums are per
row and are put together inside the task first.

A is a byte-level BPE file of the ``tokenizers`` library. Where its rules are
those of a rank file (merges in the order of ids, the usual byte-level
splitting, no other step) and a text has only letters whose class is long
settled, the faster ``tiktoken`` reads the same ranks; all else goes through
the library itself.

Defined results: NULL and empty texts, and texts that either tokenizer doesn't
give back byte for byte, have no tokens: zeros and an empty groups string.
Repeated rows each have a row, and count as a document each. An empty table
gives no rows. Texts of any length are one row; about ``CHUNK_BYTES`` of text are
worked on at once, or one text if it is longer. Columns beside id and text are
neither read nor returned.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import broadcast_if_small, fresh, importable, written
from obsgrid.session import scratch_path

BROADCAST_PAIRS = 1_500_000
CHUNK_BYTES = 1 << 20
#: Latin to Cyrillic and usual punctuation: letters, numbers and spaces among them are the same in every Unicode version in use
_SETTLED = re.compile("[^\x00-ԧ‐-‧‰-›]")
#: the split of byte-level vocabularies
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_state: dict = {}


def _letter_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids of a text without special tokens, and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = _letter_bytes()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        added = {t["content"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        self.fast = self._ranked(spec, vocabulary, added)

    def _ranked(self, spec: dict, vocabulary: dict[str, int], added: set[str]):
        """A rank encoder with the file's rules, or None where they are others."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
        first = len(vocabulary) - len(added & set(vocabulary)) - len(merges)
        usual = (spec.get("normalizer") is None and model.get("type") in (None, "BPE") and not model.get("dropout")
                 and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                 and all(vocabulary.get(m.replace(" ", "")) == first + i for i, m in enumerate(merges)))
        if not usual:
            return None
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks={self.bytes[i]: i for t, i in vocabulary.items() if t not in added},
                                 special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and _SETTLED.search(text) is None:
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B, which puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


def tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """Loaded once in a worker."""
    if (path_a, path_b) not in _state:
        _state[path_a, path_b] = ByteLevel(path_a), Pieces(path_b)
    return _state[path_a, path_b]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A and each B token, the B token that ends its group. Ends are byte offsets, rising, with the same last one."""
    n_a = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)            # the B token over an A token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(n_a, n_a + len(ends_b))
    to = np.concatenate([n_a + over_a, np.where(ends_a[over_b] > ends_b, over_b, own)]) if n_a else own
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:n_a] - n_a, to[n_a:] - n_a
        to = further


def linked(ends_a: np.ndarray, starts_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A and B tokens whose byte ranges overlap, in order."""
    first = np.searchsorted(ends_b, starts_a, side="right")
    n = np.searchsorted(ends_b, ends_a) - first + 1
    a = np.repeat(np.arange(len(ends_a)), n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[a]
    return a, b


class Aligner:
    """Groups and links of texts, some at a time."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizers(path_a, path_b)
        self.sizes = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b)]
        # decimal ids with what may follow: a comma, a bar after A's last, a semicolon after B's last
        most = max(map(len, self.sizes))
        self.decimal = [f"{i}{mark}".encode() for i in range(most) for mark in ",|;"]

    def encoded(self, text: str | None) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        whole = (" " + text).encode("utf-8", "surrogatepass")
        one, other = self.a.ids(" " + text), self.b.ids(text)
        for ids, table in ((one, self.a.bytes), (other, self.b.bytes)):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return [], []
        return one, other

    def __call__(self, texts: list[str | None]) -> list[tuple]:
        """For each text (n_a, n_b, n_groups, n_links, groups string as bytes, pairs, times)."""
        both = [self.encoded(t) for t in texts]
        n_a, n_b = (np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1))
        a, b = (np.fromiter((i for x in both for i in x[k]), np.int64, n.sum()) for k, n in ((0, n_a), (1, n_b)))
        # texts stand one after another: all of them are grouped and linked at once
        size_a, size_b = self.sizes[0][a], self.sizes[1][b]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
        end_of_a, end_of_b = terminals(ends_a, ends_b)
        last = np.unique(end_of_b)                      # the terminals, in order
        group_a, group_b = np.searchsorted(last, end_of_a), np.searchsorted(last, end_of_b)
        in_a, in_b = (np.bincount(g, minlength=len(last)) for g in (group_a, group_b))
        # ids in the order of the groups string, each with its mark
        place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        marks = np.empty(len(a) + len(b), dtype=np.int64)
        marks[place_a] = 3 * a + np.append(np.diff(group_a) > 0, True)[:len(a)]
        marks[place_b] = 3 * b + 2 * np.append(np.diff(group_b) > 0, True)[:len(b)]
        at_a, at_b = linked(ends_a, ends_a - size_a, ends_b)
        pairs = a[at_a] << 32 | b[at_b]
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        cut_pairs = np.searchsorted(at_a, stop_a)
        cut_groups = np.searchsorted(last, stop_b)
        out, before = [], (0, 0, 0)
        for k in range(len(texts)):
            now = int(stop_a[k] + stop_b[k]), int(cut_pairs[k]), int(cut_groups[k])
            own, times = np.unique(pairs[before[1]:now[1]], return_counts=True)
            string = b"".join(map(self.decimal.__getitem__, marks[before[0]:now[0]].tolist()))[:-1]
            out.append((int(n_a[k]), int(n_b[k]), now[2] - before[2], now[1] - before[1], string, own, times))
            before = now
        return out


def links(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times; with ``groups`` the groups string too.

    ``pairs`` are its distinct linked id pairs, A's id in the upper 32 bits and B's in the lower, ``times`` how often each is linked.
    """
    importable(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = ["n_a", "n_b", "n_groups", "n_links"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            sizes = [len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column("text")]
            start = 0
            while start < len(sizes):
                stop, n = start + 1, sizes[start]
                while stop < len(sizes) and n + sizes[stop] <= CHUNK_BYTES:
                    n += sizes[stop]
                    stop += 1
                own = batch.slice(start, stop - start)
                made = aligner(own.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(r[5]) for r in made])]).astype(np.int32)
                columns = {"doc_id": own.column("doc_id")} | {c: pa.array([r[i] for r in made], pa.int64()) for i, c in enumerate(counts)}
                columns["groups_sha256"] = pa.array([hashlib.sha256(r[4]).hexdigest() if r[0] else "" for r in made], pa.string())
                if groups:
                    columns["groups"] = pa.array([r[4].decode() for r in made], pa.string())
                for k, c, kind in ((5, "pairs", np.int64), (6, "times", np.int32)):
                    columns[c] = pa.ListArray.from_arrays(offsets, np.concatenate([r[k] for r in made]).astype(kind))
                yield pa.RecordBatch.from_pydict(columns)
                start = stop

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(align, f"doc_id {kind}, {', '.join(f'{c} long' for c in counts)}, groups_sha256 string, "
                             + "groups string, " * groups + "pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents link the pair, and whether no pair of its A id is in more."""
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))                 # at most as many rows as B has ids
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    row = fresh("row")
    # numbered before it is written: what is read again has the numbers that were stored
    made, path = links(docs, path_a, path_b, doc_id, text).withColumn(row, F.monotonically_increasing_id()), scratch_path(spark, "aligned")
    made.write.option("compression", "zstd").parquet(path)
    aligned = spark.read.schema(made.schema).parquet(path)
    counts = written(pair_counts(aligned), "pair-counts")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    entries = aligned.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("e")).select(row, "e.pairs", "e.times")
    n_pairs = counts.count()
    met = entries.join(broadcast_if_small(counts, n_pairs, BROADCAST_PAIRS), F.col("pairs") == F.col("pair"))
    sums = met.groupBy(row).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return aligned.select(row, *kept).join(sums, row, "left").select(
        *kept[:-1], F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
