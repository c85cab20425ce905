"""Language identification with hyperdimensional letter-trigram profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds three
of them: the first letter's vector rotated twice, times the second's rotated
once, times the third's. A document's vector is the bundle (sum) of its
trigram vectors, a language's prototype the bundle of its training documents'
vectors; the language whose prototype has the largest cosine wins.

``learn`` sums trigram counts per language in Spark, so what is bundled into
one prototype is a table of at most ``SYMBOLS ** 3`` counts, however large the
corpus. ``predict`` adds one struct column and needs no shuffle.

Defined results: a NULL text or one without a letter gives ``und`` with score
0; if nothing was learned every text gives ``und``; equal cosines go to the
first language in alphabetic order. Whole texts are read, in slices whose
counts add up, so a very long text needs bounded memory. Other columns of the
input pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

#: a to z are 1 to 26, every other letter shares 37 vectors by code point, 0 is what stands between words.
SYMBOLS = 64
DIM = 1024
SEED = 20240229
SLICE = 1 << 20
UNDECIDED = "und"
RESULT = "struct<lang_pred:string,score:double>"

_state: dict = {}


def _symbol_table() -> np.ndarray:
    if "symbols" not in _state:
        points = range(0x110000)
        letters = np.fromiter((chr(p).isalpha() for p in points), dtype=bool, count=len(points))
        table = np.where(letters, 27 + np.arange(len(points)) % (SYMBOLS - 27), 0).astype(np.uint8)
        for i in range(26):
            table[ord("a") + i] = i + 1
        _state["symbols"] = table
    return _state["symbols"]


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter trigrams of a whole text (both empty without a letter)."""
    table, parts, last = _symbol_table(), [], np.zeros(1, dtype=np.uint8)
    low = text.lower()
    any_letter = False
    for at in range(0, len(low), SLICE):
        points = np.frombuffer(low[at:at + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = np.concatenate([last, table[points]])
        if at + SLICE >= len(low):
            s = np.append(s, np.uint8(0))
        any_letter = any_letter or bool(s.any())
        gap = s == 0
        s = s[~(gap & np.concatenate([[False], gap[:-1]]))].astype(np.int32)
        if len(s) >= 3:
            parts.append(np.unique((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], return_counts=True))
        last = s[-2:].astype(np.uint8)
    if not any_letter or not parts:
        return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
    if len(parts) == 1:
        return parts[0]
    codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def _letters() -> np.ndarray:
    if "letters" not in _state:
        _state["letters"] = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, DIM))
    return _state["letters"]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bind three permuted letter vectors for each trigram code."""
    v = _letters()
    first, second, third = codes // SYMBOLS ** 2, codes // SYMBOLS % SYMBOLS, codes % SYMBOLS
    return np.roll(v, 2, axis=1)[first] * np.roll(v, 1, axis=1)[second] * v[third]


class _Bundler:
    """Bundles documents in blocks; keeps the vectors of trigrams seen, up to ``most``."""

    def __init__(self, most: int = 8192):
        self.most = most
        self.vectors = np.empty((most, DIM), dtype=np.float32)
        self.forget()

    def forget(self) -> None:
        self.row = np.full(SYMBOLS ** 3, -1, dtype=np.int32)
        self.known = 0

    def bundle(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        codes = np.unique(np.concatenate([d[0] for d in docs])) if docs else np.empty(0, dtype=np.int32)
        if len(codes) > self.most:      # more than the store holds: add up block by block
            out = np.zeros((len(docs), DIM), dtype=np.float32)
            for at in range(0, len(codes), self.most):
                block = codes[at:at + self.most]
                picked = [(c[m], n[m]) for c, n in docs for m in [(c >= block[0]) & (c <= block[-1])]]
                out += self.bundle(picked)
            return out
        new = codes[self.row[codes] < 0]
        if self.known + len(new) > self.most:
            self.forget()
            new = codes
        self.row[new] = self.known + np.arange(len(new))
        for at in range(0, len(new), 1024):
            some = new[at:at + 1024]
            self.vectors[self.known:self.known + len(some)] = trigram_vectors(some)
            self.known += len(some)
        counts = np.zeros((len(docs), self.known), dtype=np.float32)
        for i, (c, n) in enumerate(docs):
            counts[i, self.row[c]] = n
        return counts @ self.vectors[:self.known]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Language prototypes (unit vectors) from the rows whose text and language are not NULL."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[str, np.ndarray] = {}
            for t, name in zip(batch.column(0), batch.column(1)):
                codes, n = trigram_counts(t.as_py())
                total = totals.setdefault(name.as_py(), np.zeros(SYMBOLS ** 3, dtype=np.int64))
                total[codes] += n
            for name, total in totals.items():
                codes = total.nonzero()[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(total[codes])],
                    names=["lang", "code", "n"])

    def bundle(counts: pa.Table) -> pa.Table:
        total, codes = np.zeros(DIM), counts.column("code").to_numpy()
        n = counts.column("n").to_numpy().astype(np.float64)
        for at in range(0, len(codes), 8192):
            total += n[at:at + 8192] @ trigram_vectors(codes[at:at + 8192])
        vector = total / (np.linalg.norm(total) or 1.0)
        return pa.table({"lang": counts.column("lang").slice(0, 1), "vector": pa.array([vector.tolist()], pa.list_(pa.float64()))})

    importable(docs.sparkSession)
    rows = (docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
            .where("text IS NOT NULL AND lang IS NOT NULL")
            .mapInArrow(count, "lang string, code int, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n"))
            .groupBy("lang").applyInArrow(bundle, "lang string, vector array<double>")
            .collect())
    return {r["lang"]: np.array(r["vector"]) for r in sorted(rows, key=lambda r: r["lang"])}


def predict(spark: SparkSession, model: dict[str, np.ndarray], text: Column) -> Column:
    """A struct column (lang_pred, score): the nearest prototype and its cosine, negative ones as 0."""
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = list(shared.value)
        prototypes = np.array([shared.value[k] for k in names], dtype=np.float32).reshape(len(names), DIM)
        bundler = _Bundler()
        for batch in batches:
            langs, scores = np.full(len(batch), UNDECIDED, dtype=object), np.zeros(len(batch))
            at, block, chars = [], [], 0
            for i, value in enumerate(batch):
                t = value.as_py()
                grams = trigram_counts(t) if t else (np.empty(0), None)
                if len(grams[0]) and names:
                    at.append(i)
                    block.append(grams)
                    chars += len(t)
                if block and (len(block) == 128 or chars > SLICE or i == len(batch) - 1):
                    v = bundler.bundle(block)
                    cos = v @ prototypes.T / np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
                    best = cos.argmax(axis=1)
                    langs[at] = np.array(names, dtype=object)[best]
                    scores[at] = np.clip(cos[np.arange(len(best)), best], 0.0, 1.0)
                    at, block, chars = [], [], 0
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["lang_pred", "score"])

    return nearest(text)
