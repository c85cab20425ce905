"""Quality classifier: naive Bayes features under a support vector machine.

A text's features are the unigrams and bigrams of its tokens (runs of letters
and digits, or of other signs), hashed to ``BUCKETS`` indicators, and the
share of bigrams that repeat one token, in steps. Each
indicator is scaled by its class log-count ratio; rows are brought to unit
length; a linear hinge-loss model is fitted by dual coordinate descent; two
cross-fitted halves give the margins on which a sigmoid turns a margin into a
score from 0 to 1.

The fit uses at most ``fit_rows`` labelled rows, those with the smallest hash
of their id: a documented bound, so the sample may be broadcast to find its
texts and its features come to the driver. Rows that repeat an id count once,
as the text with the smallest hash, added up before the shuffle. Scoring needs
no shuffle.

Defined results: NULL and empty texts have no features and get the score of
the model's bias; with no label of one of the classes every text gets the
smoothed share of label 1 (0.5 without labels). Several labels of one document
count once, as the largest; labels other than 0 and 1 don't count. Whole texts
are read, in slices that overlap by one token.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

BUCKETS = 1 << 18
SLICE = 1 << 20
#: the first buckets stand for bigrams of one token twice: more than this share of a slice's bigrams
REPEATS = (0.0, 0.02, 0.1, 0.3)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


_CLASS = np.full(256, 2, dtype=np.uint8)     # 0 white space, 1 letters, digits and all beyond ASCII, 2 other signs
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS - len(REPEATS)) + np.uint64(len(REPEATS))


def _slice_features(raw: bytes) -> tuple[np.ndarray, int]:
    """Buckets of one slice, and where its last token begins."""
    b = np.frombuffer(raw, dtype=np.uint8)
    kind = _CLASS[b]
    edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    end = np.append(edge[1:], len(b))
    word = kind[edge] != 0
    start, end = edge[word], end[word]
    if not len(start):
        return np.empty(0, dtype=np.int32), len(raw)
    up, down = _power_tables(len(b) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)])])
    token = (total[end] - total[start]) * down[start]
    pair = token[:-1] * np.uint64(0xD6E8FEB86659FD93) + token[1:] + np.uint64(1)
    again = float((token[1:] == token[:-1]).mean()) if len(token) > 1 else 0.0
    special = np.arange(sum(again > s for s in REPEATS), dtype=np.uint64)
    return np.unique(np.concatenate([special, _mixed(np.concatenate([token, pair]))])).astype(np.int32), int(start[-1])


def features(text: str | None) -> np.ndarray:
    """The distinct buckets of a whole text, in ascending order."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if len(raw) <= SLICE:
        return _slice_features(raw)[0] if raw else np.empty(0, dtype=np.int32)
    parts, at = [], 0
    while at < len(raw):
        stop = at + SLICE
        if stop < len(raw):             # end a slice at white space if it has any
            cut = max(raw.rfind(c, at, stop) for c in (b" ", b"\n", b"\t", b"\r"))
            stop = cut if cut > at else stop
        found, last = _slice_features(raw[at:stop])
        parts.append(found)
        at = at + last if stop < len(raw) and 0 < last < stop - at else stop
    return np.unique(np.concatenate(parts))


@dataclass
class Model:
    """Margin of a row: its weights' sum over the root of its scales' sum, plus the bias."""
    weight: np.ndarray
    scale: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(self.scale[found].sum())) if len(found) else 0.0
        return (float(self.weight[found].sum()) / norm if norm else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -40, 40))))


def _constant(share: float) -> Model:
    none = np.zeros(BUCKETS, dtype=np.float32)
    return Model(none, none, 0.0, 0.0, float(np.log(share / (1 - share))))


def _fit_svm(rows: list[np.ndarray], y: np.ndarray, cost: float, epochs: int, seed: int) -> Model:
    """Log-count ratios, then dual coordinate descent for the hinge loss."""
    counts = {c: np.ones(BUCKETS) for c in (1, -1)}
    for r, v in zip(rows, y):
        counts[v][r] += 1.0
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    ratio[(counts[1] == 1) & (counts[-1] == 1)] = 0.0     # never seen
    norms = np.array([np.linalg.norm(ratio[r]) for r in rows])
    inverse = 1.0 / np.where(norms > 0, norms, 1.0)
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    share = {c: max(1, int((y == c).sum())) for c in (1, -1)}
    bound = np.array([cost * len(y) / (2 * share[v]) for v in y])      # both classes weigh the same
    length = np.where(norms > 0, 2.0, 1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = ratio[r] * inverse[i]
            slope = y[i] * (float(w[r] @ x) + bias) - 1.0
            new = min(max(alpha[i] - slope / length[i], 0.0), bound[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return Model((w * ratio).astype(np.float32), (ratio ** 2).astype(np.float32), bias, 1.0, 0.0)


def _sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and shift of the score, by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * margin ** 2).sum() + 1e-6, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(m, [(g * margin).sum(), g.sum()]), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def fit_rows_model(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 20, seed: int = 7) -> Model:
    """The model of rows (distinct buckets) with labels 0 and 1."""
    y = np.where(labels > 0, 1, -1)
    if not (y > 0).any() or not (y < 0).any():
        return _constant(((y > 0).sum() + 1) / (len(y) + 2))
    model = _fit_svm(rows, y, cost, epochs, seed)
    half = np.zeros(len(y), dtype=bool)
    for c in (1, -1):
        half[np.flatnonzero(y == c)[::2]] = True
    margin = np.empty(len(y))
    for own in (half, ~half):
        inside = [i for i in np.flatnonzero(own)]
        if len({int(y[i]) for i in inside}) < 2:
            part = model
        else:
            part = _fit_svm([rows[i] for i in inside], y[inside], cost, epochs, seed)
        for i in np.flatnonzero(~own):
            margin[i] = part.margin(rows[i])
    model.slope, model.shift = _sigmoid(margin, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 8000, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    """Fit on at most ``fit_rows`` labelled documents, those with the smallest hash of their id."""
    sample = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
              .where("id IS NOT NULL AND label IN (0, 1)")
              .groupBy("id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(fit_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate([np.empty(0, dtype=np.int32), *found])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(ends, flat)],
                                             names=["id", "label", "found"])

    importable(docs.sparkSession)
    # at most fit_rows rows of two numbers: the broadcast is bounded by that parameter
    found = (docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
             .join(F.broadcast(sample), "id").groupBy("id", F.col("label").cast("int").alias("label"))
             .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("id", "label", "one.text")
             .mapInArrow(extract, "id long, label int, found array<int>")
             .toArrow())
    rows = []
    for lists in found.column("found").chunks:      # views of what came, no copies
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        rows += [flat[s:e] for s, e in itertools.pairwise(ends)]
    labels_ = found.column("label").to_numpy() if rows else np.empty(0)
    order = sorted(range(len(rows)), key=found.column("id").to_pylist().__getitem__)
    return fit_rows_model([rows[i] for i in order], labels_[order] if rows else labels_)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """A column of scores from 0 to 1; higher means label 1 is likelier."""
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(features(t.as_py())) for t in texts], pa.float64())

    return scored(text)
