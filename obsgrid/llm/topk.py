"""Exact top-k inner products over a bit-sliced index.

Components are quantised to integers. A block of rows keeps, for each
dimension, one bitmap per bit of the component above the block's minimum. For
a query the weighted sum over dimensions is formed on bitmaps alone: a
dimension's slices go in once for each bit of the query's component, shifted
by its place, complemented where the component is negative, and carry-save
adders reduce them to the slices of the score. The best rows are then selected
from the most significant slice downward: rows with the bit set stay as long
as k or more have it, else they are taken for sure and the search goes on
among the rest. Rows still tied after the last slice go by the smaller id, and
the chosen rows' scores are computed again from the integers.

Rows and queries are dealt by hash to blocks and chunks of bounded size, and
each pair of them is one task's work, so memory is bounded and any number of
queries can be asked. What leaves a task is k rows for each query.

Defined results: vectors that are NULL or hold NULL or a non-finite component
take no part, neither as queries nor as candidates. Only vectors of one length
are compared. All rows with the query's id count as its own. A query that
comes twice is answered once. Slices have as many bits as the sums need; scores
are added up in longs where the block's largest components show that they fit,
else in integers of any size, so nothing wraps. A quantised component, or a
score among the k best, that is no long fails with a message. An empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import importable

BLOCK_ROWS = 32768
CHUNK_QUERIES = 512
LONG = float(1 << 63)


def quantised(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of every component as a double; NULL if a component is NULL or not finite."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))

    def floored(x: Column) -> Column:
        y = F.lit(scale) * x.cast("double")
        return F.when(F.abs(y) < LONG, F.floor(y)).otherwise(
            F.raise_error(F.lit("top-k search: a quantised component is beyond a long")).cast("long"))

    return F.when(usable, F.transform(vector, floored))


class SlicedIndex:
    """Bit slices of a block of integer rows, sorted by id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        n, dims = self.rows.shape
        self.words = -(-n // 64)
        self.low = self.rows.min(axis=0)
        self.largest = [max(-int(a), int(b)) for a, b in zip(self.low, self.rows.max(axis=0))]
        above = self.rows.view(np.uint64) - self.low.view(np.uint64)        # unsigned, so that no span is too large
        self.widths = [int(x).bit_length() for x in above.max(axis=0)]
        self.slices = [[self._bitmap((above[:, d] >> np.uint64(s)) & np.uint64(1)) for s in range(w)]
                       for d, w in enumerate(self.widths)]
        self.everyone = self._bitmap(np.ones(n, dtype=np.uint8))
        self.turned = [[s ^ self.everyone for s in own] for own in self.slices]

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, dtype=np.uint8)
        raw = np.packbits(bits.astype(np.uint8), bitorder="little")
        packed[:len(raw)] = raw
        return packed.view(np.uint64)

    def score_slices(self, query: np.ndarray) -> list[np.ndarray | None]:
        """Slices, least significant first, of the score above a constant."""
        places: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            own, weight, bit = (self.slices if q > 0 else self.turned)[d], abs(q), 0
            while weight:
                if weight & 1:
                    while len(places) < bit + len(own):
                        places.append([])
                    for s, bitmap in enumerate(own):
                        places[bit + s].append(bitmap)
                weight, bit = weight >> 1, bit + 1
        out: list[np.ndarray | None] = []
        for place in places:        # grows by its carries
            while len(place) > 1:
                a, b = place.pop(), place.pop()
                if len(out) + 1 == len(places):
                    places.append([])
                half = a ^ b
                if place:
                    c = place.pop()
                    place.insert(0, half ^ c)
                    places[len(out) + 1].append((a & b) | (half & c))
                else:
                    place.append(half)
                    places[len(out) + 1].append(a & b)
            out.append(place[0] if place else None)
        return out

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of the block, in no order."""
        own = self._bitmap(self.ids == query_id)
        open_rows = self.everyone & ~own
        sure = np.zeros_like(open_rows)
        taken = 0
        for bitmap in reversed(self.score_slices(query)):
            with_bit = open_rows & bitmap if bitmap is not None else np.zeros_like(open_rows)
            have = int(np.bitwise_count(with_bit).sum())
            if taken + have >= k:
                open_rows = with_bit
            else:
                sure |= with_bit
                taken += have
                open_rows = open_rows & ~with_bit
        at = self._rows(sure)
        tied = self._rows(open_rows)[:k - taken]        # equal scores; rows are in order of id
        at = np.concatenate([at, tied])
        return self.ids[at], self.scores(at, query)

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products of some rows: longs where no sum can be beyond one, else Python's integers."""
        if sum(abs(q) * most for q, most in zip(query.tolist(), self.largest)) < 1 << 63:
            return self.rows[at] @ query
        return self.rows[at].astype(object) @ query.astype(object)

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _halves(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores as upper and lower parts that order as they do; parts beyond 2^62 are no longs' and all the same."""
    if scores.dtype != object:
        return scores >> 32, scores & 0xFFFFFFFF
    upper = np.array([max(min(x >> 32, 1 << 62), -(1 << 62)) for x in scores], dtype=np.int64)
    return upper, np.array([x & 0xFFFFFFFF for x in scores], dtype=np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, vec_id: str = "vec_id",
          vector: str = "embedding", block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k largest inner products, ties to the smaller id."""
    importable(vectors.sparkSession)

    def prepared(df: DataFrame) -> DataFrame:
        return (df.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"))
                .where("id IS NOT NULL AND v IS NOT NULL").withColumn("dims", F.size("v")))

    rows, asked = prepared(vectors), prepared(queries).dropDuplicates(["id"])
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    chunks = max(1, math.ceil(queries.count() / chunk_queries))
    by = ["dims", "block", "chunk"]

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def part(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    left = rows.withColumn("block", part(blocks)).withColumn("chunk", numbers(chunks)).groupBy(*by)
    right = asked.withColumn("chunk", part(chunks)).withColumn("block", numbers(blocks)).groupBy(*by)

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, out = ["query_id", "vec_id", "upper", "lower"], []
        if len(rows) and len(asked):
            dims = int(rows["dims"].iloc[0])
            index = SlicedIndex(rows["id"].to_numpy(), np.array(rows["v"].tolist(), dtype=np.int64).reshape(len(rows), dims))
            for query_id, v in zip(asked["id"], asked["v"]):
                found, scores = index.best(query_id, np.asarray(v, dtype=np.int64), k)
                upper, lower = _halves(scores)
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": found, "upper": upper, "lower": lower}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ids})

    order = Window.partitionBy("query_id").orderBy(F.desc("upper"), F.desc("lower"), "vec_id")
    score = F.when(F.col("upper").between(-(1 << 31), (1 << 31) - 1), F.shiftleft("upper", 32).bitwiseOR(F.col("lower"))).otherwise(
        F.raise_error(F.lit("top-k search: a score among the best is beyond a long")).cast("long"))
    return (left.cogroup(right).applyInPandas(search, "query_id long, vec_id long, upper long, lower long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))
