"""SimHash near-duplicates by tiled exact comparison of fingerprints.

``fingerprints`` hashes every word shingle of a whole text with XXH64 (seed
42); a fingerprint bit is set where more than half of the hashes have it.

``links`` finds all pairs of distinct fingerprints that differ in at most
``distance`` bits. Fingerprints are laid in tiles by the population counts of
their ``parts`` equal parts. Counts of two parts that differ by d need at
least d differing bits, so a tile pair whose counts differ by more than
``distance`` in all is skipped; every other tile pair is compared whole, by
exclusive or and bit counts in numpy. Tiles over ``block`` rows are cut into
blocks, so a task holds one block of its own tile and streams the visitors
from the tiles around. What a task gives out is a spanning forest of the links
it found, so a group of near copies gives as many rows as it has members, and
components stay whole.

``near_duplicates`` adds the components. Copies with one fingerprint are one
node, found by an aggregate that adds up before it shuffles.

Defined results: NULL and empty texts and texts without a word have fingerprint
zero, linked like any other; fewer words than a shingle make one shingle;
repeated shingles count each time. Rows that repeat a doc_id each give a row;
a NULL doc_id is never a component's smallest, and a component of such rows
alone has a NULL id. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import broadcast_if_small, fresh, importable, keep_in_shared, written
from obsgrid.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
PARTS = 4
BLOCK = 4096
#: rows of two numbers: some 50 MB to broadcast
BROADCAST_ROWS = 1_000_000


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a whole text. Only A-Z are lower-cased, only ASCII white space parts words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    lasts = ends[min(shingle, len(words)) - 1:]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 14):
        span = zip(starts[at:min(n, at + (1 << 14))].tolist(), lasts[at:at + (1 << 14)].tolist())
        h = np.array([digest(line[s:e], SEED) for s, e in span], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(spark: SparkSession, text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long column."""
    importable(spark)

    @F.arrow_udf("long")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t.as_py(), shingle) for t in texts], pa.int64())

    return made(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _tile(fp: Column, parts: int) -> Column:
    """The population counts of the parts, as digits to base 65."""
    width = 64 // parts
    mask = F.lit((1 << width) - 1).cast("long")
    tile = F.lit(0).cast("long")
    for i in range(parts):
        tile = tile * 65 + F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(mask))
    return tile


def _steps(parts: int, distance: int) -> list[int]:
    """Differences of tile numbers whose counts differ by 1 to ``distance`` in all, one of each opposite pair."""
    found = set()
    for step in itertools.product(range(-distance, distance + 1), repeat=parts):
        number = sum(s * 65 ** (parts - 1 - i) for i, s in enumerate(step))
        if 0 < sum(map(abs, step)) <= distance and number > 0:
            found.add(number)
    return sorted(found)


class _Forest:
    """Union of fingerprints; tells whether a link joins two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while self.up.get(x, x) != x:
            self.up[x] = self.up.get(self.up[x], self.up[x])
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True

    def roots(self, xs: np.ndarray) -> np.ndarray:
        return np.array([self.root(x) for x in xs.tolist()], dtype=np.uint64)


def compare(home: np.ndarray, visitors: np.ndarray, distance: int, forest: _Forest) -> Iterator[tuple[int, int]]:
    """Pairs (home, visitor) within the distance that join two trees of the forest.

    Tiles of 1024 by 1024; whole tiles of far population counts are skipped.
    """
    order = np.argsort(np.bitwise_count(home), kind="stable")
    weight = np.bitwise_count(home[order]).astype(np.int64)
    for at in range(0, len(visitors), 1024):
        tile = visitors[at:at + 1024]
        counts = np.bitwise_count(tile).astype(np.int64)
        lo = np.searchsorted(weight, counts.min() - distance, "left")
        hi = np.searchsorted(weight, counts.max() + distance, "right")
        for own in range(lo, hi, 1024):
            index = order[own:min(hi, own + 1024)]
            near = np.bitwise_count(home[index][:, None] ^ tile[None, :]) <= distance
            if np.count_nonzero(near) > 4096:     # many copies of few texts: most pairs are in one tree already
                near &= forest.roots(home[index])[:, None] != forest.roots(tile)[None, :]
            for i, j in zip(*near.nonzero()):
                a, b = int(home[index[i]]), int(tile[j])
                if forest.join(a, b):
                    yield a, b


def links(prints: DataFrame, distance: int = DISTANCE, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """Rows (a, b) that join all fingerprints within ``distance`` as a forest per task.

    ``prints`` has one long column ``fp`` of distinct values.
    """
    importable(prints.sparkSession)
    tiled = prints.select("fp", _tile(F.col("fp"), parts).alias("tile"))
    # at most one row for each combination of counts, (64 / parts + 1) ** parts of them
    sizes = (tiled.groupBy("tile").agg(F.count("*").alias("n"))
             .select("tile", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    placed = (tiled.join(sizes, "tile")
              .select("fp", "tile", "blocks", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int").alias("own")))
    home = placed.select(F.col("tile").alias("at"), F.col("own").alias("nr"), F.lit(0).alias("role"), "fp")
    # the same tile: a block visits those after it; other tiles: all blocks of the smaller tile number
    inner = (placed.where("own > 0").withColumn("nr", F.explode(F.sequence(F.lit(0), F.col("own") - 1)))
             .select(F.col("tile").alias("at"), "nr", F.lit(1).alias("role"), "fp"))
    steps = F.array([F.lit(s).cast("long") for s in _steps(parts, distance)])
    outer = (placed.select("fp", F.explode(F.transform(steps, lambda s: F.col("tile") - s)).alias("at"))
             .join(sizes.withColumnRenamed("tile", "at"), "at")
             .withColumn("nr", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("at", "nr", F.lit(1).alias("role"), "fp"))
    everyone = home.unionByName(inner).unionByName(outer)
    dealt = everyone.repartition("at", "nr").sortWithinPartitions("at", "nr", "role")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, fresh, forest = None, [], True, _Forest()
        base = np.empty(0, dtype=np.uint64)
        out: list[tuple[int, int]] = []

        def close():
            nonlocal base, fresh
            if fresh and own:
                base, fresh = np.concatenate(own), False
                out.extend(compare(base, base, distance, forest))

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            fps = cols[3].astype(np.int64).view(np.uint64)
            change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            for s, e in itertools.pairwise([0, *change.tolist(), len(fps)]):
                if s == e:
                    continue
                here = (int(cols[0][s]), int(cols[1][s]))
                if here != key:
                    close()
                    key, own, fresh, forest = here, [], True, _Forest()
                if cols[2][s] == 0:
                    own.append(fps[s:e])
                else:
                    close()
                    if own:
                        out.extend(compare(base, fps[s:e], distance, forest))
            if len(out) >= 4096:
                yield _pairs(out)
                out = []
        close()
        yield _pairs(out)

    return dealt.mapInArrow(found, "a long, b long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(rows, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0].copy()), pa.array(a[:, 1].copy())], names=["a", "b"])


def classes(prints: DataFrame, distance: int = DISTANCE, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """Rows (fp, component_id), one per distinct fingerprint, of rows (doc_id, fp) that cost little to read again."""
    nodes = keep_in_shared(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(nodes.select("fp"), distance, parts, block))
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = keep_in_shared(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return keep_in_shared(grouped.join(lowest, "root").select("fp", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS,
                    block: int = BLOCK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (doc_id, fp long, component_id)."""
    prints = keep_in_shared(docs.select(F.col(doc_id).alias("doc_id"),
                                        fingerprint(docs.sparkSession, F.col(text), shingle).alias("fp")))
    return prints.join(classes(prints, distance, parts, block), "fp").select("doc_id", "fp", "component_id")


def unique_documents(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS,
                     block: int = BLOCK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Rows that repeat the id of a document that stays, in its component, all
    stay; so do all rows of a component whose ids are all NULL.
    """
    fp = fresh("fp")
    printed = written(docs.withColumn(fp, fingerprint(docs.sparkSession, F.col(text), shingle)), "printed")
    prints = printed.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp"))
    gone = keep_in_shared(prints.join(classes(prints, distance, parts, block), "fp")
                          .where(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
                          .select(F.col("doc_id").alias("gone_id"), F.col("fp").alias("gone_fp")).distinct())
    held = broadcast_if_small(gone, gone.count(), BROADCAST_ROWS)
    return printed.join(held, (printed[fp] == held["gone_fp"]) & printed[doc_id].eqNullSafe(held["gone_id"]), "left_anti").drop(fp)
