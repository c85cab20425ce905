"""Exact duplicates through an extendible-hash index on shared files.

The key of a text is a 64-bit hash of its normalised form. The index is built
from keys alone:

1. ``entries``: one narrow row per document (key, id, digest), written to the
   shared folder.
2. ``directory``: buckets are prefixes of the key. Starting from the depth
   that fits the number of keys, the directory doubles while a bucket holds
   more keys than its capacity: such buckets split on the next bit, the others
   stay as they are. Copies share a key and count once, so a group of copies
   never overfills a bucket.
3. ``build_index``: one row per key (its bucket, smallest id, rows), dealt to
   owner tasks by bucket -- a bucket is a range of keys, and none is split
   between two owners -- and written as shared files, in order within each.

A document finds its key through the directory: the bucket its key's first
bits lead to, and in it the key. A key that leads to no bucket is an error by
name, never a lost row.

Texts are compared only where a key has more than one row, within its bucket.
The rows of a key form its chain: rows of equal bytes are one link. The bytes themselves are the
grouping key, and Spark adds copies up before it shuffles, so a third of all
rows in one group costs one row per task. A chain of one link settles all rows
of its key at once; a chain with more links (different texts under one key) is
followed by comparing bytes row by row.

Everything is DataFrame operations. Defined results: NULL text counts as
empty, so NULL, empty and (normalised) equal texts group. Rows that repeat a
doc_id are rows of their own with equal results; all rows with the smallest id
of a group count as kept. A group whose ids are all NULL has a NULL keep_id
and keeps all its rows. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import broadcast_if_small, fresh, keep_in_shared, written

WHITE = r"[\x20\x09-\x0D]+"
KEY_BITS = 64
CAPACITY = 4096
#: keys of 8 bytes: at most 8 MB to broadcast
BROADCAST_KEYS = 1_000_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _key(norm: Column, key_bits: int) -> Column:
    return F.shiftright(F.xxhash64(norm), KEY_BITS - key_bits)


def _prefix(key: Column, depth: int, key_bits: int) -> Column:
    """The first ``depth`` bits of a key, in key order (keys are signed)."""
    return F.shiftright(key, key_bits - depth)


def directory(keys: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """Buckets (depth, prefix, keys) that cover all of ``keys``' distinct keys, each at most ``capacity`` full.

    A bucket at full depth holds one key and cannot split.
    """
    total = keys.count()
    depth = min(key_bits, max(1, math.ceil(math.log2(max(2, total / capacity)))))
    done, open_keys = None, keys.select("key")
    while True:
        cells = open_keys.groupBy(_prefix(F.col("key"), depth, key_bits).alias("prefix")).agg(F.count("*").alias("keys"))
        cells = keep_in_shared(cells.select(F.lit(depth).alias("depth"), "prefix", "keys"))
        full = F.col("keys") > capacity
        fitting = cells.where(~full) if depth < key_bits else cells
        done = fitting if done is None else done.unionByName(fitting)
        over = cells.where(full)
        if depth == key_bits or over.isEmpty():
            return done
        open_keys = open_keys.join(over.select("prefix"), _prefix(F.col("key"), depth, key_bits) == F.col("prefix"),
                                   "left_semi")
        depth += 1


def addressed(rows: DataFrame, buckets: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """``rows`` (with ``key``) and the bucket (depth, prefix) that the directory leads each to, by one probe for each depth in use."""
    depths = [r["depth"] for r in buckets.select("depth").distinct().orderBy("depth").collect()]     # at most key_bits
    n = buckets.count()
    out, places = rows, []
    for depth in depths:
        at = fresh(f"at_{depth}")
        level = buckets.where(F.col("depth") == depth).select(F.col("prefix").alias(at))
        out = out.join(broadcast_if_small(level, n, BROADCAST_KEYS), _prefix(F.col("key"), depth, key_bits) == F.col(at), "left")
        places.append((depth, at))
    nowhere = F.raise_error(F.lit("exact dedup: a key leads to no bucket of the directory"))
    return out.select(*rows.columns,
                      F.coalesce(*[F.when(F.col(at).isNotNull(), depth) for depth, at in places], nowhere.cast("int")).alias("depth"),
                      F.coalesce(*[F.col(at) for _, at in places], nowhere.cast("long")).alias("prefix"))


def build_index(entries: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """The directory, and index rows (depth, prefix, key, keep_id, group_size), one per key, on shared files by owners of buckets."""
    keys = keep_in_shared(entries.groupBy("key").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    buckets = directory(keys, capacity, key_bits)
    low = F.expr(f"shiftleft(prefix, {key_bits} - depth)")      # the least key of the bucket: an owner's range holds whole buckets
    owned = (addressed(keys, buckets, key_bits).select("depth", "prefix", "key", "keep_id", "group_size").withColumn("low", low)
             .repartitionByRange("low").sortWithinPartitions("low", "key").drop("low"))
    return buckets, written(owned, "exact-index")


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
               key_bits: int = KEY_BITS) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256)."""
    source = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    keyed = source.withColumn("key", _key(F.col("norm"), key_bits))
    entries = written(keyed.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "exact-entries")
    buckets, index = build_index(entries, capacity, key_bits)
    place = ["depth", "prefix", "key"]
    # only keys with more than one row need their bytes compared
    shared = keep_in_shared(index.where("group_size > 1").select(*place))
    held = broadcast_if_small(shared, shared.count(), BROADCAST_KEYS)
    members = addressed(keyed, buckets, key_bits).join(held, place, "left_semi")
    links = members.groupBy(*place, "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    chains = written(links, "exact-chains")
    crossed = keep_in_shared(chains.groupBy(*place).agg(F.count("*").alias("links")).where("links > 1").select(*place))
    n_crossed = crossed.count()
    placed = addressed(entries, buckets, key_bits)
    settled = placed.join(index, place)
    if n_crossed:
        held = broadcast_if_small(crossed, n_crossed, BROADCAST_KEYS)
        settled = settled.join(held, place, "left_anti")
        followed = (addressed(keyed, buckets, key_bits).join(held, place, "left_semi")
                    .join(chains.join(held, place, "left_semi"), [*place, "norm"])
                    .withColumn("text_sha256", F.sha2("norm", 256)))
        settled = settled.select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(
            followed.select("doc_id", "keep_id", "group_size", "text_sha256"))
    return settled.select("doc_id", "keep_id", "group_size",
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **index) -> DataFrame:
    """The documents that stay, with all their columns."""
    keep = duplicates(docs, doc_id, text, **index).where("kept").select(F.col("doc_id").alias("__kept_id")).distinct()
    return docs.join(keep, docs[doc_id].eqNullSafe(F.col("__kept_id")), "left_semi")
