"""Connected components of a link table, by alternating star steps on DataFrames.

Each round first links every node's larger neighbours to the smallest node
around it (large star), then its smaller neighbours likewise (small star);
components end as stars around their smallest node. No group of neighbours is
ever gathered: both steps join the links with one minimum per node, which
Spark adds up before it shuffles. Minima and links are checkpointed, so both
sides of each join are plain exchanges, which adaptive execution splits where
one node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgrid.llm.common import keep_in_shared


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (a > b); the smallest node around u is joined to u's larger neighbours, or to its smaller ones and u."""
    if larger:
        around = links.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(
            links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        low = keep_in_shared(around.groupBy("u").agg(F.min("v").alias("v"))
                             .select("u", F.least("u", "v").alias("m")))
        return (around.where("v > u").join(low, "u").where("v <> m")
                .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
    low = keep_in_shared(links.groupBy("a").agg(F.min("b").alias("m")))
    return (links.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                        F.col("m").alias("b"))
            .where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """Roots of linked nodes: rows (node, root), root the smallest node reachable.

    ``links`` has two columns of longs, in any order and with repeats. Nodes
    without a link aren't listed. No links: no rows.
    """
    x, y = links.columns[:2]
    now = keep_in_shared(links.where(F.col(x) != F.col(y))
                         .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct())
    seen = None
    while True:
        now = keep_in_shared(_star(_star(now, larger=True), larger=False))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
