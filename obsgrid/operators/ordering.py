"""Position numbers of ordered results (O1, O2) without a global sort in one task.

Rows are range-partitioned by the order and numbered within their partition;
prefix sums over the partitions' counts turn these numbers into positions. Only
the counts, one per partition, meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.session import shared_dir

_PART, _ROW, _BEFORE = "_part", "_row", "_before"
# what ``monotonically_increasing_id`` keeps for the row within its partition
_ROW_BITS = (1 << 33) - 1


def with_position(df: DataFrame, order: Sequence[str | Column], position: str = "position", partitions: int | None = None) -> DataFrame:
    """Add each row's number, from 1, in the given order; NULLs come first. Rows that tie are numbered in no set order."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    shared_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    # kept, so that counts and numbers are of one and the same dealing of the rows
    dealt = (ranged.sortWithinPartitions(*order)
             .select("*", F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias(_ROW))
             .checkpoint(eager=True))
    counts = dealt.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counts.select(_PART, (F.sum("_n").over(upto) - F.col("_n")).alias(_BEFORE))
    return dealt.join(F.broadcast(before), _PART).select(*df.columns, (F.col(_BEFORE) + F.col(_ROW) + 1).alias(position))
