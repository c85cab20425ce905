"""Station dimension from observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def station_dimension(obs: DataFrame, order: Sequence[str] = ("seq",), station: str = "station") -> DataFrame:
    """Distinct stations with the coordinates of their first row and that row's order.

    One aggregation with partial aggregation (min / min_by merge map-side), so a
    station holding a large share of the rows costs no more than any other.
    Columns: station, longitude, latitude, ord. Sort by ``ord`` for first-seen order.
    """
    if len(order) == 1 and isinstance(obs.schema[order[0]].dataType, T.NumericType):
        # fixed-width buffers: hash aggregation (the order is unique per row, so
        # both coordinates come from the same row)
        o = F.col(order[0])
        return obs.groupBy(F.col(station).alias("station")).agg(
            F.min_by("longitude", o).alias("longitude"), F.min_by("latitude", o).alias("latitude"),
            F.min(o).alias("ord"))
    o = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    return obs.groupBy(F.col(station).alias("station")).agg(
        F.min_by(F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")), o).alias("_c"),
        F.min(o).alias("ord"),
    ).select("station", F.col("_c.lon").alias("longitude"), F.col("_c.lat").alias("latitude"), "ord")
