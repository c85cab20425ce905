"""Per-location statistical profile of several indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.columns import complete_rows

STATS = ("min", "max", "avg", "var")


def feature_names(indicators: Sequence[str]) -> list[str]:
    """Feature order: per indicator, min, max, mean, population variance."""
    return [f"{ind}_{s}" for ind in indicators for s in STATS]


def location_profile(obs: DataFrame, indicators: Sequence[str],
                     keys: Sequence[str] = ("longitude", "latitude")) -> DataFrame:
    """min, max, mean and population variance of each indicator per location.

    Only rows with every indicator present take part (listwise). One hash
    aggregation with partial aggregation: a location holding a large share of
    the rows is reduced in every map task before the shuffle.
    """
    df = complete_rows(obs, indicators)
    aggs = []
    for ind in indicators:
        v = F.col(ind).cast("double")
        aggs += [F.min(v).alias(f"{ind}_min"), F.max(v).alias(f"{ind}_max"),
                 F.avg(v).alias(f"{ind}_avg"), F.var_pop(v).alias(f"{ind}_var")]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)
