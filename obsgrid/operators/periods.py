"""Means, extremes and counts of one measure per year / season / month.

Every function takes observation rows with the grouping keys (``station`` by
default), a timestamp ``valid_date`` or stored ``year``/``month`` columns, and
one measure column. Rows where the measure is NULL are left out (0 and NaN
stay). Each is one hash aggregation with map-side partial aggregation, so a
key holding a large share of the rows is reduced inside every map task before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.columns import complete_rows, season_label, with_calendar, with_season


def _prepared(obs: DataFrame, measure: str, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    df = with_season(with_calendar(obs))
    if first_year is not None or last_year is not None:
        lo = first_year if first_year is not None else -(2**31)
        hi = last_year if last_year is not None else 2**31 - 1
        df = df.where(F.col("year").between(lo, hi))
    return complete_rows(df, [measure])


def _mean(measure: str) -> Column:
    return F.avg(F.col(measure).cast("double")).alias(f"avg_{measure}")


def _min(measure: str) -> Column:
    return F.min(measure).alias(f"min_{measure}")


def _max(measure: str) -> Column:
    return F.max(measure).alias(f"max_{measure}")


def in_order(df: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """A period result in reading order (O1, O2): by keys, then year, season, month as far as it has them.

    For results that are shown: the rows are few aggregates, but still a range shuffle.
    """
    order = [*keys, *[c for c in ("year", "season", "month") if c not in keys]]
    return df.orderBy(*[c for c in order if c in df.columns])


def avg_year(obs: DataFrame, measure: str, keys: Sequence[str] = ("station",),
             first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Mean per year over a year range, both ends inclusive (A1)."""
    df = _prepared(obs, measure, first_year, last_year)
    return df.groupBy(*keys, "year").agg(_mean(measure))


def avg_season(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Mean per season (calendar quarter) (A2)."""
    return _prepared(obs, measure).groupBy(*keys, "season").agg(_mean(measure))


def avg_month(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Mean per month (A3)."""
    return _prepared(obs, measure).groupBy(*keys, "month").agg(_mean(measure))


def season_labels(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Mean per season with the season's label."""
    return avg_season(obs, measure, keys).withColumn("season_label", season_label("season"))


def monthly_history(obs: DataFrame, measure: str, keys: Sequence[str] = ("station",),
                    first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Mean per (year, month) over a year range, long form (A4)."""
    df = _prepared(obs, measure, first_year, last_year)
    return df.groupBy(*keys, "year", "month").agg(_mean(measure))


def monthly_history_wide(obs: DataFrame, measure: str, keys: Sequence[str] = ("station",),
                         first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """One row per year with twelve monthly means ``m01..m12``; a month without data is NULL.

    Written as conditional averages in a single aggregation instead of
    aggregate-then-pivot, so it costs one shuffle.
    """
    df = _prepared(obs, measure, first_year, last_year)
    v = F.col(measure).cast("double")
    months = [F.avg(F.when(F.col("month") == m, v)).alias(f"m{m:02d}") for m in range(1, 13)]
    return df.groupBy(*keys, "year").agg(*months)


def minmax_month(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Minimum and maximum per month (A5); also fine for text and timestamps."""
    return _prepared(obs, measure).groupBy(*keys, "month").agg(_min(measure), _max(measure))


def minmax_season(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Minimum and maximum per season."""
    return _prepared(obs, measure).groupBy(*keys, "season").agg(_min(measure), _max(measure))


def season_midrange(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Count, mean, min, max and midrange (min+max)/2 per season in one pass."""
    df = _prepared(obs, measure).groupBy(*keys, "season").agg(
        F.count(F.lit(1)).alias("n"), _mean(measure), _min(measure), _max(measure),
    )
    mid = (F.col(f"min_{measure}").cast("double") + F.col(f"max_{measure}").cast("double")) / F.lit(2.0)
    return df.withColumn(f"mid_{measure}", mid)


def period_stats(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Year, month and season statistics from one aggregation of the rows.

    Columns: keys, month (NULL unless level = 'month'), season (NULL unless
    level = 'season'), level, n, avg_, min_, max_. The rows are added up once
    per month; the grouping sets then roll up at most twelve rows per key.
    """
    keys = list(keys)
    months = _prepared(obs, measure).groupBy(*keys, "month", "season").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col(measure).cast("double")).alias("_sum"),
        F.min(measure).alias("_min"), F.max(measure).alias("_max"),
    )
    sets = [keys, keys + ["month"], keys + ["season"]]
    level = (F.when(F.grouping("month") == 0, F.lit("month"))
             .when(F.grouping("season") == 0, F.lit("season"))
             .otherwise(F.lit("year")))
    return months.groupingSets(sets, *keys, "month", "season").agg(
        level.alias("level"), F.sum("_n").alias("n"), (F.sum("_sum") / F.sum("_n")).alias(f"avg_{measure}"),
        F.min("_min").alias(f"min_{measure}"), F.max("_max").alias(f"max_{measure}"),
    )
