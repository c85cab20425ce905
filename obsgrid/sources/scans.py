"""Scans of the layouts (S9-S12) and the map slice filters.

Each scan states its predicate on the partition columns as well as on the
data columns, so on a stored layout Spark prunes directories
(``PartitionFilters``) and skips row groups (``PushedFilters``); on any other
observation frame the same predicates still give the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.columns import display_round, month_bounds, ts_literal, with_calendar
from obsgrid.schema import MAP_EXTENT


def _calendar(df: DataFrame, ts: str) -> DataFrame:
    return df if {"year", "month"} <= set(df.columns) else with_calendar(df, ts)


def station_years(obs: DataFrame, station: str, first_year: int, last_year: int | None = None,
                  columns: Sequence[str] | None = None, ts: str = "valid_date") -> DataFrame:
    """Rows of one station over a year range, both ends inclusive."""
    last_year = first_year if last_year is None else last_year
    df = _calendar(obs, ts).where((F.col("station") == F.lit(station))
                                  & F.col("year").between(int(first_year), int(last_year)))
    return df if columns is None else df.select(*columns)


def at_instant(obs: DataFrame, when: dt.datetime, columns: Sequence[str] | None = None,
               ts: str = "valid_date") -> DataFrame:
    """Rows of every station at one instant, minute precision."""
    when = when.replace(second=0, microsecond=0)
    df = _calendar(obs, ts).where((F.col("year") == when.year) & (F.col("month") == when.month)
                                  & (F.col(ts) == ts_literal(when)))
    return df if columns is None else df.select(*columns)


def month_range(obs: DataFrame, first_month: str, last_month: str, compat_end: bool = False,
                columns: Sequence[str] | None = None, ts: str = "valid_date") -> DataFrame:
    """Rows of all stations over a month range ``'YYYY-MM'..'YYYY-MM'``.

    Default: whole months. ``compat_end``: up to day 31 at 00:00 inclusive
    when the last month has a 31st day.
    """
    lo, hi, hi_incl = month_bounds(first_month, last_month, compat_end)
    t = F.col(ts)
    upper = (t <= ts_literal(hi)) if hi_incl else (t < ts_literal(hi))
    last_ym = hi.year * 100 + hi.month if hi_incl else (hi - dt.timedelta(days=1)).year * 100 + (hi - dt.timedelta(days=1)).month
    ym = F.col("year") * 100 + F.col("month")
    df = _calendar(obs, ts).where(ym.between(lo.year * 100 + lo.month, last_ym) & (t >= ts_literal(lo)) & upper)
    return df if columns is None else df.select(*columns)


def map_values(rows: DataFrame, measure: str, bbox: bool = False, digits: int = 2) -> DataFrame:
    """longitude, latitude, value of a slice: NULL values dropped (P2), numbers rounded.

    ``bbox`` keeps only points inside the map extent (P12).
    """
    df = rows.where(F.col(measure).isNotNull())
    if bbox:
        e = MAP_EXTENT
        df = df.where(F.col("longitude").between(e["lon_min"], e["lon_max"])
                      & F.col("latitude").between(e["lat_min"], e["lat_max"]))
    return df.select("longitude", "latitude", display_round(measure, rows.schema[measure].dataType, digits).alias("value"))
