"""User-facing reports (C1-C3): each returns DataFrames; the caller collects or draws them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions.columns import require_measure, round_scaled, season_label, with_calendar, with_season
from obsgrid.operators.kmeans import kmeans_fit
from obsgrid.operators.nearest import nearest_to_point
from obsgrid.operators.period_table import box_rows, period_table, season_rows
from obsgrid.operators.periods import in_order, monthly_history_wide, period_stats
from obsgrid.operators.profile import feature_names, location_profile
from obsgrid.operators.quantiles import box_stats, median_bisect, median_season
from obsgrid.schema import CLUSTER_COLOURS, MEASURES, PROFILE_INDICATORS
from obsgrid.session import shared_dir
from obsgrid.sources.scans import at_instant, map_values, month_range, station_years


def find_station(stations: DataFrame, *, lat: float, lon: float, geo: bool = True) -> str:
    """Code of the station nearest to one point ('Erreur' when there is none)."""
    return nearest_to_point(stations, lon, lat, geo)[0]


def season_report(rows: DataFrame, measure: str, keys: Sequence[str] = ("station", "year"),
                  method: str = "exact") -> DataFrame:
    """Year / month / season mean, min, max with the median (``method``: exact / percentile / approx) and the
    bisection median on the season rows.

    The exact form takes all from one table of value counts (``period_table``); the other methods, and seasons
    too large for its windows, are an aggregation each, joined.
    """
    keys = list(keys)
    if method == "exact":
        table = period_table(rows, measure, keys)
        if table is not None:
            return season_rows(table, measure, keys).withColumn("season_label", season_label("season"))
    stats = period_stats(rows, measure, keys)
    med = median_season(rows, measure, keys + ["season"], method=method).drop("n")
    bis = median_bisect(rows, measure, keys + ["season"]).drop("n", "converged")

    def attach(left: DataFrame, right: DataFrame) -> DataFrame:
        # keys match null-safely; the season plainly (month and year rows have none)
        r = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
        cond = F.col("season") == F.col("_r_season")
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        extra = [c for c in right.columns if c not in keys and c != "season"]
        return left.join(r, cond, "left").select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in extra])

    return attach(attach(stats, med), bis).withColumn("season_label", season_label("season"))


def station_report(spark: SparkSession, obs: DataFrame, stations: DataFrame, *, lat: float, lon: float,
                   year: int, measure: str = "temperature_f", history: tuple[int, int] = (2005, 2014),
                   geo: bool = True, method: str = "exact", measures: Sequence[str] = MEASURES) -> dict[str, DataFrame]:
    """Report for the station nearest to (lat, lon).

    Keys of the result: ``station`` (one-row frame), ``seasons`` (season_report
    of the year), ``box`` (box statistics per season), ``history`` (one row per
    year of ``history`` with twelve monthly means). The year's rows are read
    once, by a scan of the station's partition: the exact form counts their values, and both of the year's tables come
    from one kept table of a few rows; else the rows are kept.
    """
    require_measure(obs, measure, numeric=True, measures=measures)
    code = find_station(stations, lat=lat, lon=lon, geo=geo)
    shared_dir(spark)
    rows = with_season(with_calendar(station_years(obs, code, year)))
    rows = rows.select("station", "year", "month", "season", measure)
    hist_rows = station_years(obs, code, history[0], history[1])
    table = period_table(rows, measure) if method == "exact" else None
    if table is not None:
        table = table.checkpoint(eager=True)
        seasons = season_rows(table, measure).withColumn("season_label", season_label("season"))
        box = box_rows(table, measure)
    else:
        year_rows = rows.checkpoint(eager=True)
        seasons = season_report(year_rows, measure, method=method)
        box = box_stats(year_rows, measure, ("station", "year", "season"), method=method)
    # one station's rows: the frames are a few dozen rows, sorted for drawing
    return {
        "station": spark.range(1).select(F.lit(code).alias("station")),
        "seasons": seasons.orderBy("level", "month", "season"),
        "box": in_order(box),
        "history": in_order(monthly_history_wide(hist_rows, measure, ("station",))),
    }


def map_slice(obs_time: DataFrame, when: dt.datetime, measure: str, bbox: bool = False,
              ts: str = "valid_date", measures: Sequence[str] = MEASURES) -> DataFrame:
    """longitude, latitude, value of one measure at one instant (C2); may be empty."""
    require_measure(obs_time, measure, measures=measures)
    return map_values(at_instant(obs_time, when, ts=ts), measure, bbox=bbox)


def cluster_report(obs_time: DataFrame, first_month: str, last_month: str, k: int = 3,
                   indicators: Sequence[str] = PROFILE_INDICATORS, rounds: int = 10, init: str = "random",
                   seed: int = 0, compat_end: bool = False, decimals: int | None = 6,
                   measures: Sequence[str] = MEASURES) -> DataFrame:
    """Cluster the locations by their profile over a month range.

    Columns: longitude, latitude, cluster, colour (NULL above 8 clusters) and
    the mean of each indicator. The first centres are k places drawn at random
    by ``seed`` (``init="first"``: the first k by coordinates). ``decimals`` rounds the features first, which
    keeps labels stable against last-bit differences of the sums.
    """
    for ind in indicators:
        require_measure(obs_time, ind, numeric=True, measures=measures)
    rows = month_range(obs_time, first_month, last_month, compat_end)
    prof = location_profile(rows, indicators)
    feats = feature_names(indicators)
    if decimals is not None:
        prof = prof.select("longitude", "latitude", *[round_scaled(f, decimals).alias(f) for f in feats])
    labelled, _ = kmeans_fit(prof, feats, ("longitude", "latitude"), k=k, rounds=rounds, init=init, seed=seed)
    pairs = []
    for i, c in sorted(CLUSTER_COLOURS.items()):
        pairs += [F.lit(i), F.lit(c)]
    return labelled.select(
        "longitude", "latitude", "cluster",
        F.try_element_at(F.create_map(*pairs), F.col("cluster")).alias("colour"),
        *[F.col(f"{ind}_avg") for ind in indicators],
    )
