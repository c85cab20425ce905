"""One table of value counts behind all statistics of a report.

The rows are read once and counted per (keys, season, month, value), added up
before the shuffle. All else comes from these counts: means and extremes per
year, month and season, exact quartiles and median, the bisection median, the
box's whiskers and its number of outliers. A value's count stands for all its
rows, so sums are weighted and ranks are running sums of counts.

The counts are kept in the shared folder and their number is observed while
they are written. Where they are few (a station's year) one task does the rest
without a shuffle; where they are more they are dealt by (keys, season) once,
and every further step keeps that partitioning. A season with more than
``DIRECT_ROWS`` different counts is no window's work: the caller is told, and
takes the distributed quantiles instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from obsgrid.functions.columns import complete_rows, with_calendar, with_season
from obsgrid.operators import quantiles
from obsgrid.session import scratch_path

#: counts up to which one task does all the rest
ONE_TASK_ROWS = 200_000
ROUNDS = 10


def value_counts(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """Rows (keys, season, month, _x, _m): each value of the measure and how often it occurs; NULL is left out."""
    rows = complete_rows(with_season(with_calendar(obs)), [measure])
    return rows.groupBy(*keys, "season", "month", F.col(measure).alias("_x")).agg(F.count(F.lit(1)).alias("_m"))


def _quantile(p: float, over: Window) -> Column:
    """The quantile at p of a group whose rows hold the ranks from _upto - _m up to _upto."""
    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_m")), F.col("_v"))).over(over)

    pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
    lo, hi = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
    return F.when(lo == hi, at(lo)).otherwise((hi - pos) * at(lo) + (pos - lo) * at(hi))


def period_table(obs: DataFrame, measure: str, keys: Sequence[str] = ("station", "year"), whis: float = 1.5,
                 rounds: int = ROUNDS) -> DataFrame | None:
    """Year, month and season rows with all statistics, or None where a season is too large for a window.

    Columns: keys, month, season, level, n, avg_, min_, max_ of the measure as
    ``period_stats`` has them; on season rows also median_ and bisect_ of the
    measure, q1, q3, whisker_lo, whisker_hi and n_outliers. Rows whose key
    holds a NULL are a group like any other. No rows give no rows.
    """
    keys = list(keys)
    spark = obs.sparkSession
    seen = Observation()
    counted = value_counts(obs, measure, keys)
    path = scratch_path(spark, "value-counts")
    counted.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    counts = spark.read.schema(counted.schema).parquet(path)
    total = seen.get["rows"]
    if total > quantiles.DIRECT_ROWS:
        widest = counts.groupBy(*keys, "season").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
        if widest > quantiles.DIRECT_ROWS:
            return None
    dealt = counts.coalesce(1) if total <= ONE_TASK_ROWS else counts.repartition(*[F.col(k) for k in [*keys, "season"]])

    group = Window.partitionBy(*keys, "season")
    walk = group.orderBy("_v", "month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.withColumn("_v", F.col("_x").cast("double")).select(
        "*", F.sum("_m").over(walk).alias("_upto"), F.sum("_m").over(group).alias("_n"),
        F.min("_v").over(group).alias("_lo0"), F.max("_v").over(group).alias("_hi0"))
    boxed = ranked.select("*", *[_quantile(p, group).alias(c) for p, c in zip(quantiles.QUARTILES, ("_q1", "_q2", "_q3"))])
    v, iqr = F.col("_v"), F.col("_q3") - F.col("_q1")
    fenced = quantiles.leaves(boxed.withColumns({"_lo_f": F.col("_q1") - F.lit(whis) * iqr, "_hi_f": F.col("_q3") + F.lit(whis) * iqr}), rounds)
    # one value for each season, the same on all its rows
    fixed = ("_lo0", "_hi0", "_q1", "_q2", "_q3")
    cells = fenced.groupBy(*keys, "season", "month", "_leaf").agg(
        F.sum("_m").alias("_m"), F.sum(v * F.col("_m")).alias("_sum"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
        F.min(F.when(v >= F.col("_lo_f"), v)).alias("_w_lo"), F.max(F.when(v <= F.col("_hi_f"), v)).alias("_w_hi"),
        F.sum(F.when((v < F.col("_lo_f")) | (v > F.col("_hi_f")), F.col("_m")).otherwise(0)).alias("_out"),
        *[F.first(c).alias(c) for c in fixed])
    leaf = F.struct(F.col("_leaf").alias("leaf"), F.col("_m").alias("cnt"))
    added = [F.sum("_m").alias("_m"), F.sum("_sum").alias("_sum"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
             F.min("_w_lo").alias("_w_lo"), F.max("_w_hi").alias("_w_hi"), F.sum("_out").alias("_out"), *[F.first(c).alias(c) for c in fixed]]
    months = cells.groupBy(*keys, "season", "month").agg(*added, F.collect_list(leaf).alias("_cells"))
    # at most twelve rows per key, each a part of its year, its month and its season; unlike grouping sets this keeps a single partition
    none = F.lit(None).cast("int")
    parts = F.explode(F.array(*[F.struct(F.lit(name).alias("level"), m.alias("month"), q.alias("season")) for name, m, q in (
        ("year", none, none), ("month", F.col("month").cast("int"), none), ("season", none, F.col("season").cast("int")))])).alias("_part")
    spread = months.select(*keys, *[c for c in months.columns if c not in {*keys, "month", "season"}], parts)
    spread = spread.select(*keys, "_part.*", *[c for c in spread.columns if c not in {*keys, "_part", "_cells"}],
                           F.when(F.col("_part.level") == "season", F.col("_cells")).alias("_cells"))
    rolled = spread.groupBy(*keys, "month", "season", "level").agg(
        *added, F.flatten(F.collect_list("_cells")).alias("_cells")).withColumnRenamed("_m", "n")
    own = F.col("level") == "season"
    seasons_only = ["_w_lo", "_w_hi", "_out", *fixed]
    known = rolled.withColumns({c: F.when(own, F.col(c)) for c in seasons_only})
    done = quantiles.replayed(known, rounds)
    return done.select(
        *keys, "month", "season", "level", "n", (F.col("_sum") / F.col("n")).alias(f"avg_{measure}"),
        F.col("_min").alias(f"min_{measure}"), F.col("_max").alias(f"max_{measure}"),
        F.col("_q2").alias(f"median_{measure}"), F.col("_mid").alias(f"bisect_{measure}"),
        F.col("_q1").alias("q1"), F.col("_q3").alias("q3"), F.col("_w_lo").alias("whisker_lo"), F.col("_w_hi").alias("whisker_hi"),
        F.col("_out").alias("n_outliers"))


def season_rows(table: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """The columns of ``season_report`` without the label."""
    return table.select(*keys, "month", "season", "level", "n", *[f"{a}_{measure}" for a in ("avg", "min", "max", "median", "bisect")])


def box_rows(table: DataFrame, measure: str, keys: Sequence[str] = ("station", "year")) -> DataFrame:
    """The columns of ``box_stats``."""
    return table.where("level = 'season'").select(
        *keys, "season", "n", F.col(f"min_{measure}").cast("double").alias("min"), "q1", F.col(f"median_{measure}").alias("median"), "q3",
        F.col(f"max_{measure}").cast("double").alias("max"), "whisker_lo", "whisker_hi", "n_outliers")
