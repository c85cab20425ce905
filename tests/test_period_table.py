"""The report's value-count table against the separate aggregations, and its number of jobs."""

import datetime as dt
import math
import random

from obsgrid.operators import period_table as P
from obsgrid.operators import quantiles as Q
from obsgrid.operators.periods import period_stats
from obsgrid.plans import reports


def _rows(spark, values=None):
    rnd = random.Random(11)
    data = []
    for st in ("A", "B", None):
        for i in range(400):
            t = dt.datetime(2011, 1, 1) + dt.timedelta(hours=21 * i + rnd.randrange(5))
            v = rnd.choice(values) if values else rnd.choice([round(rnd.gauss(10, 5), 1), round(rnd.gauss(10, 60), 1), None, 0.0])
            data.append((st, t, v))
    return spark.createDataFrame(data, "station string, valid_date timestamp_ntz, temperature_f double")


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-9 * max(1.0, abs(a))
    return a == b


def _same(left, right, keys):
    assert left.columns == right.columns
    a, b = ({tuple(r[k] for k in keys): r for r in df.collect()} for df in (left, right))
    assert a.keys() == b.keys() and len(a) > 0
    for k, r in a.items():
        for c in left.columns:
            assert _close(r[c], b[k][c]), (k, c, r[c], b[k][c])


def _agree(rows):
    keys = ["station", "year"]
    table = P.period_table(rows, "temperature_f", keys)
    _same(P.season_rows(table, "temperature_f", keys).drop("median_temperature_f", "bisect_temperature_f"),
          period_stats(rows, "temperature_f", keys), [*keys, "level", "month", "season"])
    _same(P.box_rows(table, "temperature_f", keys), Q.box_stats(rows, "temperature_f", [*keys, "season"]), [*keys, "season"])
    season = table.where("level = 'season'")
    for single in (Q.median_season(rows, "temperature_f").drop("n"), Q.median_bisect(rows, "temperature_f").drop("n", "converged")):
        _same(season.select(single.columns), single, [*keys, "season"])


def test_one_task_and_dealt_agree_with_the_separate_forms(spark, monkeypatch):
    rows = _rows(spark).cache()
    _agree(rows)
    monkeypatch.setattr(P, "ONE_TASK_ROWS", 0)
    _agree(rows)


def test_ties_and_odd_values(spark):
    _agree(_rows(spark, [3.0]))
    _agree(_rows(spark, [1.0, 2.0, float("inf"), float("-inf"), float("nan")]))


def test_no_rows_and_other_types(spark):
    from pyspark.sql import functions as F

    rows = _rows(spark)
    assert P.period_table(rows.where("false"), "temperature_f").count() == 0
    whole = rows.withColumn("temperature_f", F.col("temperature_f").cast("int"))
    assert dict(P.period_table(whole, "temperature_f").dtypes)["min_temperature_f"] == "int"
    _agree(whole)


def test_large_seasons_take_the_distributed_form(spark, monkeypatch):
    rows = _rows(spark).cache()
    expected = {tuple(r) for r in reports.season_report(rows, "temperature_f").collect()}
    monkeypatch.setattr(Q, "DIRECT_ROWS", 10)
    assert P.period_table(rows, "temperature_f") is None
    got = reports.season_report(rows, "temperature_f")
    assert len(expected) == got.count() and "median_temperature_f" in got.columns


def test_report_of_a_year_is_one_scan_and_three_jobs(spark, workdir):
    import os

    path = os.path.join(workdir, "rows")
    _rows(spark).write.parquet(path)
    rows = spark.read.parquet(path)
    sc = spark.sparkContext
    sc.setJobGroup("year-report", "jobs of the year's tables")
    try:
        table = P.period_table(rows, "temperature_f")
        table.write.parquet(os.path.join(workdir, "table"))
        jobs = sc.statusTracker().getJobIdsForGroup("year-report")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 3
    plan = table._jdf.queryExecution().executedPlan().toString()
    # one scan, and that of the counts; no shuffle after them
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
