import datetime as dt

import pytest

from obsgrid.functions.columns import complete_rows, month_bounds
from obsgrid.operators import periods as pe


def obs(spark, rows):
    return spark.createDataFrame(
        [(s, dt.datetime(y, m, d, 12, 0), v) for s, y, m, d, v in rows],
        "station string, valid_date timestamp_ntz, t double",
    )


ROWS = [
    ("A", 2011, 1, 1, 10.0), ("A", 2011, 1, 2, 0.0), ("A", 2011, 3, 1, 20.0), ("A", 2011, 4, 1, None),
    ("A", 2011, 7, 1, 30.0), ("A", 2012, 12, 1, 5.0), ("B", 2011, 1, 1, 7.0),
]


def test_avg_month_and_season(spark):
    df = obs(spark, ROWS)
    m = {(r.station, r.year, r.month): r.avg_t for r in pe.avg_month(df, "t").collect()}
    assert m[("A", 2011, 1)] == pytest.approx(5.0)  # zero kept
    assert ("A", 2011, 4) not in m  # only NULL values -> no row
    s = {(r.station, r.year, r.season): r.avg_t for r in pe.avg_season(df, "t").collect()}
    assert s[("A", 2011, 1)] == pytest.approx(10.0)
    assert s[("A", 2011, 3)] == pytest.approx(30.0)
    assert s[("A", 2012, 4)] == pytest.approx(5.0)


def test_avg_year_range_inclusive(spark):
    df = obs(spark, ROWS)
    got = {(r.station, r.year) for r in pe.avg_year(df, "t", first_year=2011, last_year=2011).collect()}
    assert got == {("A", 2011), ("B", 2011)}


def test_minmax_and_midrange(spark):
    df = obs(spark, ROWS)
    r = {x.season: x for x in pe.season_midrange(df, "t").where("station = 'A' AND year = 2011").collect()}
    assert (r[1].n, r[1].min_t, r[1].max_t, r[1].mid_t) == (3, 0.0, 20.0, 10.0)
    mm = {x.month: (x.min_t, x.max_t) for x in pe.minmax_month(df, "t").where("station = 'A'").collect()}
    assert mm[1] == (0.0, 10.0)


def test_history_wide_gaps(spark):
    df = obs(spark, ROWS)
    w = {(r.station, r.year): r for r in pe.monthly_history_wide(df, "t").collect()}
    a = w[("A", 2011)]
    assert a.m01 == pytest.approx(5.0) and a.m02 is None and a.m04 is None and a.m07 == pytest.approx(30.0)


def test_period_stats_levels(spark):
    df = obs(spark, ROWS)
    rows = pe.period_stats(df, "t").where("station = 'A' AND year = 2011").collect()
    levels = sorted((r.level, r.month, r.season) for r in rows)
    assert ("year", None, None) in levels
    assert ("month", 1, None) in levels and ("season", None, 1) in levels
    year = [r for r in rows if r.level == "year"][0]
    assert year.n == 4 and year.avg_t == pytest.approx(15.0)


def test_season_labels(spark):
    df = obs(spark, ROWS)
    labels = {r.season: r.season_label for r in pe.season_labels(df, "t").collect()}
    assert labels[1] == "printemps" and labels[3] == "automne" and labels[4] == "hiver"


def test_complete_rows_keeps_nan_and_zero(spark):
    df = spark.createDataFrame([(1, 0.0, float("nan")), (2, None, 1.0), (3, 1.0, 2.0)], "k int, a double, b double")
    assert sorted(r.k for r in complete_rows(df, ["a", "b"]).collect()) == [1, 3]


def test_month_bounds():
    lo, hi, incl = month_bounds("2011-01", "2011-10")
    assert (lo, hi, incl) == (dt.datetime(2011, 1, 1), dt.datetime(2011, 11, 1), False)
    lo, hi, incl = month_bounds("2011-01", "2011-10", compat_end=True)
    assert (hi, incl) == (dt.datetime(2011, 10, 31), True)
    lo, hi, incl = month_bounds("2011-01", "2011-09", compat_end=True)
    assert (hi, incl) == (dt.datetime(2011, 10, 1), False)
    assert month_bounds("2011-12", "2011-12")[1] == dt.datetime(2012, 1, 1)


def test_measure_checked_by_name(spark):
    from obsgrid.functions.columns import require_measure

    df = spark.createDataFrame([(1.0, "x")], "temperature_f double, weather_code string")
    assert require_measure(df, "temperature_f", numeric=True) == "temperature_f"
    with pytest.raises(ValueError):
        require_measure(df, "tmpf")
    with pytest.raises(ValueError):
        require_measure(df, "weather_code", numeric=True)


def test_minmax_on_text_and_timestamp(spark):
    df = spark.createDataFrame(
        [("A", dt.datetime(2011, 1, 1), "BKN", dt.datetime(2011, 1, 1, 5)),
         ("A", dt.datetime(2011, 1, 2), "FEW", dt.datetime(2011, 1, 2, 7)),
         ("A", dt.datetime(2011, 1, 3), None, None)],
        "station string, valid_date timestamp_ntz, sky string, peak timestamp_ntz")
    r = pe.minmax_month(df, "sky").collect()[0]
    assert (r.min_sky, r.max_sky) == ("BKN", "FEW")
    r = pe.minmax_season(df, "peak").collect()[0]
    assert r.max_peak == dt.datetime(2011, 1, 2, 7)


def test_frames_with_year_and_month_only(spark):
    df = spark.createDataFrame([("A", 2011, 1, 2.0), ("A", 2011, 4, 4.0)], "station string, year int, month int, t double")
    got = {(r.level, r.month, r.season): r.avg_t for r in pe.period_stats(df, "t").collect()}
    assert got[("year", None, None)] == 3.0 and got[("season", None, 2)] == 4.0
    with pytest.raises(ValueError):
        pe.avg_month(df.drop("month"), "t")


def test_month_bounds_rejects_bad_text():
    for bad in ("2011", "2011-13", "x-01"):
        with pytest.raises(ValueError):
            month_bounds(bad, "2011-12")


def test_results_in_reading_order(spark):
    df = obs(spark, ROWS)
    months = pe.in_order(pe.avg_month(df, "t")).collect()
    assert [(r.station, r.year, r.month) for r in months] == sorted((r.station, r.year, r.month) for r in months)
    years = pe.in_order(pe.monthly_history(df, "t")).collect()
    assert [(r.station, r.year, r.month) for r in years] == sorted((r.station, r.year, r.month) for r in years)
    seasons = pe.in_order(pe.avg_season(df, "t"), ()).collect()
    assert [(r.year, r.season) for r in seasons] == sorted((r.year, r.season) for r in seasons)


def test_measures_are_picked_by_name(spark):
    from obsgrid.functions.columns import require_measure

    df = spark.createDataFrame([("A", 1.0, "x")], "station string, temperature_f double, weather_code string")
    assert require_measure(df, "temperature_f", numeric=True) == "temperature_f"
    assert require_measure(df, "weather_code") == "weather_code"
    for name, numeric in (("station", False), ("weather_code", True), ("visibility", False), ("nothing", False)):
        with pytest.raises(ValueError):
            require_measure(df, name, numeric=numeric)
