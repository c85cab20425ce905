"""CSV -> clean -> both layouts -> the three reports, on the stored layouts."""

import datetime as dt
import os
import random

from obsgrid.operators.stations import station_dimension
from obsgrid.plans.reports import cluster_report, map_slice, station_report
from obsgrid.schema import OBSERVATION_SCHEMA, TIME_SCHEMA
from obsgrid.sources.csv_ingest import ORDER_COLS, clean, read_raw
from obsgrid.sources.layouts import read_layout, upsert_station, upsert_time
from test_ingest import HEADER

STATIONS = {"LIRA": (12.59, 41.80), "LIML": (9.28, 45.45), "LICC": (15.06, 37.47)}


def make_csv(path):
    rnd = random.Random(4)
    lines = [HEADER]
    t = dt.datetime(2010, 1, 1, 0, 50)
    while t < dt.datetime(2012, 1, 1):
        for code, (lon, lat) in STATIONS.items():
            temp = 50 + 20 * ((t.month - 1) / 11) - (lat - 40) + rnd.gauss(0, 3)
            f = [code, t.strftime("%Y-%m-%d %H:%M"), str(lon), str(lat), f"{temp:.1f}", f"{temp - 8:.1f}",
                 f"{rnd.uniform(40, 90):.1f}", "180", f"{rnd.uniform(0, 20):.1f}", "0", f"{rnd.uniform(29.5, 30.5):.2f}",
                 "null", "6.2", "null", "FEW", "   ", "null", "null", "1000", "null", "null", "null", "null",
                 "null", "null", "null", "null", "null", "null", "null", f"{code} METAR"]
            lines.append(",".join(f))
        t += dt.timedelta(hours=7)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_reports_on_layouts(spark, workdir):
    src = os.path.join(workdir, "obs.csv")
    make_csv(src)
    good, rejects = clean(read_raw(spark, src))
    assert rejects.count() == 0
    st_path, tm_path = os.path.join(workdir, "station"), os.path.join(workdir, "time")
    upsert_station(spark, good, st_path, order=ORDER_COLS)
    upsert_time(spark, good, tm_path, order=ORDER_COLS)
    obs = read_layout(spark, st_path, OBSERVATION_SCHEMA)
    obs_t = read_layout(spark, tm_path, TIME_SCHEMA)
    assert obs.count() == obs_t.count() == good.count()

    stations = station_dimension(good, order=list(ORDER_COLS))
    rep = station_report(spark, obs, stations, lat=41.9, lon=12.5, year=2011, history=(2010, 2011))
    assert rep["station"].collect()[0].station == "LIRA"
    seasons = rep["seasons"].collect()
    assert {r.level for r in seasons} == {"year", "month", "season"}
    assert sorted(r.season for r in seasons if r.level == "season") == [1, 2, 3, 4]
    assert all(r.median_temperature_f is not None for r in seasons if r.level == "season")
    assert len(rep["box"].collect()) == 4
    hist = rep["history"].collect()
    assert sorted(r.year for r in hist) == [2010, 2011] and all(r.m12 is not None for r in hist)
    # the report's scan prunes to one station's folders
    plan = obs.where("station = 'LIRA' AND year = 2011")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in plan

    m = map_slice(obs_t, dt.datetime(2010, 1, 1, 0, 50), "temperature_f").collect()
    assert len(m) == 3 and all(isinstance(r.value, float) for r in m)
    assert map_slice(obs_t, dt.datetime(2010, 1, 1, 0, 51), "temperature_f").count() == 0

    c = cluster_report(obs_t, "2010-01", "2011-12", k=2).collect()
    assert len(c) == 3 and {r.colour for r in c} <= {"lightblue", "lightgreen"}


def test_season_report_keeps_null_station(spark):
    from obsgrid.plans.reports import season_report

    df = spark.createDataFrame([(None, dt.datetime(2011, 1, d), float(d)) for d in range(1, 6)],
                               "station string, valid_date timestamp_ntz, temperature_f double")
    rows = season_report(df, "temperature_f").collect()
    season = [r for r in rows if r.level == "season"][0]
    assert season.station is None and season.median_temperature_f == 3.0 and season.bisect_temperature_f is not None
