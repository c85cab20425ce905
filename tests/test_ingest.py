import os

import pytest
from pyspark.sql import functions as F

from obsgrid.operators.stations import station_dimension
from obsgrid.sources.csv_ingest import ORDER_COLS, clean, read_raw, read_station_list, write_station_list

HEADER = ("station,valid,lon,lat,tmpf,dwpf,relh,drct,sknt,p01i,alti,mslp,vsby,gust,skyc1,skyc2,skyc3,skyc4,"
          "skyl1,skyl2,skyl3,skyl4,wxcodes,ice_accretion_1hr,ice_accretion_3hr,ice_accretion_6hr,"
          "peak_wind_gust,peak_wind_drct,peak_wind_time,feel,metar")


def line(station, valid, lon="12.5", lat="41.8", tmpf="50.0", skyc1="FEW", metar="LIRA 011250Z", feel="null",
         peak="null"):
    f = [station, valid, lon, lat, tmpf, "40.0", "null", "   ", "5.0", "0", "30.1", "null", "6.2", "null",
         skyc1, "   ", "null", "null", "1000", "null", "null", "null", "null", "null", "null", "null", "null",
         "null", peak, feel, metar]
    return ",".join(f)


@pytest.fixture()
def csv_path(workdir):
    rows = [
        HEADER,
        line("LIRA", "2011-01-01 12:50"),
        line("LIRA", "2011-01-01 13:50:00", tmpf="0", metar='"LIRA ""quoted"", text"'),
        line("LIRF", "2011-04-02 00:20", lon="12.2", lat="41.7", tmpf="   ", skyc1="   "),
        line("LIRF", "garbage", lon="12.2", lat="41.7"),
        line("LIRF", "2011-13-02 00:20", lon="12.2", lat="41.7"),
        line("LIRA", "2011-07-01 12:50", tmpf="M"),
        line("LIRA", "2011-07-01 13:50", tmpf="NaN", peak="2011-07-01 13:20"),
        line("LIRA", "2011-01-01 12:50", tmpf="51.0", lon="99.0"),
    ]
    p = os.path.join(workdir, "obs.csv")
    with open(p, "w") as f:
        f.write("\n".join(rows) + "\n")
    return p


def test_clean_rules(spark, csv_path):
    raw = read_raw(spark, csv_path)
    good, rejects = clean(raw)
    g = good.orderBy(*ORDER_COLS).collect()
    assert len(g) == 6
    first = g[0]
    assert (first.station, first.year, first.month, first.day, first.hour, first.minute) == ("LIRA", 2011, 1, 1, 12, 50)
    assert first.temperature_f == pytest.approx(50.0)
    assert first.relative_humidity is None and first.wind_direction is None  # null and three blanks
    assert first.temperature is None and first.sky_level1_coverage == "FEW"
    # trailing seconds allowed, zero kept, quoted text with doubled quotes and a comma
    assert g[1].minute == 50 and g[1].temperature_f == 0.0
    assert g[1].observation == 'LIRA "quoted", text'
    # sentinel text -> NULL
    assert g[2].temperature_f is None and g[2].sky_level1_coverage is None
    # month 13: kept for the station layout, no real instant
    assert g[3].month == 13 and g[3].valid_date is None
    # NaN -> NULL, timestamp parsed
    assert g[4].temperature_f is None
    assert str(g[4].peak_wind_time) == "2011-07-01 13:20:00"
    rej = {r.valid: r.reason for r in rejects.collect()}
    assert rej == {"garbage": "valid", "2011-07-01 12:50": "tmpf"}


def test_clean_strict_raises(spark, csv_path):
    with pytest.raises(ValueError):
        clean(read_raw(spark, csv_path), strict=True)


def test_station_dimension_first_seen(spark, csv_path, workdir):
    good, _ = clean(read_raw(spark, csv_path))
    dim = station_dimension(good, order=list(ORDER_COLS)).orderBy("ord").collect()
    assert [r.station for r in dim] == ["LIRA", "LIRF"]
    assert dim[0].longitude == pytest.approx(12.5)  # first row of LIRA, not the later 99.0
    out = os.path.join(workdir, "stations")
    write_station_list(station_dimension(good, order=list(ORDER_COLS)), out)
    back = read_station_list(spark, out).orderBy("ord").collect()
    assert [(r.station, round(r.longitude, 4)) for r in back] == [("LIRA", 12.5), ("LIRF", 12.2)]


def test_binding_cleaning_counts(spark):
    from obsgrid.sources import bindings as b

    good, bad = clean(b.raw_text(spark, "/root/testdata/sf0.001"))
    total = b.raw_text(spark, "/root/testdata/sf0.001").count()
    assert good.count() + bad.count() == total
    assert bad.where(F.col("reason") == "valid").count() > 0


def test_multiline_quoted_text(spark, workdir):
    p = os.path.join(workdir, "ml.csv")
    with open(p, "w") as f:
        f.write(HEADER + "\n" + line("LIRA", "2011-01-01 12:50", metar='"first line\nsecond line"') + "\n")
    good, _ = clean(read_raw(spark, p, multiline=True))
    assert good.collect()[0].observation == "first line\nsecond line"


def test_bad_timestamp_field_rejected(spark, workdir):
    p = os.path.join(workdir, "ts.csv")
    with open(p, "w") as f:
        f.write("\n".join([HEADER, line("LIRA", "2011-01-01 12:50", peak="not a time"),
                           line("LIRA", "2011-01-01 13:50", peak="2011-01-01 13:05")]) + "\n")
    good, rejects = clean(read_raw(spark, p))
    assert [r.reason for r in rejects.collect()] == ["peak_wind_time"]
    assert good.count() == 1


def test_row_without_station_rejected(spark, workdir):
    p = os.path.join(workdir, "nost.csv")
    with open(p, "w") as f:
        f.write("\n".join([HEADER, line("", "2011-01-01 12:50"), line("LIRA", "2011-01-01 12:50")]) + "\n")
    good, rejects = clean(read_raw(spark, p))
    assert [r.reason for r in rejects.collect()] == ["station"]
    assert [r.station for r in good.collect()] == ["LIRA"]


def test_files_are_read_by_their_own_headers(spark, workdir):
    """Reordered, missing and unknown columns go by name, not by place."""
    folder = os.path.join(workdir, "mixed")
    os.mkdir(folder)
    files = {"a.csv": "station,valid,lon,lat,tmpf,dwpf\nLIRA,2011-01-01 12:50,12.5,41.8,50,40\n",
             "b.csv": "valid,station,lat,lon,dwpf,tmpf,extra,extra\n2011-01-01 13:50,LIRF,41.7,12.2,41,51,x,y\n",
             "c.csv": "lon,lat,station,valid\n9.0,45.0,LIML,2011-01-01 14:50\n", "d.csv": ""}
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    good, rejects = clean(read_raw(spark, folder))
    assert rejects.count() == 0
    got = {r.station: (r.longitude, r.latitude, r.temperature_f, r.dew_point_f) for r in good.collect()}
    assert {s: tuple(None if x is None else round(x, 4) for x in v) for s, v in got.items()} == {
        "LIRA": (12.5, 41.8, 50.0, 40.0), "LIRF": (12.2, 41.7, 51.0, 41.0), "LIML": (9.0, 45.0, None, None)}
    with open(os.path.join(folder, "e.csv"), "w") as f:
        f.write("station,lon,lat\nX,1,2\n")
    with pytest.raises(ValueError):
        read_raw(spark, folder)


@pytest.mark.parametrize("text,value,reason", [
    ("12F", None, "tmpf"), ("1d", None, "tmpf"), ("0x1A", None, "tmpf"), ("1,5", None, "tmpf"), ("1e", None, "tmpf"),
    ("1e2", 100.0, None), ("-.5", -0.5, None), (" 7. ", 7.0, None), ("Infinity", None, None), ("-inf", None, None),
    ("nan", None, None), ("1e99", None, None), ("", None, None)])
def test_numbers_are_strict(spark, text, value, reason):
    raw = spark.createDataFrame([("S", "2011-01-01 00:00", "1", "2", text)], "station string, valid string, lon string, "
                                "lat string, tmpf string")
    if text == "":
        raw = raw.withColumn("tmpf", F.lit(None).cast("string"))
    good, rejects = clean(raw)
    if reason:
        assert [r.reason for r in rejects.collect()] == [reason]
    else:
        assert [r.temperature_f for r in good.collect()] == [value]


def test_stream_reads_by_header_and_repeats_nothing(spark, workdir):
    from obsgrid.streaming.ingest import start_ingest

    folder = os.path.join(workdir, "in")
    os.mkdir(folder)
    paths = [os.path.join(workdir, n) for n in ("st", "ti", "rejects", "ckpt")]
    for name, text in (("a.csv", "station,valid,lon,lat,tmpf\nA,2011-01-01 12:50,1,2,3\nA,bad,1,2,3\n"),
                       ("b.csv", "tmpf,lat,lon,valid,station\n4,2,1,2011-01-01 13:50,A\n")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
        for _ in range(2):
            start_ingest(spark, folder, paths[0], paths[1], checkpoint=paths[3], rejects_path=paths[2]).awaitTermination()
    stored = spark.read.parquet(paths[0]).collect()
    assert sorted((r.hour, r.temperature_f, r.longitude) for r in stored) == [(12, 3.0, 1.0), (13, 4.0, 1.0)]
    assert spark.read.parquet(paths[2]).count() == 1


def test_fields_are_read_in_arrays_with_few_matches(spark):
    """A field's text is matched for its number in one place of the reject test and in one of the values, not in one expression per use."""
    from obsgrid.schema import RAW_FIELDS

    row = {f: "1" for f in RAW_FIELDS} | {"station": "A", "valid": "2011-01-01 12:50:07", "peak_wind_time": "null", "skyc1": "   ", "gust": "1e39"}
    raw = spark.createDataFrame([tuple(row[f] for f in RAW_FIELDS)] * 2, ", ".join(f"{f} string" for f in RAW_FIELDS)).repartition(1)
    good, rejects = clean(raw, carry=())
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < 50 and plan.count("regexp_extract") <= 3
    got = good.collect()
    assert len(got) == 2 and got[0].wind_gust is None and got[0].temperature_f == 1.0 and got[0].sky_level1_coverage is None
    assert (got[0].year, got[0].minute, str(got[0].valid_date)) == (2011, 50, "2011-01-01 12:50:00")
    assert rejects.count() == 0
