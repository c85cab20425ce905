import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from obsgrid.sources import layouts, scans

COLS = "station string, year int, month int, day int, hour int, minute int, t double, sky string, seq long"


def rows(spark, data):
    return spark.createDataFrame(data, COLS)


def test_upsert_last_wins_and_idempotent(spark, workdir):
    path = os.path.join(workdir, "station")
    a = rows(spark, [
        ("A", 2011, 1, 1, 12, 50, 1.0, "x", 1), ("A", 2011, 1, 1, 12, 50, 2.0, None, 2),
        ("B", 2011, 1, 1, 12, 50, 3.0, "y", 3), ("A", 2012, 1, 1, 12, 50, 4.0, "z", 4),
    ])
    t = layouts.upsert_station(spark, a, path)
    got = {(r.station, r.year): (r.t, r.sky) for r in t.collect()}
    assert got == {("A", 2011): (2.0, None), ("B", 2011): (3.0, "y"), ("A", 2012): (4.0, "z")}
    # second batch touches only (A, 2011); an existing key is replaced whole, NULLs included
    b = rows(spark, [("A", 2011, 1, 1, 12, 50, None, "new", 0), ("A", 2011, 2, 1, 0, 0, 9.0, "w", 0)])
    t = layouts.upsert_station(spark, b, path)
    got = {(r.station, r.year, r.month): (r.t, r.sky) for r in t.collect()}
    assert got == {("A", 2011, 1): (None, "new"), ("A", 2011, 2): (9.0, "w"),
                   ("B", 2011, 1): (3.0, "y"), ("A", 2012, 1): (4.0, "z")}
    before = sorted((tuple(r) for r in t.collect()), key=repr)
    after = sorted((tuple(r) for r in layouts.upsert_station(spark, b, path).collect()), key=repr)
    assert before == after  # idempotent


def test_station_scan_prunes_partitions(spark, workdir):
    path = os.path.join(workdir, "station2")
    data = [(s, y, m, 1, 0, 0, float(m), "x", i) for i, (s, y, m) in
            enumerate((s, y, m) for s in "ABC" for y in (2010, 2011) for m in (1, 6))]
    layouts.upsert_station(spark, rows(spark, data), path)
    t = layouts.read_layout(spark, path, rows(spark, data).drop("seq").schema)
    q = scans.station_years(t, "B", 2011, columns=["t", "year", "month"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in plan and "year" in plan.split("PartitionFilters")[1]
    assert sorted(r.month for r in q.collect()) == [1, 6]


def test_time_layout_month_range_prunes(spark, workdir):
    path = os.path.join(workdir, "time")
    data = [("S", 2011, m, 15, 0, 0, dt.datetime(2011, m, 15), 12.0, 42.0, float(m), m) for m in range(1, 13)]
    df = spark.createDataFrame(data, "station string, year int, month int, day int, hour int, minute int, "
                                     "valid_date timestamp_ntz, longitude double, latitude double, t double, seq long")
    t = layouts.upsert_time(spark, df, path)
    q = scans.month_range(t, "2011-03", "2011-05")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan
    assert sorted(r.month for r in q.collect()) == [3, 4, 5]
    inst = scans.at_instant(t, dt.datetime(2011, 7, 15, 0, 0)).collect()
    assert [r.t for r in inst] == [7.0]


def test_time_layout_skips_unreal_instants(spark, workdir):
    path = os.path.join(workdir, "time2")
    df = spark.createDataFrame([("S", 2011, 13, 1, 0, 0, None, 1.0, 2.0, 0.0, 1)],
                               "station string, year int, month int, day int, hour int, minute int, "
                               "valid_date timestamp_ntz, longitude double, latitude double, t double, seq long")
    assert layouts.time_rows(df).count() == 0
    assert layouts.station_rows(df).where(F.col("month") == 13).count() == 1


def test_upsert_reads_only_touched_folders(spark, workdir):
    """A batch for one station prunes the stored scan to that station's folders."""
    path = os.path.join(workdir, "prune")
    data = [(s, y, 1, 1, 0, 0, 1.0, "x", i) for i, (s, y) in enumerate((s, y) for s in "ABCDEF" for y in (2010, 2011))]
    schema = rows(spark, data).drop("seq").schema
    layouts.upsert_station(spark, rows(spark, data), path)
    batch = rows(spark, [("C", 2011, 1, 1, 0, 0, 5.0, "y", 99)])
    folders = layouts.touched_partitions(batch, ["station", "year"])
    touched = layouts.touched_rows(layouts.read_layout(spark, path, schema), folders, ["station", "year"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    pf = plan.split("PartitionFilters: [")[1].split("]")[0]
    # a one-value isin is simplified to an equality; both prune folders
    assert ("= C" in pf or "IN (" in pf.upper() or "INSET" in pf.upper()) and ("= 2011" in pf or "IN (" in pf.upper())
    assert [(r.station, r.year) for r in touched.collect()] == [("C", 2011)]
    final = touched._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final
    layouts.upsert_station(spark, batch, path)
    got = {(r.station, r.year): r.t for r in layouts.read_layout(spark, path, schema).collect()}
    assert got[("C", 2011)] == 5.0 and got[("C", 2010)] == 1.0 and len(got) == 12


def test_hot_partition_written_by_many_tasks(spark, workdir):
    import glob

    path = os.path.join(workdir, "hot")
    data = [("HOT", 2011, 1 + i % 12, 1 + i % 28, i % 24, i % 60, float(i), "x", i) for i in range(20000)]
    layouts.upsert_station(spark, rows(spark, data), path, num_tasks=4)
    assert len(glob.glob(os.path.join(path, "station=HOT", "year=2011", "*.parquet"))) >= 2


def test_map_slice_text_measure_not_rounded(spark):
    from obsgrid.plans.reports import map_slice

    df = spark.createDataFrame(
        [(dt.datetime(2013, 7, 14, 14, 50), 12.0, 42.0, "-RA", 1.23456),
         (dt.datetime(2013, 7, 14, 14, 50), 9.0, 45.0, None, 2.0),
         (dt.datetime(2013, 7, 14, 15, 50), 9.0, 45.0, "BR", 3.0)],
        "valid_date timestamp_ntz, longitude double, latitude double, weather_code string, visibility double")
    text = map_slice(df, dt.datetime(2013, 7, 14, 14, 50), "weather_code").collect()
    assert [(r.longitude, r.value) for r in text] == [(12.0, "-RA")]
    num = map_slice(df, dt.datetime(2013, 7, 14, 14, 50), "visibility").collect()
    assert sorted(r.value for r in num) == [1.23, 2.0]


def test_finish_upsert_recovers_from_stage(spark, workdir):
    """A failed final overwrite leaves the stage; finish_upsert completes from it."""
    import shutil

    path = os.path.join(workdir, "recover")
    schema = rows(spark, [("A", 2011, 1, 1, 0, 0, 1.0, "x", 1)]).drop("seq").schema
    layouts.upsert_station(spark, rows(spark, [("A", 2011, 1, 1, 0, 0, 1.0, "x", 1),
                                               ("B", 2011, 1, 1, 0, 0, 2.0, "y", 2)]), path)
    orig = layouts.finish_upsert
    staged = {}

    def broken(spark_, staging, path_, layout, schema_):
        staged["path"] = staging
        shutil.rmtree(os.path.join(path_, "station=A"))  # crash after removing a partition folder
        raise OSError("simulated failure during the overwrite")

    layouts.finish_upsert = broken
    try:
        try:
            layouts.upsert_station(spark, rows(spark, [("A", 2011, 2, 1, 0, 0, 9.0, "z", 3)]), path)
            raise AssertionError("expected a failure")
        except RuntimeError as e:
            assert staged["path"] in str(e)
    finally:
        layouts.finish_upsert = orig
    from obsgrid.schema import STATION_LAYOUT

    t = layouts.finish_upsert(spark, staged["path"], path, STATION_LAYOUT, schema)
    got = {(r.station, r.month): r.t for r in t.collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 9.0, ("B", 1): 2.0}
    assert not os.path.exists(staged["path"])


def test_map_slice_bbox_drops_points_outside(spark):
    from obsgrid.plans.reports import map_slice

    df = spark.createDataFrame([(dt.datetime(2013, 7, 14, 14, 50), 12.0, 42.0, 1.0),
                                (dt.datetime(2013, 7, 14, 14, 50), 44.0, 33.0, 2.0)],
                               "valid_date timestamp_ntz, longitude double, latitude double, wind_direction double")
    when = dt.datetime(2013, 7, 14, 14, 50)
    assert [(r.longitude, r.value) for r in map_slice(df, when, "wind_direction", bbox=True).collect()] == [(12.0, 1.0)]
    assert map_slice(df, when, "wind_direction").count() == 2


def test_upsert_needs_its_order_columns(spark, workdir):
    df = rows(spark, [("A", 2011, 1, 1, 0, 0, 1.0, "x", 1)]).drop("seq")
    with pytest.raises(ValueError):
        layouts.upsert_station(spark, df, os.path.join(workdir, "noorder"))


def test_upsert_without_marker_keeps_stored_rows(spark, workdir):
    """A table is the data in its folder; a missing _SUCCESS marker changes nothing."""
    path = os.path.join(workdir, "nomarker")
    layouts.upsert_station(spark, rows(spark, [(s, 2011, 1, 1, 0, 0, 1.0, "x", 1) for s in "ABC"]), path)
    os.remove(os.path.join(path, "_SUCCESS"))
    t = layouts.upsert_station(spark, rows(spark, [("A", 2011, 2, 1, 0, 0, 2.0, "y", 2)]), path)
    assert sorted((r.station, r.month) for r in t.collect()) == [("A", 1), ("A", 2), ("B", 1), ("C", 1)]


@pytest.mark.parametrize("bad", [None, ""])
def test_upsert_rejects_unnamed_partitions(spark, workdir, bad):
    path = os.path.join(workdir, "unnamed")
    layouts.upsert_station(spark, rows(spark, [("A", 2011, 1, 1, 0, 0, 1.0, "x", 1)]), path)
    with pytest.raises(ValueError):
        layouts.upsert_station(spark, rows(spark, [(bad, 2011, 1, 1, 0, 0, 2.0, "y", 2)]), path)
    t = layouts.read_layout(spark, path, rows(spark, []).drop("seq").schema)
    assert [(r.station, r.t) for r in t.collect()] == [("A", 1.0)]


def test_next_upsert_finishes_a_stopped_one(spark, workdir, monkeypatch):
    """A stop between folder moves loses nothing: the note makes the next upsert finish first."""
    import shutil

    path = os.path.join(workdir, "stopped")
    layouts.upsert_station(spark, rows(spark, [(s, 2011, 1, 1, 0, 0, 1.0, "x", 1) for s in "AB"]), path)

    class NoPool:
        def __init__(self, n):
            shutil.rmtree(os.path.join(path, "station=A"))
            raise OSError("stopped before the moves")

    with monkeypatch.context() as m:
        m.setattr(layouts, "ThreadPoolExecutor", NoPool)
        with pytest.raises(RuntimeError):
            layouts.upsert_station(spark, rows(spark, [(s, 2011, 2, 1, 0, 0, 2.0, "y", 2) for s in "AB"]), path)
    t = layouts.upsert_station(spark, rows(spark, [("B", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)
    assert sorted((r.station, r.month) for r in t.collect()) == [("A", 1), ("A", 2), ("B", 1), ("B", 2), ("B", 3)]
    assert not os.path.exists(os.path.join(path, layouts.PENDING))


def test_upsert_many_partitions_uses_semi_join(spark, workdir, monkeypatch):
    monkeypatch.setattr(layouts, "PRUNED", 1)
    path = os.path.join(workdir, "many")
    layouts.upsert_station(spark, rows(spark, [(s, 2011, 1, 1, 0, 0, 1.0, "x", 1) for s in "ABC"]), path)
    t = layouts.upsert_station(spark, rows(spark, [(s, 2011, 2, 1, 0, 0, 2.0, "y", 2) for s in "AB"]), path)
    assert t.count() == 5


def test_stored_scans_prune(spark):
    """The registered scans of stored layouts list only the folders that their predicates name."""
    from obsgrid.plans import catalog

    for name in ("stored_station_year", "stored_station_years", "stored_instant", "stored_month_range"):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "year" in filters and ("station" in filters or "month" in filters), name
        assert df.count() > 0


def test_station_report_reads_the_year_once(spark):
    """One pruned scan fills the year's tables: they read the kept rows."""
    from obsgrid.plans import catalog

    frames = catalog._stored_report(spark, "/root/testdata/sf0.001")
    for name in ("seasons", "box"):
        assert "FileScan" not in frames[name]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in frames["history"]._jdf.queryExecution().executedPlan().toString()
    levels = [(r.level, r.month or 0, r.season or 0) for r in frames["seasons"].collect()]
    assert levels == sorted(levels) and len(levels) > 4


def test_scratch_folders_are_removed(spark):
    from obsgrid import session

    path = session.scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    assert f"/obsgrid/{spark.sparkContext.applicationId}/" in path
    local = path.removeprefix("file://")
    assert os.path.exists(local)
    layouts._remove(spark, path)
    assert not os.path.exists(local)


class Stop(Exception):
    pass


def _stopped_upsert(spark, path, stop_at, monkeypatch):
    """Load A, B, then upsert A, C, D and stop before the given step of the given folder."""
    layouts.upsert_station(spark, rows(spark, [(s, 2011, 1, 1, 0, 0, 1.0, "x", 1) for s in "AB"]), path)
    finish = layouts.finish_upsert

    def stopping(*a):
        def step(folder, state):
            if (folder, state) == stop_at:
                raise Stop(folder)
        return finish(*a, step=step)

    with monkeypatch.context() as m:
        m.setattr(layouts, "finish_upsert", stopping)
        with pytest.raises(RuntimeError) as e:
            layouts.upsert_station(spark, rows(spark, [(s, 2011, 2, 1, 0, 0, 2.0, "y", 2) for s in "ACD"]), path)
    assert isinstance(e.value.__cause__, Stop)
    own = os.path.join(path, layouts.PENDING)
    return os.path.join(own, os.listdir(own)[0])


def _months(t):
    return sorted((r.station, r.month) for r in t.collect())


STOPS = [("station=A/year=2011", "staged"), ("station=A/year=2011", "aside"), ("station=C", "aside"), ("station=D", "aside")]
NEW_TABLE = [("A", 1), ("A", 2), ("B", 1), ("C", 2), ("D", 2)]


@pytest.mark.parametrize("stop_at", STOPS)
def test_stop_at_any_step_is_finished_by_the_next_upsert(spark, workdir, monkeypatch, stop_at):
    path = os.path.join(workdir, "steps")
    _stopped_upsert(spark, path, stop_at, monkeypatch)
    t = layouts.upsert_station(spark, rows(spark, [("E", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)
    assert _months(t) == sorted([*NEW_TABLE, ("E", 3)])
    assert not os.path.exists(os.path.join(path, layouts.PENDING))


@pytest.mark.parametrize("stop_at", STOPS)
@pytest.mark.parametrize("cut", ["folder", "file"])
def test_lost_stage_gives_the_old_table_and_an_error(spark, workdir, monkeypatch, stop_at, cut):
    """What is left of the stage goes away, or loses a byte: never fewer rows than before."""
    import shutil

    from obsgrid.schema import STATION_LAYOUT

    path = os.path.join(workdir, "lost")
    own = _stopped_upsert(spark, path, stop_at, monkeypatch)
    stage = os.path.join(own, "new", stop_at[0])
    if cut == "folder":
        shutil.rmtree(stage)
    else:
        file = next(os.path.join(d, f) for d, _, fs in os.walk(stage) for f in fs if f.endswith(".parquet") and not f.startswith("."))
        with open(file, "ab") as f:
            f.write(b"x")
    schema = rows(spark, []).drop("seq").schema
    with pytest.raises(layouts.StageLost):
        layouts.upsert_station(spark, rows(spark, [("E", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)
    assert _months(layouts.read_layout(spark, path, schema)) == [("A", 1), ("B", 1)]
    t = layouts.upsert_station(spark, rows(spark, [("E", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)
    assert _months(t) == [("A", 1), ("B", 1), ("E", 3)]
    assert STATION_LAYOUT.partition_by == ("station", "year")


def test_scratch_clean_up_keeps_a_pending_stage(spark, workdir, monkeypatch):
    from obsgrid import session

    path = os.path.join(workdir, "kept")
    _stopped_upsert(spark, path, STOPS[1], monkeypatch)
    session.remove_scratch(spark)
    assert _months(layouts.upsert_station(spark, rows(spark, [("E", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)) == sorted([*NEW_TABLE, ("E", 3)])


def test_stop_before_the_journal_leaves_the_old_table(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "unlisted")
    layouts.upsert_station(spark, rows(spark, [("A", 2011, 1, 1, 0, 0, 1.0, "x", 1)]), path)
    with monkeypatch.context() as m:
        m.setattr(layouts, "write_journal", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            layouts.upsert_station(spark, rows(spark, [("A", 2011, 2, 1, 0, 0, 2.0, "y", 2)]), path)
    schema = rows(spark, []).drop("seq").schema
    assert _months(layouts.read_layout(spark, path, schema)) == [("A", 1)]
    t = layouts.upsert_station(spark, rows(spark, [("B", 2011, 2, 1, 0, 0, 2.0, "y", 2)]), path)
    assert _months(t) == [("A", 1), ("B", 2)] and not os.path.exists(os.path.join(path, layouts.PENDING))


def test_both_folders_gone_is_an_error_that_removes_nothing(spark, workdir, monkeypatch):
    import shutil

    path = os.path.join(workdir, "gone")
    own = _stopped_upsert(spark, path, STOPS[1], monkeypatch)
    shutil.rmtree(os.path.join(own, "new", STOPS[1][0]))
    shutil.rmtree(os.path.join(own, "old"))
    for _ in range(2):
        with pytest.raises(layouts.StageLost):
            layouts.upsert_station(spark, rows(spark, [("E", 2011, 3, 1, 0, 0, 3.0, "z", 3)]), path)
    assert os.path.exists(os.path.join(own, "journal"))


def _stations(spark, names, month):
    return rows(spark, [(s, 2011, month, 1, 0, 0, float(month), "x", month) for s in names])


def test_gateway_calls_do_not_grow_with_the_folders(spark, workdir, monkeypatch):
    """The driver asks the file system a fixed number of times for an upsert, whatever the folders it moves."""
    calls = []
    for name in ("path", "exists", "rename"):
        own = getattr(layouts._Folder, name)
        monkeypatch.setattr(layouts._Folder, name, lambda self, *a, own=own: calls.append(1) or own(self, *a))
    seen = []
    for n in (3, 45):
        path = os.path.join(workdir, f"calls{n}")
        names = [f"S{i:02d}" for i in range(n)]
        layouts.upsert_station(spark, _stations(spark, names, 1), path)
        calls.clear()
        t = layouts.upsert_station(spark, _stations(spark, [*names, "new"], 2), path)
        seen.append(len(calls))
        assert _months(t) == sorted([(s, m) for s in names for m in (1, 2)] + [("new", 2)])
    assert seen[0] == seen[1]


def test_listing_takes_some_tasks_not_one_per_folder(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "listing")
    layouts.upsert_station(spark, _stations(spark, [f"S{i:02d}" for i in range(45)], 1), path)
    monkeypatch.setattr(layouts, "TASKS_PER_CORE", 1)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, sc = spark.conf.get(key), spark.sparkContext
    sc.setJobGroup("layout-listing", "")
    try:
        t = layouts.read_layout(spark, path, rows(spark, []).drop("seq").schema)
    finally:
        sc.setJobGroup("tests", "")
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("layout-listing") for s in tracker.getJobInfo(j).stageIds]
    tasks = [i.numTasks for s in stages if (i := tracker.getStageInfo(s)) is not None]
    assert tasks and max(tasks) <= min(44, sc.defaultParallelism)
    assert spark.conf.get(key) == before and t.count() == 45


def test_folders_moved_by_tasks(spark, workdir, monkeypatch):
    """More than HERE folders are moved by Spark tasks: old ones replaced, new ones added, nothing left over."""
    monkeypatch.setattr(layouts, "HERE", 0)
    monkeypatch.setattr(layouts, "_move_here", lambda *a: (_ for _ in ()).throw(Stop()))
    path = os.path.join(workdir, "tasks")
    layouts.upsert_station(spark, _stations(spark, "AB", 1), path)
    t = layouts.upsert_station(spark, _stations(spark, "ACD", 2), path)
    assert _months(t) == NEW_TABLE
    assert not os.path.exists(os.path.join(path, layouts.PENDING))


@pytest.mark.parametrize("stop_at", STOPS)
@pytest.mark.parametrize("cut", [None, "stage", "both"])
def test_tasks_finish_or_undo_a_stopped_upsert(spark, workdir, monkeypatch, stop_at, cut):
    import shutil

    from obsgrid.schema import STATION_LAYOUT

    path = os.path.join(workdir, "task-steps")
    own = _stopped_upsert(spark, path, stop_at, monkeypatch)
    schema = rows(spark, []).drop("seq").schema
    monkeypatch.setattr(layouts, "HERE", 0)

    def finish():
        return layouts.finish_upsert(spark, os.path.join(own, "new"), path, STATION_LAYOUT, schema)

    if cut is None:
        assert _months(finish()) == NEW_TABLE
        assert not os.path.exists(os.path.join(path, layouts.PENDING))
        return
    shutil.rmtree(os.path.join(own, "new", stop_at[0]))
    if cut == "both" and stop_at[1] == "aside" and "A" in stop_at[0]:
        shutil.rmtree(os.path.join(own, "old"))
        with pytest.raises(layouts.StageLost):
            finish()
        assert os.path.exists(os.path.join(own, "journal"))
        return
    with pytest.raises(layouts.StageLost):
        finish()
    assert _months(layouts.read_layout(spark, path, schema)) == [("A", 1), ("B", 1)]


@pytest.mark.parametrize("here", [0, 1000])
def test_folder_names_that_spark_escapes(spark, workdir, monkeypatch, here):
    monkeypatch.setattr(layouts, "HERE", here)
    path = os.path.join(workdir, "names")
    names = ["a/b", "50%", "x y", "q?#:", "_u", "é"]
    layouts.upsert_station(spark, _stations(spark, names[:4], 1), path)
    t = layouts.upsert_station(spark, _stations(spark, names, 2), path)
    assert _months(t) == sorted([(s, 1) for s in names[:4]] + [(s, 2) for s in names])


def _data_folders(path):
    return sorted(os.path.relpath(d, path) for d, _, files in os.walk(path) if any(f.endswith(".parquet") and f[0] != "." for f in files))


def test_many_folders_take_no_listing_on_the_driver(spark, workdir, monkeypatch):
    """Beyond LISTED folders Spark's file index and writer are never asked: what the driver holds does not grow with the folders."""
    monkeypatch.setattr(layouts, "LISTED", 4)
    monkeypatch.setattr(layouts, "HERE", 4)
    for name in ("read_layout", "write_layout"):
        monkeypatch.setattr(layouts, name, lambda *a, **k: (_ for _ in ()).throw(Stop()))
    monkeypatch.setattr(layouts._Folder, "data_files", lambda *a: (_ for _ in ()).throw(Stop()))
    path = os.path.join(workdir, "spread")
    names = [f"S{i:02d}" for i in range(40)]
    layouts.upsert_station(spark, _stations(spark, names, 1), path)
    t = layouts.upsert_station(spark, _stations(spark, [*names[5:], "new"], 2), path)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan and t.inputFiles() == []
    assert _months(t) == sorted([(s, 1) for s in names] + [(s, 2) for s in [*names[5:], "new"]])
    assert _data_folders(path) == sorted(f"station={s}/year=2011" for s in [*names, "new"])
    assert not os.path.exists(os.path.join(path, layouts.PENDING))


def test_few_touched_folders_of_many_are_read_alone(spark, workdir, monkeypatch):
    """A small batch into a table of many folders reads its own folders: others may be unreadable."""
    monkeypatch.setattr(layouts, "LISTED", 4)
    path = os.path.join(workdir, "few")
    layouts.upsert_station(spark, _stations(spark, "ABCDEF", 1), path)
    with open(os.path.join(path, "station=F", "year=2011", "bad.parquet"), "wb") as f:
        f.write(b"no Parquet")
    layouts.upsert_station(spark, _stations(spark, "AB", 2), path)
    os.remove(os.path.join(path, "station=F", "year=2011", "bad.parquet"))
    t = layouts.read_layout(spark, path, rows(spark, []).drop("seq").schema)
    assert _months(t) == sorted([(s, 1) for s in "ABCDEF"] + [(s, 2) for s in "AB"])


def test_tasks_write_and_read_what_spark_does(spark, workdir, monkeypatch):
    """Same folders, types and values either way, and each way reads what the other wrote."""
    import decimal

    schema = ("c string, n5 decimal(5,2), n20 decimal(20,3), tiny tinyint, small smallint, big bigint, f float, d double, o boolean, y binary, a date, "
              "z timestamp, u timestamp_ntz, station string, year int, month int, day int, hour int, minute int, seq long")
    names = [f"x{chr(i)}y" for i in range(1, 128)] + ["50%", "%41", "é", "_u", "日本", " "]
    data = []
    for k, name in enumerate(n for n in names for _ in range(2)):
        values = [None] * 13 if k % 5 == 0 else [
            f"é{k}", decimal.Decimal("-1.25"), decimal.Decimal(k) / 8, k % 100 - 50, -k, 10 ** 15 + k, float("nan") if k % 3 else -0.0, k / 7, k % 2 == 0,
            bytes([k % 256, 0]), dt.date(1950, 1, 1) + dt.timedelta(k), dt.datetime(1990, 1, 1) + dt.timedelta(k, 0, k), dt.datetime(1800, 1, 1) + dt.timedelta(k)]
        data.append((*values, name, 2011, 1 + k % 12, 1 + k % 28, k % 24, k % 60, k))
    df = spark.createDataFrame(data, schema)
    plain, tables = df.drop("seq").schema, {}
    for way, listed in (("spark", 10 ** 6), ("tasks", 0)):
        monkeypatch.setattr(layouts, "LISTED", listed)
        tables[way] = layouts.upsert_station(spark, df, os.path.join(workdir, way))
    assert "MapInArrow" in tables["tasks"]._jdf.queryExecution().executedPlan().toString()
    assert tables["tasks"].schema == tables["spark"].schema
    assert _data_folders(os.path.join(workdir, "tasks")) == _data_folders(os.path.join(workdir, "spark"))
    crossed = [layouts.read_layout(spark, os.path.join(workdir, "tasks"), plain),
               layouts._stored(spark, os.path.join(workdir, "spark"), plain, layouts.STATION_LAYOUT)]
    want = sorted(map(repr, tables["spark"].collect()))
    assert len(want) == len(data)
    for t in (tables["tasks"], *crossed):
        assert sorted(map(repr, t.collect())) == want


def test_tasks_read_files_of_an_earlier_schema(spark, workdir, monkeypatch):
    """A column that old files lack is NULL there; a type that Spark's reader would not take is an error."""
    monkeypatch.setattr(layouts, "LISTED", 0)
    path = os.path.join(workdir, "earlier")
    layouts.upsert_station(spark, _stations(spark, "AB", 1).drop("sky"), path)
    t = layouts.upsert_station(spark, _stations(spark, "B", 2), path)
    assert sorted((r.station, r.month, r.sky) for r in t.collect()) == [("A", 1, None), ("B", 1, None), ("B", 2, "x")]
    with pytest.raises(Exception, match="holds double, not int32"):
        layouts.upsert_station(spark, _stations(spark, "A", 3).withColumn("t", F.lit(1)), path)


def test_a_task_that_writes_again_leaves_one_file(spark, workdir, monkeypatch):
    """Rows of several batches, a folder across two of them; the same tasks twice give the same files.

    A second attempt of a task has the first one's rows: so do two writes of rows that are few enough to be sampled all."""
    from obsgrid.schema import STATION_LAYOUT

    monkeypatch.setattr(layouts, "ROW_GROUP", 7)
    data = [("HOT" if i % 3 else f"S{i % 9}", 2011, 1 + i % 12, 1 + i % 28, i % 24, i % 60, float(i), "x", i) for i in range(800)]
    df = rows(spark, data).drop("seq")
    to = layouts._Shared(os.path.join(workdir, "again"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        for _ in range(2):
            layouts._write_by_tasks(df, to, STATION_LAYOUT, num_tasks=3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, layouts.read_layout(spark, to.top, df.schema).select(df.columns).collect())) == sorted(d[:-1] for d in data)
    assert len(os.listdir(to.path("station=HOT", "year=2011"))) >= 2


@pytest.mark.parametrize("stop_at", STOPS)
@pytest.mark.parametrize("cut", [None, "stage"])
def test_stop_with_many_folders(spark, workdir, monkeypatch, stop_at, cut):
    """What tasks wrote and listed is finished, or undone, like any other upsert."""
    import shutil

    monkeypatch.setattr(layouts, "LISTED", 0)
    path = os.path.join(workdir, "many-steps")
    own = _stopped_upsert(spark, path, stop_at, monkeypatch)
    schema = rows(spark, []).drop("seq").schema
    monkeypatch.setattr(layouts, "HERE", 0)
    if cut is None:
        t = layouts.finish_upsert(spark, os.path.join(own, "new"), path, layouts.STATION_LAYOUT, schema)
        assert _months(t) == NEW_TABLE
    else:
        shutil.rmtree(os.path.join(own, "new", stop_at[0]))
        with pytest.raises(layouts.StageLost):
            layouts.upsert_station(spark, _stations(spark, "E", 3), path)
        assert _months(layouts.read_layout(spark, path, schema)) == [("A", 1), ("B", 1)]
    assert not os.path.exists(os.path.join(path, layouts.PENDING))


def test_old_dates_are_told_by_the_file(spark, workdir, monkeypatch):
    """Dates and instants before 1582, by tasks and by Spark, whatever Spark's reader takes unmarked files for."""
    df = spark.sql("SELECT concat('S', id) AS station, 2011 AS year, 1 AS month, 1 AS day, CAST(id AS int) AS hour, 0 AS minute, "
                   "DATE'1400-03-01' + CAST(id * 50000 AS int) AS a, TIMESTAMP'0001-01-01 00:00:00' + make_interval(id * 400) AS z, id AS seq FROM range(24)")
    plain, key = df.drop("seq").schema, "spark.sql.parquet.datetimeRebaseModeInRead"

    def values(t):
        return sorted(tuple(r) for r in t.selectExpr("station", "CAST(a AS string)", "unix_micros(z)").collect())

    want, before = values(df), spark.conf.get(key)
    paths = {way: os.path.join(workdir, way) for way in ("spark", "tasks")}
    for way, listed in (("spark", 10 ** 6), ("tasks", 0)):
        monkeypatch.setattr(layouts, "LISTED", listed)
        assert values(layouts.upsert_station(spark, df, paths[way])) == want
    assert values(layouts._stored(spark, paths["spark"], plain, layouts.STATION_LAYOUT)) == want
    try:
        for mode in ("CORRECTED", "LEGACY", "EXCEPTION"):
            spark.conf.set(key, mode)
            assert values(layouts.read_layout(spark, paths["tasks"], plain)) == want
    finally:
        spark.conf.set(key, before)
