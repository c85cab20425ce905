"""Registered queries: one Spark plan per operator over the bindings, with its SQL oracle.

Each Spark query takes (spark, sf_dir) and reads whole test tables through
the bindings (B1-B5). The oracle is the same question in plain SQL that
DuckDB runs on the same tables. Averages, variances and interpolated values
are rounded to 6 decimals on both sides so that last-bit differences of
summation order do not count.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.functions.geo import KM_PER_DEGREE
from obsgrid.operators import kmeans as km
from obsgrid.operators import periods as pe
from obsgrid.operators import quantiles as qu
from obsgrid.operators.nearest import nearest_station
from obsgrid.operators.ordering import with_position
from obsgrid.operators.profile import feature_names, location_profile
from obsgrid.operators.stations import station_dimension
from obsgrid.plans import reports
from obsgrid.sources import bindings as b
from obsgrid.sources import layouts, scans
from obsgrid.schema import CLUSTER_COLOURS, FIELD_MAP, MAP_EXTENT, RAW_FIELDS, SEASON_LABELS
from obsgrid.sources.csv_ingest import clean, read_raw, read_station_list, write_station_list
from obsgrid.functions.columns import complete_rows, round_scaled, with_calendar
from obsgrid.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def case_sql(column: str, names: Mapping[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(names.items())) + " END"


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Round as round(x * 10^d) / 10^d, half away from zero: the same double
    arithmetic the SQL side's round(x, d) performs, so ties fall the same way."""
    cols = set(cols)
    return df.select(*[round_scaled(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# parameters of the registered queries
# ---------------------------------------------------------------------------
M = "temperature_f"            # the B1 measure
STATION = "1-URGENT"
YEAR = 1997
YEARS = ("3-MEDIUM", 1996, 1998)
INSTANT_B3 = dt.datetime(2024, 1, 15, 12, 0)
INSTANT_B2 = dt.datetime(1996, 3, 13, 0, 0)
RANGE_B2 = ("1995-01", "1995-10")
RANGE_COMPAT_B1 = ("1996-01", "1996-03")
FULL_RANGE_B2 = ("1992-01", "1998-12")
POINT = {"lon": 12.3, "lat": 42.24}
REPORT_YEAR = 1995
K = 3
ROUNDS = 10
IND = b.INDICATORS
FEATS = feature_names(IND)
KPD = repr(KM_PER_DEGREE)

# SQL pieces ---------------------------------------------------------------
B1_CAL = f"""b1 AS ({b.B1_SQL}),
o AS (SELECT *, CAST(year(valid_date) AS INTEGER) AS year, CAST(month(valid_date) AS INTEGER) AS month,
             CAST(ceil(month(valid_date) / 3.0) AS INTEGER) AS season FROM b1)"""
B1_VALS = f"""{B1_CAL},
d AS (SELECT station, year, month, season, seq, {M} FROM o WHERE {M} IS NOT NULL)"""


def _b1(spark: SparkSession, sf: str) -> DataFrame:
    return b.obs_station(spark, sf)


def _b2(spark: SparkSession, sf: str) -> DataFrame:
    return b.obs_time(spark, sf)


# ---------------------------------------------------------------------------
# Cleaning (B5)
# ---------------------------------------------------------------------------
_CLEAN_SQL = f"""WITH r AS ({b.B5_SQL}),
t AS (SELECT *, regexp_matches(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)') AS date_ok,
             TRY_CAST(tmpf AS FLOAT) AS num FROM r),
u AS (SELECT *, CASE WHEN NOT date_ok THEN 'valid'
                     WHEN tmpf NOT IN ('   ', 'null') AND num IS NULL THEN 'tmpf' END AS reason FROM t)"""


@register("ingest_clean", f"""{_CLEAN_SQL}
SELECT station,
       CAST(regexp_extract(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)', 1) AS INTEGER) AS year,
       CAST(regexp_extract(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)', 2) AS INTEGER) AS month,
       CAST(regexp_extract(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)', 3) AS INTEGER) AS day,
       CAST(regexp_extract(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)', 4) AS INTEGER) AS hour,
       CAST(regexp_extract(valid, '^(\\d+)-(\\d+)-(\\d+) (\\d+):(\\d+)', 5) AS INTEGER) AS minute,
       CAST(strptime(substr(valid, 1, 16), '%Y-%m-%d %H:%M') AS TIMESTAMP) AS valid_date,
       CASE WHEN tmpf IN ('   ', 'null') THEN NULL ELSE num END AS temperature_f,
       CASE WHEN skyc1 IN ('   ', 'null') THEN NULL ELSE skyc1 END AS sky_level1_coverage,
       seq
FROM u WHERE reason IS NULL""")
def q_ingest_clean(spark, sf):
    good, _ = clean(b.raw_text(spark, sf))
    return good


@register("ingest_rejects", f"""{_CLEAN_SQL}
SELECT seq, station, valid, reason FROM u WHERE reason IS NOT NULL""")
def q_ingest_rejects(spark, sf):
    _, bad = clean(b.raw_text(spark, sf))
    return bad


# ---------------------------------------------------------------------------
# Station dimension (B2)
# ---------------------------------------------------------------------------
@register("station_dimension", f"""WITH b2 AS ({b.B2_SQL})
SELECT CAST(loc AS VARCHAR) AS station, min_by(longitude, seq) AS longitude, min_by(latitude, seq) AS latitude,
       min(seq) AS ord FROM b2 GROUP BY loc""")
def q_station_dimension(spark, sf):
    return station_dimension(_b2(spark, sf).withColumn("station", F.col("loc").cast("string")))


# The station list written as CSV in first-seen order, read again, and the place of each station in the file
@register("station_list", f"""WITH b2 AS ({b.B2_SQL})
SELECT CAST(loc AS VARCHAR) AS station, min_by(longitude, seq) AS longitude, min_by(latitude, seq) AS latitude,
       row_number() OVER (ORDER BY min(seq), CAST(loc AS VARCHAR)) AS position FROM b2 GROUP BY loc""")
def q_station_list(spark, sf):
    path = scratch_path(spark, "station-list")
    first_seen = station_dimension(_b2(spark, sf).withColumn("station", F.col("loc").cast("string")))
    write_station_list(first_seen.withColumn("ord", F.struct("ord", "station")), path)      # stations first seen at one seq: by name
    stations = read_station_list(spark, path)
    return with_position(stations, ["ord"]).drop("ord")


# O1, O2: rows with their positions in reading order
@register("ordered_observations", f"""WITH b2 AS ({b.B2_SQL})
SELECT row_number() OVER (ORDER BY year(valid_date), month(valid_date), loc, seq) AS position, loc, seq,
       CAST(year(valid_date) AS INTEGER) AS year, CAST(month(valid_date) AS INTEGER) AS month FROM b2""")
def q_ordered_observations(spark, sf):
    rows = with_calendar(_b2(spark, sf)).select("loc", "seq", "year", "month")
    return with_position(rows, ["year", "month", "loc", "seq"])


# ---------------------------------------------------------------------------
# Scans (B1, B2, B3)
# ---------------------------------------------------------------------------
@register("scan_station_year", f"""WITH {B1_CAL}
SELECT station, year, month, {M}, seq FROM o WHERE station = '{STATION}' AND year = {YEAR}""")
def q_scan_station_year(spark, sf):
    return scans.station_years(_b1(spark, sf), STATION, YEAR, columns=["station", "year", "month", M, "seq"])


@register("scan_station_years", f"""WITH {B1_CAL}
SELECT station, year, month, {M}, seq FROM o
WHERE station = '{YEARS[0]}' AND year BETWEEN {YEARS[1]} AND {YEARS[2]}""")
def q_scan_station_years(spark, sf):
    return scans.station_years(_b1(spark, sf), YEARS[0], YEARS[1], YEARS[2],
                               columns=["station", "year", "month", M, "seq"])


@register("slice_at_instant", f"""WITH b3 AS ({b.B3_SQL})
SELECT station, valid_hour, measure, sky, seq FROM b3 WHERE valid_hour = TIMESTAMP '{INSTANT_B3:%Y-%m-%d %H:%M:%S}'""")
def q_slice_at_instant(spark, sf):
    return scans.at_instant(b.obs_slice(spark, sf), INSTANT_B3, ts="valid_hour",
                            columns=["station", "valid_hour", "measure", "sky", "seq"])


_B2_COLS = ["loc", "valid_date", *IND, "seq"]
_B2_SEL = ", ".join(_B2_COLS)


@register("scan_month_range", f"""WITH b2 AS ({b.B2_SQL})
SELECT {_B2_SEL} FROM b2 WHERE valid_date >= TIMESTAMP '1995-01-01' AND valid_date < TIMESTAMP '1995-11-01'""")
def q_scan_month_range(spark, sf):
    return scans.month_range(_b2(spark, sf), *RANGE_B2, columns=_B2_COLS)


@register("scan_month_range_compat", f"""WITH {B1_CAL}
SELECT station, valid_date, {M}, seq FROM o
WHERE valid_date >= TIMESTAMP '1996-01-01' AND valid_date <= TIMESTAMP '1996-03-31 00:00:00'""")
def q_scan_month_range_compat(spark, sf):
    return scans.month_range(_b1(spark, sf), *RANGE_COMPAT_B1, compat_end=True,
                             columns=["station", "valid_date", M, "seq"])


@register("complete_rows", f"""WITH b2 AS ({b.B2_SQL})
SELECT {_B2_SEL} FROM b2 WHERE {' AND '.join(f'{c} IS NOT NULL' for c in IND)}""")
def q_complete_rows(spark, sf):
    return complete_rows(_b2(spark, sf), IND).select(*_B2_COLS)


# ---------------------------------------------------------------------------
# Period aggregates over every station and year (B1)
# ---------------------------------------------------------------------------
@register("avg_year", f"""WITH {B1_VALS}
SELECT station, year, round(avg({M}), 6) AS avg_{M} FROM d GROUP BY station, year""")
def q_avg_year(spark, sf):
    return rounded(pe.avg_year(_b1(spark, sf), M), [f"avg_{M}"])


@register("avg_season", f"""WITH {B1_VALS}
SELECT station, year, season, round(avg({M}), 6) AS avg_{M} FROM d GROUP BY station, year, season""")
def q_avg_season(spark, sf):
    return rounded(pe.avg_season(_b1(spark, sf), M), [f"avg_{M}"])


@register("avg_month", f"""WITH {B1_VALS}
SELECT station, year, month, round(avg({M}), 6) AS avg_{M} FROM d GROUP BY station, year, month""")
def q_avg_month(spark, sf):
    return rounded(pe.avg_month(_b1(spark, sf), M), [f"avg_{M}"])


@register("season_labels", f"""WITH {B1_VALS}
SELECT station, year, season, round(avg({M}), 6) AS avg_{M},
       {case_sql('season', SEASON_LABELS)} AS season_label
FROM d GROUP BY station, year, season""")
def q_season_labels(spark, sf):
    return rounded(pe.season_labels(_b1(spark, sf), M), [f"avg_{M}"])


@register("monthly_history", f"""WITH {B1_VALS}
SELECT station, year, month, round(avg({M}), 6) AS avg_{M} FROM d
WHERE year BETWEEN {YEARS[1]} AND {YEARS[2]} GROUP BY station, year, month""")
def q_monthly_history(spark, sf):
    return rounded(pe.monthly_history(_b1(spark, sf), M, ("station",), YEARS[1], YEARS[2]), [f"avg_{M}"])


_WIDE = ", ".join(f"round(avg(CASE WHEN month = {m} THEN {M} END), 6) AS m{m:02d}" for m in range(1, 13))


@register("monthly_history_ordered", f"""WITH {B1_VALS}
SELECT station, year, month, round(avg({M}), 6) AS avg_{M}, row_number() OVER (ORDER BY station, year, month) AS position
FROM d GROUP BY station, year, month""")
def q_monthly_history_ordered(spark, sf):
    return with_position(rounded(pe.monthly_history(_b1(spark, sf), M, ("station",)), [f"avg_{M}"]), ["station", "year", "month"])


@register("monthly_history_wide", f"""WITH {B1_VALS}
SELECT station, year, {_WIDE} FROM d GROUP BY station, year""")
def q_monthly_history_wide(spark, sf):
    return rounded(pe.monthly_history_wide(_b1(spark, sf), M, ("station",)), [f"m{m:02d}" for m in range(1, 13)])


@register("minmax_month", f"""WITH {B1_VALS}
SELECT station, year, month, min({M}) AS min_{M}, max({M}) AS max_{M} FROM d GROUP BY station, year, month""")
def q_minmax_month(spark, sf):
    return pe.minmax_month(_b1(spark, sf), M)


@register("minmax_season", f"""WITH {B1_VALS}
SELECT station, year, season, min({M}) AS min_{M}, max({M}) AS max_{M} FROM d GROUP BY station, year, season""")
def q_minmax_season(spark, sf):
    return pe.minmax_season(_b1(spark, sf), M)


@register("season_midrange", f"""WITH {B1_VALS}
SELECT station, year, season, count(*) AS n, round(avg({M}), 6) AS avg_{M}, min({M}) AS min_{M}, max({M}) AS max_{M},
       round((min({M}) + max({M})) / 2, 6) AS mid_{M}
FROM d GROUP BY station, year, season""")
def q_season_midrange(spark, sf):
    return rounded(pe.season_midrange(_b1(spark, sf), M), [f"avg_{M}", f"mid_{M}"])


_PERIOD_SQL = """SELECT {keys}, month, season,
       CASE WHEN grouping(month) = 0 THEN 'month' WHEN grouping(season) = 0 THEN 'season' ELSE 'year' END AS level,
       count(*) AS n, round(avg({m}), 6) AS avg_{m}, min({m}) AS min_{m}, max({m}) AS max_{m}
FROM {src} GROUP BY GROUPING SETS (({keys}), ({keys}, month), ({keys}, season))"""


@register("period_stats", f"""WITH {B1_VALS}
{_PERIOD_SQL.format(keys='station, year', m=M, src='d')}""")
def q_period_stats(spark, sf):
    return rounded(pe.period_stats(_b1(spark, sf), M), [f"avg_{M}"])


# ---------------------------------------------------------------------------
# Medians and boxes (B1)
# ---------------------------------------------------------------------------
def ranked_sql(keys: str, v: str) -> str:
    """Values ranked 0..n-1 within each group, with the group size."""
    return (f"rk AS (SELECT {keys}, {v} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {v}) - 1 AS i, "
            f"count(*) OVER (PARTITION BY {keys}) AS cnt FROM d)")


def interp_sql(p: float) -> str:
    """Exact quantile of the ranked values: linear interpolation at (n-1)*p, written
    (hi - pos) * v[lo] + (pos - lo) * v[hi] (the form Spark's percentile uses)."""
    pos = f"((any_value(cnt) - 1) * {p!r}::DOUBLE)"
    at = lambda idx: f"max(v) FILTER (WHERE i = {idx})"
    lo, hi = f"floor({pos})", f"ceil({pos})"
    return (f"CASE WHEN {lo} = {hi} THEN {at(lo.replace('any_value(cnt)', 'cnt'))} "
            f"ELSE ({hi} - {pos}) * {at(lo.replace('any_value(cnt)', 'cnt'))} "
            f"+ ({pos} - {lo}) * {at(hi.replace('any_value(cnt)', 'cnt'))} END")


@register("median_season", f"""WITH {B1_VALS}, {ranked_sql('station, year, season', M)}
SELECT station, year, season, any_value(cnt) AS n, round({interp_sql(0.5)}, 6) AS median_{M}
FROM rk GROUP BY station, year, season""")
def q_median_season(spark, sf):
    return rounded(qu.median_season(_b1(spark, sf), M), [f"median_{M}"])


def bisect_sql(data: str, keys: Sequence[str], v: str, rounds: int = ROUNDS, out: str | None = None,
               tail: str | None = None) -> str:
    """The bisection rounds unrolled into CTEs (``data`` is a CTE list ending in ``d``).

    ``tail`` replaces the final SELECT; it may add CTEs first (start it with a comma)
    and reads the last state as ``s{rounds}``.
    """
    k = ", ".join(keys)
    out = out or f"bisect_{v}"
    ctes = [f"s0 AS (SELECT {k}, count(*) AS n, min({v}) AS lo, max({v}) AS hi, "
            f"(min({v}) + max({v})) / 2 AS mid, false AS done FROM d GROUP BY {k})"]
    for r in range(rounds):
        ctes.append(
            f"c{r} AS (SELECT {k}, any_value(n) AS n, any_value(lo) AS lo, any_value(hi) AS hi, any_value(mid) AS mid, "
            f"any_value(done) AS done, count(*) FILTER (WHERE {v} < mid) AS l FROM s{r} JOIN d USING ({k}) GROUP BY {k})")
        ctes.append(
            f"t{r} AS (SELECT *, done OR abs(l - (n - l)) <= 1 AS stop FROM c{r})")
        ctes.append(
            f"s{r + 1} AS (SELECT {k}, n, stop AS done, "
            f"CASE WHEN NOT stop AND l < n - l THEN mid ELSE lo END AS lo, "
            f"CASE WHEN NOT stop AND l >= n - l THEN mid ELSE hi END AS hi, "
            f"(CASE WHEN NOT stop AND l < n - l THEN mid ELSE lo END + "
            f"CASE WHEN NOT stop AND l >= n - l THEN mid ELSE hi END) / 2 AS mid FROM t{r})")
    if tail is None:
        tail = f"\nSELECT {k}, n, done AS converged, round(mid, 6) AS {out} FROM s{rounds}"
    return f"WITH {data},\n" + ",\n".join(ctes) + tail


@register("median_bisect", bisect_sql(B1_VALS, ["station", "year", "season"], M))
def q_median_bisect(spark, sf):
    return rounded(qu.median_bisect(_b1(spark, sf), M), [f"bisect_{M}"])


_BOX_Q = f"""{ranked_sql('station, year, season', M)},
q AS (SELECT station, year, season, any_value(cnt) AS n, min(v) AS min,
       {interp_sql(0.25)} AS q1, {interp_sql(0.5)} AS median, {interp_sql(0.75)} AS q3, max(v) AS max
FROM rk GROUP BY station, year, season),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_f, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_f FROM q)"""


@register("box_stats", f"""WITH {B1_VALS}, {_BOX_Q}
SELECT station, year, season, any_value(n) AS n, any_value(min) AS min, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, any_value(max) AS max,
       min({M}) FILTER (WHERE {M} >= lo_f) AS whisker_lo, max({M}) FILTER (WHERE {M} <= hi_f) AS whisker_hi,
       count(*) FILTER (WHERE {M} < lo_f OR {M} > hi_f) AS n_outliers
FROM f JOIN d USING (station, year, season) GROUP BY station, year, season""")
def q_box_stats(spark, sf):
    return rounded(qu.box_stats(_b1(spark, sf), M), ["q1", "median", "q3"])


_B2_BOX = f"""b2 AS ({b.B2_SQL}),
d AS (SELECT loc, CAST(year(valid_date) AS INTEGER) AS year, CAST(ceil(month(valid_date) / 3.0) AS INTEGER) AS season,
             seq, ind2 FROM b2 WHERE ind2 IS NOT NULL),
{ranked_sql('loc, year, season', 'ind2')},
q AS (SELECT loc, year, season, {interp_sql(0.25)} AS q1, {interp_sql(0.75)} AS q3 FROM rk GROUP BY loc, year, season),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_f, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_f FROM q)"""


@register("box_outliers", f"""WITH {_B2_BOX}
SELECT loc, year, season, seq, ind2 FROM f JOIN d USING (loc, year, season) WHERE ind2 < lo_f OR ind2 > hi_f""")
def q_box_outliers(spark, sf):
    obs = with_calendar(_b2(spark, sf))
    return qu.box_outliers(obs, "ind2", keys=("loc", "year", "season"))


# ---------------------------------------------------------------------------
# Nearest station (B4 points, B2 stations)
# ---------------------------------------------------------------------------
def _nearest_sql(geo: bool) -> str:
    cosarg = "radians((p.latitude + s.latitude) / 2)" if geo else "(p.latitude + s.latitude) / 2"
    return f"""WITH p AS ({b.B4_SQL}), s AS ({b.STATIONS_SQL}),
c AS (SELECT p.pt, s.station, s.ord,
             {KPD}::DOUBLE * sqrt(((p.longitude - s.longitude) * cos({cosarg})) * ((p.longitude - s.longitude) * cos({cosarg}))
                                  + (p.latitude - s.latitude) * (p.latitude - s.latitude)) AS d
      FROM p CROSS JOIN s),
r AS (SELECT *, row_number() OVER (PARTITION BY pt ORDER BY d, ord) AS rn FROM c)
SELECT pt, station, round(d, 6) AS distance_km FROM r WHERE rn = 1"""


@register("nearest_station", _nearest_sql(False))
def q_nearest_station(spark, sf):
    st = b.stations_of(_b2(spark, sf))
    return rounded(nearest_station(b.points(spark, sf), st, geo=False), ["distance_km"])


@register("nearest_station_geo", _nearest_sql(True))
def q_nearest_station_geo(spark, sf):
    st = b.stations_of(_b2(spark, sf))
    return rounded(nearest_station(b.points(spark, sf), st, geo=True), ["distance_km"])


@register("nearest_station_repeats", _nearest_sql(True) + " UNION ALL " + "SELECT pt % 7, station, round(d, 6) FROM r WHERE rn = 1")
def q_nearest_station_repeats(spark, sf):
    """Every place twice, the second time under a key that many points share."""
    pts, st = b.points(spark, sf), b.stations_of(_b2(spark, sf))
    twice = pts.unionByName(pts.withColumn("pt", F.col("pt") % 7))
    return rounded(nearest_station(twice, st, geo=True), ["distance_km"])


# ---------------------------------------------------------------------------
# Map slice (B2)
# ---------------------------------------------------------------------------
_MAP_SQL = f"""WITH b2 AS ({b.B2_SQL})
SELECT longitude, latitude, round_even(ind3, 2) AS value FROM b2
WHERE valid_date = TIMESTAMP '{INSTANT_B2:%Y-%m-%d %H:%M:%S}' AND ind3 IS NOT NULL"""


@register("map_slice", _MAP_SQL)
def q_map_slice(spark, sf):
    return reports.map_slice(_b2(spark, sf), INSTANT_B2, "ind3", measures=IND)


# twice the distance from the south-west corner: three quarters of the places lie outside the extent
_SPREAD = [("longitude", MAP_EXTENT["lon_min"]), ("latitude", MAP_EXTENT["lat_min"])]


@register("map_slice_bbox", f"""WITH b2 AS ({b.B2_SQL}),
w AS (SELECT {", ".join(f"{lo}::DOUBLE + ({c} - {lo}::DOUBLE) * 2 AS {c}" for c, lo in _SPREAD)}, valid_date, ind3 FROM b2)
SELECT longitude, latitude, round_even(ind3, 2) AS value FROM w
WHERE valid_date = TIMESTAMP '{INSTANT_B2:%Y-%m-%d %H:%M:%S}' AND ind3 IS NOT NULL
  AND longitude BETWEEN {MAP_EXTENT['lon_min']}::DOUBLE AND {MAP_EXTENT['lon_max']}::DOUBLE
  AND latitude BETWEEN {MAP_EXTENT['lat_min']}::DOUBLE AND {MAP_EXTENT['lat_max']}::DOUBLE""")
def q_map_slice_bbox(spark, sf):
    wide = _b2(spark, sf).withColumns({c: F.lit(lo) + (F.col(c) - F.lit(lo)) * 2 for c, lo in _SPREAD})
    return reports.map_slice(wide, INSTANT_B2, "ind3", bbox=True, measures=IND)


# ---------------------------------------------------------------------------
# Profile and clustering (B2)
# ---------------------------------------------------------------------------
def profile_sql(where: str = "TRUE", digits: int = 6, with_n: bool = True) -> str:
    aggs = []
    for ind in IND:
        aggs += [f"min({ind}) AS {ind}_min", f"max({ind}) AS {ind}_max",
                 f"round(avg({ind}), {digits}) AS {ind}_avg", f"round(var_pop({ind}), {digits}) AS {ind}_var"]
    n = "count(*) AS n, " if with_n else ""
    return (f"SELECT longitude, latitude, {n}{', '.join(aggs)} FROM ({b.B2_SQL}) "
            f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in IND)} AND {where} GROUP BY longitude, latitude")


@register("location_profile", f"WITH p AS ({profile_sql()}) SELECT * FROM p")
def q_location_profile(spark, sf):
    prof = location_profile(_b2(spark, sf), IND)
    return rounded(prof, [f for f in FEATS if f.endswith(("_avg", "_var"))])


def _profile_spark(spark, sf) -> DataFrame:
    prof = location_profile(_b2(spark, sf), IND)
    return prof.select("longitude", "latitude", *[round_scaled(f, 6).alias(f) for f in FEATS])


def kmeans_sql(profile: str, k: int = K, rounds: int = ROUNDS, first: str = "longitude, latitude") -> tuple[str, str]:
    """Unrolled Lloyd rounds over ``profile`` (a SELECT of longitude, latitude, features).

    Returns (CTE text, name of the last assignment CTE). Centre CTEs are c0..c{rounds}.
    """
    fl = ", ".join(FEATS)
    dist = "0.0::DOUBLE" + "".join(f" + (p.{f} - c.{f}) * (p.{f} - c.{f})" for f in FEATS)
    ctes = [f"p AS ({profile})",
            f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY {first}) - 1 AS INTEGER) AS cluster, {fl} "
            f"FROM p ORDER BY {first} LIMIT {k})"]

    def assign(r: int) -> str:
        return (f"a{r} AS (SELECT longitude, latitude, cluster FROM (SELECT p.longitude, p.latitude, c.cluster, "
                f"row_number() OVER (PARTITION BY p.longitude, p.latitude ORDER BY {dist}, c.cluster) AS rn "
                f"FROM p CROSS JOIN c{r} c) WHERE rn = 1)")

    ctes.append(assign(0))
    for r in range(1, rounds + 1):
        means = ", ".join(f"avg(p.{f}) AS {f}" for f in FEATS)
        keep = ", ".join(f"coalesce(m.{f}, o.{f}) AS {f}" for f in FEATS)
        ctes.append(f"m{r} AS (SELECT a.cluster, {means} FROM a{r - 1} a JOIN p USING (longitude, latitude) GROUP BY a.cluster)")
        ctes.append(f"c{r} AS (SELECT o.cluster, {keep} FROM c{r - 1} o LEFT JOIN m{r} m USING (cluster))")
        ctes.append(assign(r))
    return ",\n".join(ctes), f"a{rounds}"


_KM_CTES, _KM_LAST = kmeans_sql(profile_sql(with_n=False))


@register("kmeans_assign", f"WITH {_KM_CTES}\nSELECT longitude, latitude, cluster FROM {_KM_LAST}")
def q_kmeans_assign(spark, sf):
    labelled, _ = km.kmeans_fit(_profile_spark(spark, sf), FEATS, k=K, rounds=ROUNDS, init="first")
    return labelled.select("longitude", "latitude", "cluster")


@register("kmeans_centers", f"WITH {_KM_CTES}\nSELECT cluster, "
          + ", ".join(f"round({f}, 4) AS {f}" for f in FEATS) + f" FROM c{ROUNDS}")
def q_kmeans_centers(spark, sf):
    _, centres = km.kmeans_fit(_profile_spark(spark, sf), FEATS, k=K, rounds=ROUNDS, init="first")
    return rounded(km.centres_frame(spark, FEATS, centres), FEATS, 4)


def _drawn(seed: int) -> str:
    """The order by which the seeded draw of first centres takes places."""
    millionths = ", ".join(f"CAST(CAST(round({c} * 1000000) AS BIGINT) AS VARCHAR)" for c in ("longitude", "latitude"))
    return f"md5(concat_ws(':', '{seed}', {millionths})), longitude, latitude"


_KR_CTES, _KR_LAST = kmeans_sql(profile_sql(with_n=False), first=_drawn(7))


@register("kmeans_random", f"WITH {_KR_CTES}\nSELECT longitude, latitude, cluster FROM {_KR_LAST}")
def q_kmeans_random(spark, sf):
    labelled, _ = km.kmeans_fit(_profile_spark(spark, sf), FEATS, k=K, rounds=ROUNDS, init="random", seed=7)
    return labelled.select("longitude", "latitude", "cluster")


@register("kmeans_ml", f"WITH p AS ({profile_sql(with_n=False)}) SELECT CAST({K} AS BIGINT) AS clusters, count(*) AS n, true AS cost_ok FROM p")
def q_kmeans_ml(spark, sf):
    """The library's clustering of the same profile: all rows, k clusters, and a cost at most half above the Lloyd rounds'."""
    profile = _profile_spark(spark, sf)
    lloyd, _ = km.kmeans_fit(profile, FEATS, k=K, rounds=ROUNDS, init="random", seed=7)
    labelled = km.kmeans_ml(profile, FEATS, k=K, rounds=ROUNDS)
    worst = 1.5 * km.clustering_cost(lloyd, FEATS)
    cost = km.clustering_cost(labelled, FEATS)
    return labelled.agg(F.countDistinct("cluster").alias("clusters"), F.count("*").alias("n")).withColumn(
        "cost_ok", F.lit(cost <= worst))


_CR_CTES, _CR_LAST = kmeans_sql(profile_sql(
    "valid_date >= TIMESTAMP '1992-01-01' AND valid_date < TIMESTAMP '1999-01-01'", with_n=False), first=_drawn(0))
_COLOURS = case_sql("cluster", CLUSTER_COLOURS)


@register("cluster_report", f"WITH {_CR_CTES}\nSELECT a.longitude, a.latitude, a.cluster, {_COLOURS} AS colour, "
          + ", ".join(f"p.{i}_avg" for i in IND) + f" FROM {_CR_LAST} a JOIN p USING (longitude, latitude)")
def q_cluster_report(spark, sf):
    return reports.cluster_report(_b2(spark, sf), *FULL_RANGE_B2, k=K, indicators=IND, rounds=ROUNDS, measures=IND)


# ---------------------------------------------------------------------------
# Keyed upserts (B3, B2) of two batches that overlap: the rows whose seq
# is not a multiple of 3, then those whose seq does not leave 1, with values
# raised by 1. Keys of the first batch alone must survive the second upsert in
# the same partitions; keys of both take the second batch's row.
# ---------------------------------------------------------------------------
_UP_ST_COLS = ["station", "year", "month", "day", "hour", "minute", "measure", "sky"]


def _batches_sql(raised: Sequence[str]) -> str:
    up = ", ".join(f"{c} + 1 AS {c}" for c in raised)
    return (f"u AS (SELECT *, 1 AS batch FROM r WHERE seq % 3 <> 0 "
            f"UNION ALL SELECT * REPLACE ({up}), 2 AS batch FROM r WHERE seq % 3 <> 1)")


def _batches(rows: DataFrame, raised: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return (rows.where("seq % 3 <> 0"),
            rows.where("seq % 3 <> 1").withColumns({c: F.col(c) + 1 for c in raised}))


@register("upsert_station", f"""WITH b3 AS ({b.B3_SQL}),
r AS (SELECT station, CAST(year(valid_hour) AS INTEGER) AS year, CAST(month(valid_hour) AS INTEGER) AS month,
             CAST(day(valid_hour) AS INTEGER) AS day, CAST(hour(valid_hour) AS INTEGER) AS hour,
             CAST(minute(valid_hour) AS INTEGER) AS minute, measure, sky, seq FROM b3),
{_batches_sql(["measure"])},
k AS (SELECT *, row_number() OVER (PARTITION BY station, year, month, day, hour, minute ORDER BY batch DESC, seq DESC) AS rn FROM u)
SELECT {', '.join(_UP_ST_COLS)} FROM k WHERE rn = 1""")
def q_upsert_station(spark, sf):
    rows = with_calendar(b.obs_slice(spark, sf), "valid_hour").select(*_UP_ST_COLS, "seq")
    path = scratch_path(spark, "table-station")
    for batch in _batches(rows, ["measure"]):
        stored = layouts.upsert_station(spark, batch, path)
    return stored.select(*_UP_ST_COLS)


_UP_T_COLS = ["year", "month", "valid_date", "longitude", "latitude", "station", *IND]


@register("upsert_time", f"""WITH b2 AS ({b.B2_SQL}),
r AS (SELECT CAST(year(valid_date) AS INTEGER) AS year, CAST(month(valid_date) AS INTEGER) AS month, valid_date,
             longitude, latitude, CAST(loc AS VARCHAR) AS station, {', '.join(IND)}, seq FROM b2),
{_batches_sql(["ind1"])},
k AS (SELECT *, row_number() OVER (PARTITION BY year, month, valid_date, longitude, latitude ORDER BY batch DESC, seq DESC) AS rn FROM u)
SELECT {', '.join(_UP_T_COLS)} FROM k WHERE rn = 1""")
def q_upsert_time(spark, sf):
    rows = with_calendar(_b2(spark, sf)).withColumn("station", F.col("loc").cast("string")).select(*_UP_T_COLS, "seq")
    path = scratch_path(spark, "table-time")
    for batch in _batches(rows, ["ind1"]):
        stored = layouts.upsert_time(spark, batch, path)
    return stored.select(*_UP_T_COLS)


# ---------------------------------------------------------------------------
# S9-S12, C1 on stored layouts: B1 as station table, B2 as time table
# ---------------------------------------------------------------------------
_TABLES: dict[tuple[str, str, str], str] = {}
_ST_COLS = ["station", "year", "month", "day", "hour", "minute", M, "longitude", "latitude"]
_ST_RANK = "CAST(substr(station, 1, 1) AS INTEGER)"
_STORED_ST = f"""{B1_CAL},
c AS (SELECT *, CAST(day(valid_date) AS INTEGER) AS day, CAST(hour(valid_date) AS INTEGER) AS hour,
             CAST(minute(valid_date) AS INTEGER) AS minute, 6.6::DOUBLE + 2 * {_ST_RANK} AS longitude,
             36.0::DOUBLE + 2 * {_ST_RANK} AS latitude FROM o),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, valid_date ORDER BY seq DESC) AS rn FROM c) WHERE rn = 1)"""
_STORED_T = f"""b2 AS ({b.B2_SQL}),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY valid_date, longitude, latitude ORDER BY seq DESC) AS rn FROM b2) WHERE rn = 1)"""


def _once(spark: SparkSession, sf: str, name: str, load: Callable[[str], DataFrame]) -> str:
    """Path of a table that one application writes once per input, and again if its scratch folders were removed."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _TABLES or not layouts._table_exists(spark, _TABLES[at]):
        path = scratch_path(spark, f"stored-{name}")
        load(path)
        _TABLES[at] = path
    return _TABLES[at]


def stored_station(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.substring("station", 1, 1).cast("int")
    rows = with_calendar(_b1(spark, sf)).withColumns({"longitude": F.lit(6.6) + 2 * rank, "latitude": F.lit(36.0) + 2 * rank}).select(
        *_ST_COLS, "seq")
    return layouts.read_layout(spark, _once(spark, sf, "station", lambda p: layouts.upsert_station(spark, rows, p)),
                               rows.drop("seq").schema)


def stored_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_calendar(_b2(spark, sf)).withColumn("station", F.col("loc").cast("string")).select(*_UP_T_COLS, "seq")
    return layouts.read_layout(spark, _once(spark, sf, "time", lambda p: layouts.upsert_time(spark, rows, p)),
                               rows.drop("seq").schema)


@register("stored_station_year", f"""WITH {_STORED_ST}
SELECT {', '.join(_ST_COLS)} FROM l WHERE station = '{STATION}' AND year = {YEAR}""")
def q_stored_station_year(spark, sf):
    return scans.station_years(stored_station(spark, sf), STATION, YEAR, columns=_ST_COLS)


@register("stored_station_years", f"""WITH {_STORED_ST}
SELECT {', '.join(_ST_COLS)} FROM l WHERE station = '{YEARS[0]}' AND year BETWEEN {YEARS[1]} AND {YEARS[2]}""")
def q_stored_station_years(spark, sf):
    return scans.station_years(stored_station(spark, sf), YEARS[0], YEARS[1], YEARS[2], columns=_ST_COLS)


_T_COLS = ["valid_date", "longitude", "latitude", *IND]


@register("stored_instant", f"""WITH {_STORED_T}
SELECT {', '.join(_T_COLS)} FROM l WHERE valid_date = TIMESTAMP '{INSTANT_B2:%Y-%m-%d %H:%M:%S}'""")
def q_stored_instant(spark, sf):
    return scans.at_instant(stored_time(spark, sf), INSTANT_B2, columns=_T_COLS)


@register("stored_month_range", f"""WITH {_STORED_T}
SELECT {', '.join(_T_COLS)} FROM l WHERE valid_date >= TIMESTAMP '1995-01-01' AND valid_date < TIMESTAMP '1995-11-01'""")
def q_stored_month_range(spark, sf):
    return scans.month_range(stored_time(spark, sf), *RANGE_B2, columns=_T_COLS)


REPORT_POINT = {"lon": 10.9, "lat": 40.2}       # nearest to station rank 2
_REPORT = ("2-HIGH", 1996, (1994, 1997))


def _stored_report(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    obs = stored_station(spark, sf)
    stations = obs.groupBy("station").agg(F.min("longitude").alias("longitude"), F.min("latitude").alias("latitude"))
    return reports.station_report(spark, obs, stations, lat=REPORT_POINT["lat"], lon=REPORT_POINT["lon"], year=_REPORT[1],
                                  measure=M, history=_REPORT[2])


_REPORT_D = f"""{_STORED_ST},
d AS (SELECT station, year, month, season, seq, {M} FROM l WHERE station = '{_REPORT[0]}' AND year = {_REPORT[1]} AND {M} IS NOT NULL)"""


@register("report_box", f"""WITH {_REPORT_D}, {_BOX_Q}
SELECT station, year, season, any_value(n) AS n, any_value(min) AS min, round(any_value(q1), 6) AS q1,
       round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3, any_value(max) AS max,
       min({M}) FILTER (WHERE {M} >= lo_f) AS whisker_lo, max({M}) FILTER (WHERE {M} <= hi_f) AS whisker_hi,
       count(*) FILTER (WHERE {M} < lo_f OR {M} > hi_f) AS n_outliers
FROM f JOIN d USING (station, year, season) GROUP BY station, year, season""")
def q_report_box(spark, sf):
    return rounded(_stored_report(spark, sf)["box"], ["q1", "median", "q3"])


@register("report_history", f"""WITH {_STORED_ST},
d AS (SELECT * FROM l WHERE station = '{_REPORT[0]}' AND year BETWEEN {_REPORT[2][0]} AND {_REPORT[2][1]} AND {M} IS NOT NULL)
SELECT station, year, {_WIDE} FROM d GROUP BY station, year""")
def q_report_history(spark, sf):
    return rounded(_stored_report(spark, sf)["history"], [f"m{m:02d}" for m in range(1, 13)])


def _season_report_sql(data: str, measure: str) -> str:
    """Period statistics with the median and the bisection median on the season rows."""
    return bisect_sql(data, ["station", "year", "season"], measure, tail=f""",
bis AS (SELECT station, year, season, round(mid, 6) AS bisect_{measure} FROM s{ROUNDS}),
{ranked_sql('station, year, season', measure)},
med AS (SELECT station, year, season, round({interp_sql(0.5)}, 6) AS median_{measure} FROM rk GROUP BY station, year, season),
st AS ({_PERIOD_SQL.format(keys='station, year', m=measure, src='d')})
SELECT st.*, med.median_{measure}, bis.bisect_{measure}, {case_sql('st.season', SEASON_LABELS)} AS season_label
FROM st LEFT JOIN med ON st.station = med.station AND st.year = med.year AND st.season = med.season
        LEFT JOIN bis ON st.station = bis.station AND st.year = bis.year AND st.season = bis.season""")


@register("report_seasons", _season_report_sql(_REPORT_D, M))
def q_report_seasons(spark, sf):
    return rounded(_stored_report(spark, sf)["seasons"], [f"avg_{M}", f"median_{M}", f"bisect_{M}"])


# ---------------------------------------------------------------------------
# B5 widened to all 31 fields, written as CSV under two headers, read back and cleaned
# ---------------------------------------------------------------------------
def _field(i: int, name: str, kind: str, spark_side: bool):
    """Field number i of an observation file as text, from the order key."""
    if spark_side:
        k = F.col("k")
        if name in ("lon", "lat"):
            return (k % (90 + i)).cast("string")
        if kind == "timestamp":
            return F.when(k % 7 == 0, F.lit("null")).otherwise(F.concat(F.substring("valid", 1, 10), F.lit(" 01:02:03")))
        value = (k % (50 + i)).cast("string") if kind == "float" else F.concat(F.lit(name), (k % (3 + i)).cast("string"))
        return F.when(k % (11 + i) == 0, F.lit("null")).when(k % (13 + i) == 0, F.lit("   ")).otherwise(value)
    if name in ("lon", "lat"):
        return f"CAST(k % {90 + i} AS FLOAT)"
    if kind == "timestamp":
        return f"CASE WHEN k % 7 <> 0 THEN CAST(day || ' 01:02:03' AS TIMESTAMP) END"
    value = f"CAST(k % {50 + i} AS FLOAT)" if kind == "float" else f"'{name}' || (k % {3 + i})"
    return f"CASE WHEN k % {11 + i} <> 0 AND k % {13 + i} <> 0 THEN {value} END"


@register("csv_by_header", f"""WITH w AS (
    SELECT o_orderkey AS k, o_orderpriority AS station, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderdate FROM orders)
SELECT station, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(k % 24 AS INTEGER) AS hour, CAST(50 AS INTEGER) AS minute,
       CAST(day || ' ' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':50:00' AS TIMESTAMP) AS valid_date,
       {", ".join(f"{_field(i, f, kind, False)} AS {canon}" for i, (f, canon, kind) in enumerate(FIELD_MAP))}
FROM w""".replace("day(o_orderdate)", "dayofmonth(o_orderdate)"))
def q_csv_by_header(spark, sf):
    o = b.table(spark, sf, "orders").withColumn("k", F.col("o_orderkey"))
    wide = o.withColumns({"station": F.col("o_orderpriority"), "valid": F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), F.lpad((F.col("k") % 24).cast("string"), 2, "0"), F.lit(":50"))})
    wide = wide.withColumns({f: _field(i, f, kind, True) for i, (f, _, kind) in enumerate(FIELD_MAP)})
    folders = []
    for part, fields in ((0, RAW_FIELDS), (1, tuple(reversed(RAW_FIELDS)))):
        folders.append(scratch_path(spark, f"csv-{part}"))
        (wide.where(F.col("k") % 2 == part).select(*fields).write.option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folders[-1]))
    good, _ = clean(read_raw(spark, folders), carry=())
    return good


# ---------------------------------------------------------------------------
# Station report (B2: nearest location to the point, one year, ind1)
# ---------------------------------------------------------------------------
def _report_rows(spark, sf) -> tuple[DataFrame, DataFrame]:
    obs = _b2(spark, sf).withColumn("station", F.col("loc").cast("string"))
    return obs, b.stations_of(_b2(spark, sf))


def station_report_frame(spark: SparkSession, sf: str) -> DataFrame:
    obs, st = _report_rows(spark, sf)
    code = reports.find_station(st, lat=POINT["lat"], lon=POINT["lon"], geo=True)
    rows = scans.station_years(obs, code, REPORT_YEAR)
    rep = reports.season_report(rows, "ind1")
    return rounded(rep, ["avg_ind1", "median_ind1", "bisect_ind1"])


_NEAR_ONE = f"""s AS ({b.STATIONS_SQL}),
near AS (SELECT station FROM s ORDER BY {KPD}::DOUBLE * sqrt(
    ((12.3::DOUBLE - s.longitude) * cos(radians((42.24::DOUBLE + s.latitude) / 2))) * ((12.3::DOUBLE - s.longitude) * cos(radians((42.24::DOUBLE + s.latitude) / 2)))
    + (42.24::DOUBLE - s.latitude) * (42.24::DOUBLE - s.latitude)), ord LIMIT 1),
o AS (SELECT CAST(loc AS VARCHAR) AS station, CAST(year(valid_date) AS INTEGER) AS year,
             CAST(month(valid_date) AS INTEGER) AS month, CAST(ceil(month(valid_date) / 3.0) AS INTEGER) AS season, ind1
      FROM ({b.B2_SQL}) WHERE CAST(loc AS VARCHAR) IN (SELECT station FROM near) AND year(valid_date) = {REPORT_YEAR}),
d AS (SELECT * FROM o WHERE ind1 IS NOT NULL)"""
_REPORT_SQL = _season_report_sql(_NEAR_ONE, "ind1")


@register("station_report", _REPORT_SQL)
def q_station_report(spark, sf):
    return station_report_frame(spark, sf)
