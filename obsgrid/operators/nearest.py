"""Nearest station to many points at once (J3), without a cross join.

The distance (``planar_km``) is KM_PER_DEGREE * sqrt(dlon^2 * c^2 + dlat^2)
with c the cosine at the mean latitude (of degrees taken as radians with
``geo=False``), so a station within d is within d / KM_PER_DEGREE degrees of
latitude, and within that over the least |c| of this window in longitude.

Stations are put into grid cells of sizes doubling from about one station per
cell to one cell for all; coordinates are taken as they are, in any range.

1. bound: a point looks up one station in its own cell of every size; the
   nearest of these is an upper bound d0, and stations near the point are
   found by the small cells, whatever their number. All points of a smallest
   cell have the same cells of every size: the look-up is made once per
   smallest cell, and each point takes the list of its own.
2. exact: by d0 each point picks, for latitude and longitude apart, the least
   cell size that covers its window, so it meets at most three by three cells;
   the minimum over their stations is the true nearest. Where one cell of a
   size meets many points, its stations are repeated and the points dealt out
   over the copies (fewer copied rows than points).

Points at one place are one search, and so are stations at one place (the
first in file order stands for them); the answers then go back to every input
row. Ties go to the station first in file order (``ord``), as a strict "<"
scan in file order would. Points meet cells in merge joins: the planner's
guess of a point list's size must not send it whole through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsgrid.functions.geo import KM_PER_DEGREE, planar_km
from obsgrid.session import shared_dir

# A point with no station nearer than this gets the error marker.
NO_STATION_KM = 1000000.0
NO_STATION = "Erreur"

# number of the size at which one cell holds every coordinate
WHOLE = 99
# points for each copied row of a station, where a cell's points are dealt out, and the most copies
POINTS_PER_COPY = 4
COPIES = 64


def _finite(c: str | Column) -> Column:
    """The coordinate as a double, NULL if it isn't a finite number."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _kept(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _stations(stations: DataFrame) -> DataFrame:
    ord_col = F.col("ord") if "ord" in stations.columns else F.col("station")
    return stations.select(F.col("station").alias("_st"), ord_col.alias("_ord"), _finite("longitude").alias("_slon"),
                           _finite("latitude").alias("_slat")).where("_slon IS NOT NULL AND _slat IS NOT NULL")


def _station_places(stations: DataFrame) -> DataFrame:
    """One station per place, the first in file order."""
    first = stations.groupBy("_slon", "_slat").agg(F.min(F.struct(F.col("_ord").alias("o"), F.col("_st").alias("s"))).alias("_first"))
    return first.select(F.col("_first.s").alias("_st"), F.col("_first.o").alias("_ord"), "_slon", "_slat")


def _size(level: Column | int, base: float) -> Column:
    return F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level) * F.lit(base)


def _cell(x: Column, level: Column, base: float) -> Column:
    return F.when(level == WHOLE, F.lit(0).cast("long")).otherwise(F.floor(x / _size(level, base)).cast("long"))


def _least_cosine(lat: Column, reach: Column, geo: bool) -> Column:
    """The least |cos| of the mean latitude over stations within ``reach`` degrees of latitude."""
    lo, hi = lat - reach / 2, lat + reach / 2
    if geo:
        lo, hi = F.radians(lo), F.radians(hi)

    def half_turn(a: Column) -> Column:
        return F.floor((a - F.lit(math.pi / 2)) / F.lit(math.pi))

    return F.when(half_turn(lo) != half_turn(hi), F.lit(0.0)).otherwise(F.least(F.abs(F.cos(lo)), F.abs(F.cos(hi))))


def _level(reach: Column, base: float, top: int) -> Column:
    """The least size that is ``reach`` or more."""
    n = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(reach, F.lit(1e-300)) / F.lit(base))).cast("int"))
    return F.when(reach.isNull() | (reach > F.lit(base * 2.0 ** top)), F.lit(WHOLE)).otherwise(F.least(n, F.lit(top)))


def _answers(best: DataFrame) -> list[Column]:
    ok = F.col("_best.d") < F.lit(NO_STATION_KM)
    return [F.when(ok, F.col("_best.s")).otherwise(F.lit(NO_STATION)).alias("_station"), F.when(ok, F.col("_best.d")).alias("_km")]


def nearest_to_point(stations: DataFrame, lon: float, lat: float, geo: bool = True) -> tuple[str, float | None]:
    """The station nearest to one point, by one minimum over the list: (code or error marker, distance)."""
    d = planar_km(F.lit(float(lon)), F.lit(float(lat)), F.col("_slon"), F.col("_slat"), geo)
    best = _stations(stations).agg(F.min(F.struct(d.alias("d"), F.col("_ord").alias("o"), F.col("_st").alias("s"))).alias("_best"))
    row = best.select(*_answers(best)).first()
    return row["_station"], row["_km"]


def nearest_station(points: DataFrame, stations: DataFrame, key: str = "pt", geo: bool = True) -> DataFrame:
    """One row per row of ``points`` (key, longitude, latitude): key, station, distance_km.

    ``stations``: station, longitude, latitude and optionally ``ord`` (file
    order; defaults to the station code). A point without finite coordinates
    gets the error marker; such stations are no candidates.
    """
    st = _kept(_station_places(_stations(stations)))
    n, low, high = st.agg(F.count("*"), F.least(F.min("_slon"), F.min("_slat")), F.greatest(F.max("_slon"), F.max("_slat"))).first()
    pts = points.select(key, _finite("longitude").alias("_plon"), _finite("latitude").alias("_plat"))
    if not n:
        return pts.select(key, F.lit(NO_STATION).alias("station"), F.lit(None).cast("double").alias("distance_km"))
    span = max(high - low, 1e-6)
    base = 2.0 ** math.floor(math.log2(span / math.sqrt(n)))
    top = max(0, math.ceil(math.log2(2 * span / base)))

    def dist() -> Column:
        return planar_km(F.col("_plon"), F.col("_plat"), F.col("_slon"), F.col("_slat"), geo)

    # 1. one station of the own cell of every size; the whole plane last, so there is always one
    levels = F.array(*[F.lit(x) for x in [*range(top + 1), WHOLE]])

    def in_cells(df: DataFrame, lon: str | Column, lat: str | Column) -> DataFrame:
        df = df.withColumn("_lev", F.explode(levels))
        x, y = (F.col(c) if isinstance(c, str) else c for c in (lon, lat))
        return df.withColumns({"_cx": _cell(x, F.col("_lev"), base), "_cy": _cell(y, F.col("_lev"), base)})

    # sizes of stations in a cell add up before the shuffle: one row per cell leaves each task
    reps = _kept(in_cells(st, "_slon", "_slat").groupBy("_lev", "_cx", "_cy")
                 .agg(F.min_by(F.struct("_slon", "_slat"), "_ord").alias("_rep")))
    places = (pts.where("_plon IS NOT NULL AND _plat IS NOT NULL").select("_plon", "_plat").distinct()
              .withColumns({"_bx": _cell(F.col("_plon"), F.lit(0), base), "_by": _cell(F.col("_plat"), F.lit(0), base)}))
    # a smallest cell's corner lies in the same cells of every size as the points in it
    corners = in_cells(places.select("_bx", "_by").distinct(), F.col("_bx") * F.lit(base), F.col("_by") * F.lit(base))
    seen = (corners.hint("merge").join(reps, ["_lev", "_cx", "_cy"]).groupBy("_bx", "_by").agg(F.collect_set("_rep").alias("_reps")))

    def to_rep(rep: Column) -> Column:
        return planar_km(F.col("_plon"), F.col("_plat"), rep["_slon"], rep["_slat"], geo)

    bounded = (places.hint("merge").join(seen, ["_bx", "_by"])
               .select("_plon", "_plat", F.array_min(F.transform("_reps", to_rep)).alias("_d0")))

    # 2. the cells that a station nearer than d0 can be in
    reach = F.col("_d0") / F.lit(KM_PER_DEGREE) * F.lit(1 + 1e-9) + F.lit(1e-9)
    cosine = _least_cosine(F.col("_plat"), F.col("_ry"), geo)
    aimed = (bounded.withColumn("_ry", reach)
             .withColumn("_rx", F.when(cosine > 1e-9, F.col("_ry") / cosine * F.lit(1 + 1e-9) + F.lit(1e-9))))
    aimed = _kept(aimed.withColumns({"_ly": _level(F.col("_ry"), base, top), "_lx": _level(F.col("_rx"), base, top)})
                  .withColumns({"_ry": F.when(F.col("_ly") == WHOLE, 0.0).otherwise(F.col("_ry")),
                                "_rx": F.when(F.col("_lx") == WHOLE, 0.0).otherwise(F.col("_rx"))}))
    met = aimed.groupBy("_lx", "_ly").count().collect()                     # pairs of sizes: at most (top + 2)^2
    if not met:
        found = None
    else:
        copies = {(r["_lx"], r["_ly"]): max(1, min(COPIES, r["count"] // (POINTS_PER_COPY * n))) for r in met}
        used = [F.struct(F.lit(x).alias("_lx"), F.lit(y).alias("_ly"), F.lit(c).alias("_copies")) for (x, y), c in copies.items()]
        of_size = F.create_map(*[F.lit(v) for (x, y), c in copies.items() for v in (x * (WHOLE + 1) + y, c)])

        def window(x: str, r: str, level: str) -> Column:
            return F.sequence(_cell(F.col(x) - F.col(r), F.col(level), base), _cell(F.col(x) + F.col(r), F.col(level), base))

        dealt = F.pmod(F.xxhash64("_plon", "_plat"), of_size[F.col("_lx") * F.lit(WHOLE + 1) + F.col("_ly")]).cast("int")
        near = (aimed.select("_plon", "_plat", "_rx", "_ry", "_lx", "_ly", dealt.alias("_copy"))
                .withColumn("_cx", F.explode(window("_plon", "_rx", "_lx")))
                .withColumn("_cy", F.explode(window("_plat", "_ry", "_ly"))).drop("_rx", "_ry"))
        placed = (st.select("*", F.inline(F.array(*used))).withColumns(
            {"_cx": _cell(F.col("_slon"), F.col("_lx"), base), "_cy": _cell(F.col("_slat"), F.col("_ly"), base)})
            .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies"))
        best = (near.hint("merge").join(placed, ["_lx", "_ly", "_copy", "_cx", "_cy"]).groupBy("_plon", "_plat")
                .agg(F.min(F.struct(dist().alias("d"), F.col("_ord").alias("o"), F.col("_st").alias("s"))).alias("_best")))
        found = _kept(best.select("_plon", "_plat", *_answers(best)))
    if found is None:
        return pts.select(key, F.lit(NO_STATION).alias("station"), F.lit(None).cast("double").alias("distance_km"))
    return pts.hint("merge").join(found, ["_plon", "_plat"], "left").select(
        key, F.coalesce("_station", F.lit(NO_STATION)).alias("station"), F.col("_km").alias("distance_km"))
