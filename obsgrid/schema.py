"""Schemas, the CSV-to-canonical rename map, the measure registry and the two layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source data's conventions).
#
# FIELD_MAP: CSV header of an observation file after ``station`` and ``valid``, in
# file order, with the canonical column each field becomes and its kind.
# A field holding exactly three blanks or the word null is missing.
# ---------------------------------------------------------------------------
NULL_SENTINELS = ("   ", "null")

FIELD_MAP: tuple[tuple[str, str, str], ...] = (
    ("lon", "longitude", "float"),
    ("lat", "latitude", "float"),
    ("tmpf", "temperature_f", "float"),
    ("dwpf", "dew_point_f", "float"),
    ("relh", "relative_humidity", "float"),
    ("drct", "wind_direction", "float"),
    ("sknt", "wind_speed", "float"),
    ("p01i", "precipitation", "float"),
    ("alti", "pressure", "float"),
    ("mslp", "sea_level_pressure", "float"),
    ("vsby", "visibility", "float"),
    ("gust", "wind_gust", "float"),
    ("skyc1", "sky_level1_coverage", "text"),
    ("skyc2", "sky_level2_coverage", "text"),
    ("skyc3", "sky_level3_coverage", "text"),
    ("skyc4", "sky_level4_coverage", "text"),
    ("skyl1", "sky_level1_altitude", "float"),
    ("skyl2", "sky_level2_altitude", "float"),
    ("skyl3", "sky_level3_altitude", "float"),
    ("skyl4", "sky_level4_altitude", "float"),
    ("wxcodes", "weather_code", "text"),
    ("ice_accretion_1hr", "ice_accretion1", "float"),
    ("ice_accretion_3hr", "ice_accretion3", "float"),
    ("ice_accretion_6hr", "ice_accretion6", "float"),
    ("peak_wind_gust", "peak_wind_gust", "float"),
    ("peak_wind_drct", "peak_wind_direction", "float"),
    ("peak_wind_time", "peak_wind_time", "timestamp"),
    ("feel", "temperature", "float"),
    ("metar", "observation", "text"),
)

RAW_FIELDS: tuple[str, ...] = ("station", "valid") + tuple(f for f, _, _ in FIELD_MAP)

# The 27 measures a user may pick by name, in the documented order.
MEASURES: tuple[str, ...] = (
    "temperature_f", "dew_point_f", "relative_humidity", "wind_direction", "wind_speed",
    "precipitation", "pressure", "sea_level_pressure", "visibility", "wind_gust",
    "sky_level1_coverage", "sky_level2_coverage", "sky_level3_coverage", "sky_level4_coverage",
    "sky_level1_altitude", "sky_level2_altitude", "sky_level3_altitude", "sky_level4_altitude",
    "weather_code", "ice_accretion1", "ice_accretion3", "ice_accretion6",
    "peak_wind_gust", "peak_wind_direction", "peak_wind_time", "temperature", "observation",
)

# The five indicators of the location profile used for clustering.
PROFILE_INDICATORS: tuple[str, ...] = (
    "temperature_f", "dew_point_f", "relative_humidity", "wind_speed", "pressure",
)

# Season number (calendar quarter) -> label.
SEASON_LABELS: dict[int, str] = {1: "printemps", 2: "été", 3: "automne", 4: "hiver"}

# Map extent of the observation network (degrees).
MAP_EXTENT = {"lon_min": 6.6, "lat_min": 35.25, "lon_max": 18.84, "lat_max": 47.1}

# Marker colour per cluster number.
CLUSTER_COLOURS: dict[int, str] = {
    0: "lightblue", 1: "lightgreen", 2: "orange", 3: "red",
    4: "cadetblue", 5: "pink", 6: "white", 7: "lightgray",
}

# ---------------------------------------------------------------------------
# Spark types
# ---------------------------------------------------------------------------
_KIND_TYPE = {"float": T.FloatType(), "text": T.StringType(), "timestamp": T.TimestampNTZType()}

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in RAW_FIELDS])

CALENDAR = ("year", "month", "day", "hour", "minute")

OBSERVATION_SCHEMA = T.StructType(
    [T.StructField("station", T.StringType(), False)]
    + [T.StructField(c, T.IntegerType(), False) for c in CALENDAR]
    + [T.StructField(canon, _KIND_TYPE[kind], canon not in ("longitude", "latitude"))
       for _, canon, kind in FIELD_MAP]
)

TIME_SCHEMA = T.StructType(
    OBSERVATION_SCHEMA.fields[:6]
    + [T.StructField("valid_date", T.TimestampNTZType(), False)]
    + OBSERVATION_SCHEMA.fields[6:]
)

MEASURE_KIND = {canon: kind for _, canon, kind in FIELD_MAP}


@dataclass(frozen=True)
class Layout:
    """A keyed Parquet layout: directory partitions, in-file sort order, primary key."""

    name: str
    partition_by: tuple[str, ...]
    sort_by: tuple[str, ...]

    @property
    def key(self) -> tuple[str, ...]:
        return self.partition_by + self.sort_by


# "One station over time": partition (station, year), clustering (month, day, hour, minute).
STATION_LAYOUT = Layout("station", ("station", "year"), ("month", "day", "hour", "minute"))
# "All stations at one time": partition (year, month), clustering (valid_date, longitude, latitude).
TIME_LAYOUT = Layout("time", ("year", "month"), ("valid_date", "longitude", "latitude"))
