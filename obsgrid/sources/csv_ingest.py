"""Observation CSV source and cleaning (S1-S5), station list source and sink.

Cleaning rules:
* ``valid`` must start with ``Y-M-D H:M`` (digits); other rows are skipped
  (they go to the rejects with reason ``valid``). Trailing text is allowed.
* a row without a station (empty field) is rejected with reason ``station``:
  the station is part of both layouts' keys.
* a field of exactly three blanks or ``null`` is missing (NULL); an empty
  field is NULL too (Spark's CSV reader gives NULL for it).
* a numeric field that is not a number rejects the row (reason = field name);
  ``strict=True`` raises instead, as the original load aborts. A number is a
  plain decimal (``12F`` and ``1d`` are none); NaN, infinity and what is beyond
  a float's range are no readings and become NULL.
* ``valid_date`` is NULL when the five numbers are not a real instant; such
  rows stay in the station layout and are left out of the time layout.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsgrid.schema import FIELD_MAP, NULL_SENTINELS, RAW_FIELDS

# Fixed value: the leading timestamp pattern of the ``valid`` field.
VALID_PATTERN = r"^(\d+)-(\d+)-(\d+) (\d+):(\d+)"

# A decimal number, or a word for one that isn't finite (which is missing).
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_FINITE_PATTERN = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"

HEADER_READERS = 16

ORDER_COLS = ("_src_file", "_src_block", "_src_row")


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The field names in the first line of a file (compressed files included)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        first = lines.readLine()
    finally:
        stream.close()
    return tuple(name.strip() for name in next(csv.reader([(first or "").lstrip("\ufeff")]), []))


def read_raw(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Header-named CSV, every field a string, plus the file position of each row.

    Every file's fields go by its own header, whatever their order; files with
    one header are read together, and a field that a file lacks is NULL in its
    rows. Headers are read by one short read per file, several at a time.
    Quotes inside quoted text are written doubled. ``multiline`` allows line
    breaks inside quoted text but then a file is read by one task.
    The position columns give "file order": (file path, split start, row id).
    """
    files = spark.read.text(path).inputFiles()
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        for file, header in zip(files, pool.map(lambda f: _header(spark, f), files)):
            if header:      # an empty file has no rows
                groups.setdefault(header, []).append(file)
    if not groups:
        raise ValueError(f"no CSV file with a header below {path}")
    present = {f for header in groups for f in header}
    out = None
    for header, members in groups.items():
        missing = [f for f in ("station", "valid") if f not in header]
        if missing:
            raise ValueError(f"CSV lacks required fields {missing}: {members[0]}")
        doubled = sorted({f for f in RAW_FIELDS if header.count(f) > 1})
        if doubled:
            raise ValueError(f"CSV names fields twice {doubled}: {members[0]}")
        # names by place, so that columns nobody asks for may have any name
        names = [f if f in RAW_FIELDS else f"_other{i}" for i, f in enumerate(header)]
        df = (spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).option("header", True)
              .option("quote", '"').option("escape", '"').option("multiLine", multiline)
              .option("mode", "PERMISSIVE").csv(members))
        part = df.select(
            *[(F.col(f) if f in header else F.lit(None).cast("string")).alias(f) for f in RAW_FIELDS if f in present],
            F.col("_metadata.file_path").alias("_src_file"),
            F.col("_metadata.file_block_start").alias("_src_block"),
            F.monotonically_increasing_id().alias("_src_row"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _missing(raw: Column) -> Column:
    return raw.isNull() | raw.isin(*NULL_SENTINELS)


def _numbers(fields: list[Column]) -> Column:
    """The fields as an array of floats: NULL where there is no number, or one beyond a float's range."""
    read = F.transform(F.array(*fields), lambda r: F.when(r.rlike(NUMBER_PATTERN), F.trim(r).try_cast("float")))
    return F.transform(read, lambda x: F.when(F.abs(x) < float("inf"), x))


def _instant_parts(valid: Column) -> Column:
    """Year, month, day, hour and minute as an array of ints (NULL: too long a number); no five parts without the pattern."""
    return F.transform(F.split(F.regexp_extract(valid, VALID_PATTERN, 0), "[- :]"), lambda part: part.try_cast("int"))


def clean(raw: DataFrame, carry: tuple[str, ...] = ("seq",) + ORDER_COLS,
          strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Type and rename raw rows. Returns (good rows, rejects).

    Works on any subset of the CSV fields (``station`` and ``valid`` required).
    Good rows: station, year..minute, valid_date, the canonical columns of the
    fields present, carried columns. Rejects: carried columns, station, valid,
    reason (comma-separated field names).

    The fields are read in arrays, each text by one pattern match: an expression
    per field makes one generated method of all of them, which is too long for
    the JVM to compile.
    """
    carry = tuple(c for c in carry if c in raw.columns)
    parts = _instant_parts(F.col("valid"))

    numbers, others, bad = [], [], []
    for field, canon, kind in FIELD_MAP:
        if field not in raw.columns:
            continue
        r = F.col(field)
        if kind == "float":
            required = canon in ("longitude", "latitude")
            is_bad = F.get(_numbers([r]), F.lit(0)).isNull() if required else (
                ~r.rlike(NUMBER_PATTERN) & ~_missing(r) & ~r.rlike(NOT_FINITE_PATTERN))
            numbers.append((field, canon))
        elif kind == "timestamp":
            ts = r.try_cast("timestamp_ntz")
            is_bad = ~_missing(r) & ts.isNull()
            others.append((canon, F.when(_missing(r), None).otherwise(ts)))
        else:
            is_bad = F.lit(False)
            others.append((canon, F.when(_missing(r), None).otherwise(r)))
        if kind in ("float", "timestamp"):
            bad.append(F.when(is_bad, F.lit(field)))

    # a numeric part too long for an int also makes the date unreadable
    date_ok = F.coalesce((F.size(parts) == 5) & F.forall(parts, lambda x: x.isNotNull()), F.lit(False))
    # the station is part of both primary keys: a row without one cannot be stored
    no_station = F.coalesce(F.col("station").isNull() | (F.trim(F.col("station")) == ""), F.lit(True))
    faults = F.filter(F.array(*bad), lambda f: f.isNotNull()) if bad else F.array().cast("array<string>")
    reason = F.when(no_station, F.lit("station")).when(~date_ok, F.lit("valid")).when(F.size(faults) > 0, F.array_join(faults, ","))
    tagged = raw.select("*", reason.alias("_reason"))
    if strict:
        first = tagged.where(F.col("_reason").isNotNull() & (F.col("_reason") != "valid")).limit(1).collect()
        if first:
            raise ValueError(f"row cannot be loaded (field(s): {first[0]['_reason']})")
    read = tagged.where(F.col("_reason").isNull()).select(
        "station", parts.alias("_at"), _numbers([F.col(f) for f, _ in numbers]).alias("_numbers") if numbers else F.lit(None).alias("_numbers"),
        *[value.alias(canon) for canon, value in others], *carry)
    at = [F.get("_at", F.lit(i)) for i in range(5)]
    place = {canon: i for i, (_, canon) in enumerate(numbers)}
    present = [canon for field, canon, _ in FIELD_MAP if field in raw.columns]
    good = read.select(
        "station", *[p.alias(n) for p, n in zip(at, ("year", "month", "day", "hour", "minute"))],
        F.try_make_timestamp_ntz(*at, F.lit(0)).alias("valid_date"),
        *[F.get("_numbers", F.lit(place[c])).alias(c) if c in place else F.col(c) for c in present], *carry)
    rejects = tagged.where(F.col("_reason").isNotNull()).select(
        *carry, "station", "valid", F.col("_reason").alias("reason"))
    return good, rejects


def read_station_list(spark: SparkSession, path: str) -> DataFrame:
    """Station list CSV (Station, Longitude, Latitude) with its file order as ``ord``."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = {c.lower(): c for c in df.columns}
    return df.select(
        F.col(cols["station"]).alias("station"),
        F.col(cols["longitude"]).cast("double").alias("longitude"),
        F.col(cols["latitude"]).cast("double").alias("latitude"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                 F.monotonically_increasing_id()).alias("ord"),
    )


def write_station_list(stations: DataFrame, path: str) -> None:
    """Write the station list as one CSV with header, in first-seen order.

    The station list is one row per station (a small dimension), so one
    output file is right for it.
    """
    (stations.orderBy("ord").select(F.col("station").alias("Station"), F.col("longitude").alias("Longitude"),
                                    F.col("latitude").alias("Latitude"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))
