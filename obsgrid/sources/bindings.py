"""Bindings B1-B5: the driver's test tables given the shape of observations.

The test tables hold no weather. Each binding is a projection over one whole
table (no row is dropped here); a few values are turned into NULLs or junk by a
fixed rule on the key so that the NULL and cleaning rules have work to do.
The Spark builder and the DuckDB text of each binding give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- B1
def obs_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 (orders): station, valid_date, temperature_f, sky, seq."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    valid = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (k % 24).cast("int"), (F.lit(20) + F.lit(30) * (k % 2)).cast("int"), F.lit(0)
    )
    return o.select(
        F.col("o_orderpriority").alias("station"),
        valid.alias("valid_date"),
        F.when(k % 17 == 0, None).otherwise(F.col("o_totalprice") / 5000).alias("temperature_f"),
        F.when(k % 5 == 0, None).otherwise(F.col("o_orderstatus")).alias("sky"),
        k.alias("seq"),
    )


B1_SQL = """
SELECT o_orderpriority AS station,
       o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST(20 + 30 * (o_orderkey % 2) AS BIGINT)) AS valid_date,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice / 5000 END AS temperature_f,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS sky, o_orderkey AS seq
FROM orders
"""


# --------------------------------------------------------------------------- B2
INDICATORS = ("ind1", "ind2", "ind3", "ind4", "ind5")


def obs_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 (lineitem): loc, longitude, latitude, valid_date, ind1..ind5, seq."""
    li = table(spark, sf_dir, "lineitem")
    s = F.col("l_suppkey")
    return li.select(
        s.alias("loc"),
        (F.lit(6.6) + (s * 37 % 1000) * F.lit(0.01224)).alias("longitude"),
        (F.lit(35.25) + (s * 61 % 1000) * F.lit(0.01185)).alias("latitude"),
        F.col("l_shipdate").alias("valid_date"),
        F.col("l_quantity").alias("ind1"),
        (F.col("l_extendedprice") / 1000).alias("ind2"),
        F.when(F.col("l_orderkey") % 13 == 0, None).otherwise(F.col("l_discount") * 100).alias("ind3"),
        (F.col("l_tax") * 100).alias("ind4"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1000).alias("ind5"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


B2_SQL = """
SELECT l_suppkey AS loc, 6.6::DOUBLE + (l_suppkey * 37 % 1000) * 0.01224::DOUBLE AS longitude,
       35.25::DOUBLE + (l_suppkey * 61 % 1000) * 0.01185::DOUBLE AS latitude,
       l_shipdate AS valid_date, l_quantity AS ind1, l_extendedprice / 1000 AS ind2,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_discount * 100 END AS ind3, l_tax * 100 AS ind4,
       l_extendedprice * (1 - l_discount) / 1000 AS ind5, l_orderkey * 10 + l_linenumber AS seq
FROM lineitem
"""


# --------------------------------------------------------------------------- B3
def obs_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 (events): station, valid_hour, valid_day, measure, sky, seq."""
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts")
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    return ev.select(
        F.col("user_id").cast("string").alias("station"),
        hour.alias("valid_hour"),
        F.to_date(ts).alias("valid_day"),
        F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("value") / 7).alias("measure"),
        F.col("event_type").alias("sky"),
        F.col("event_id").alias("seq"),
    )


B3_SQL = """
SELECT CAST(user_id AS VARCHAR) AS station, date_trunc('hour', ts) AS valid_hour, CAST(ts AS DATE) AS valid_day,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 7 END AS measure, event_type AS sky, event_id AS seq
FROM events
"""


# --------------------------------------------------------------------------- B4
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 (customer): pt, longitude, latitude."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("pt"),
        (F.lit(6.6) + (k * 101 % 997) * F.lit(0.01224)).alias("longitude"),
        (F.lit(35.25) + (k * 67 % 991) * F.lit(0.01185)).alias("latitude"),
    )


B4_SQL = """
SELECT c_custkey AS pt, 6.6::DOUBLE + (c_custkey * 101 % 997) * 0.01224::DOUBLE AS longitude,
       35.25::DOUBLE + (c_custkey * 67 % 991) * 0.01185::DOUBLE AS latitude FROM customer
"""


# --------------------------------------------------------------------------- B5
def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 (orders as text): station, valid, tmpf, skyc1, seq."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    valid = F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
        F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":50"),
    )
    return o.select(
        F.col("o_orderpriority").alias("station"),
        F.when(k % 19 == 0, F.lit("bad")).otherwise(valid).alias("valid"),
        F.when(k % 17 == 0, F.lit("null")).when(k % 23 == 0, F.lit("M"))
        .otherwise((k % 100).cast("string")).alias("tmpf"),
        F.when(k % 5 == 0, F.lit("   ")).otherwise(F.col("o_orderstatus")).alias("skyc1"),
        k.alias("seq"),
    )


B5_SQL = """
SELECT o_orderpriority AS station,
       CASE WHEN o_orderkey % 19 = 0 THEN 'bad' ELSE concat(strftime(o_orderdate, '%Y-%m-%d'), ' ', lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0'), ':50') END AS valid,
       CASE WHEN o_orderkey % 17 = 0 THEN 'null' WHEN o_orderkey % 23 = 0 THEN 'M' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS tmpf,
       CASE WHEN o_orderkey % 5 = 0 THEN '   ' ELSE o_orderstatus END AS skyc1, o_orderkey AS seq
FROM orders
"""


def stations_of(obs_time_df: DataFrame) -> DataFrame:
    """Station list of B2: one row per location with its coordinates and file order."""
    return obs_time_df.groupBy(F.col("loc").cast("string").alias("station")).agg(
        F.min_by("longitude", "seq").alias("longitude"), F.min_by("latitude", "seq").alias("latitude"),
        F.min("seq").alias("ord"),
    )


STATIONS_SQL = f"""
SELECT CAST(loc AS VARCHAR) AS station, min_by(longitude, seq) AS longitude, min_by(latitude, seq) AS latitude, min(seq) AS ord
FROM ({B2_SQL}) GROUP BY loc
"""
