"""Stress check (not part of the suite): upsert with one key repeated across a third of the rows.

python tests/stress_upsert.py 3000000
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from obsgrid.session import local_session, scratch_path  # noqa: E402
from obsgrid.sources.layouts import upsert_station  # noqa: E402

spark = local_session(8)
n = int(sys.argv[1])
i = F.col("id")
hot = i < n // 3  # a third of the rows carry the same key
rows = spark.range(n).select(
    F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (i % 200).cast("string"))).alias("station"),
    F.lit(2011).alias("year"),
    F.when(hot, F.lit(1)).otherwise((i % 12 + 1).cast("int")).alias("month"),
    F.when(hot, F.lit(1)).otherwise((i % 28 + 1).cast("int")).alias("day"),
    F.when(hot, F.lit(0)).otherwise((i % 24).cast("int")).alias("hour"),
    F.when(hot, F.lit(0)).otherwise(((i / 24) % 60).cast("int")).alias("minute"),
    i.cast("double").alias("t"), i.alias("seq"))
t = time.time()
table = upsert_station(spark, rows, scratch_path(spark, "stress-upsert"))
hot_rows = table.where("station = 'HOT'").collect()
print("upsert", n, "rows", round(time.time() - t, 1), "s; hot key rows:", len(hot_rows), "t =", hot_rows[0].t,
      "; table rows:", table.count())
