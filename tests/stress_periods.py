"""Stress check (not part of the suite): fused year/month/season statistics, one station hot.

python tests/stress_periods.py 50000000
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from obsgrid.operators.periods import period_stats  # noqa: E402
from obsgrid.session import local_session  # noqa: E402

spark = local_session(8)
n = int(sys.argv[1])
i = F.col("id")
obs = spark.range(n).select(
    F.when(i % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (i % 1000).cast("string"))).alias("station"),
    (F.lit(2000) + (i % 10)).cast("int").alias("year"), (i % 12 + 1).cast("int").alias("month"),
    (F.rand(1) * 100).alias("temperature_f"))
t = time.time()
rows = period_stats(obs, "temperature_f").count()
print("period_stats", n, "rows ->", rows, "groups in", round(time.time() - t, 1), "s")
