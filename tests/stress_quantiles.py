"""Stress check (not part of the suite): quartiles of ONE group of n distinct values.

python tests/stress_quantiles.py 20000000 exact|percentile
"""
import sys, time; sys.path.insert(0,'/root/repo')
from obsgrid.session import local_session
from obsgrid.operators.quantiles import exact_quantiles
from pyspark.sql import functions as F
spark = local_session(8)
n = int(sys.argv[1]); which = sys.argv[2]
df = spark.range(n).select(F.lit(0).alias("g"), (F.rand(7) * 1000).alias("_v"))
t = time.time()
if which == "exact":
    r = exact_quantiles(df, ["g"], [0.25, 0.5, 0.75]).collect()[0]
    print("exact", n, round(time.time() - t, 1), "s", [r.q0, r.q1, r.q2])
else:
    r = df.groupBy("g").agg(F.percentile("_v", [0.25, 0.5, 0.75]).alias("q")).collect()[0]
    print("percentile", n, round(time.time() - t, 1), "s", list(r.q))
