"""Stress check (not part of the suite): nearest station for many points.

python tests/stress_nearest.py 1000000 10000   (points, stations)
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from obsgrid.operators.nearest import nearest_station  # noqa: E402
from obsgrid.session import local_session  # noqa: E402

spark = local_session(8)
n_pts, n_st = int(sys.argv[1]), int(sys.argv[2])
pts = spark.range(n_pts).select(F.col("id").alias("pt"), (F.rand(1) * 360 - 180).alias("longitude"),
                                (F.rand(2) * 130 - 60).alias("latitude"))
st = spark.range(n_st).select(F.concat(F.lit("S"), F.col("id")).alias("station"), F.col("id").alias("ord"),
                              (F.rand(3) * 360 - 180).alias("longitude"), (F.rand(4) * 130 - 60).alias("latitude"))
t = time.time()
res = nearest_station(pts, st, geo=True)
res.write.format("noop").mode("overwrite").save()
print("nearest", n_pts, "points", n_st, "stations", round(time.time() - t, 1), "s")
