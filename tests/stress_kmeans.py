"""Stress check (not part of the suite): Lloyd k-means on many profile rows.

python tests/stress_kmeans.py 1000000   (rows; 20 features, k=3, 10 rounds)
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from obsgrid.operators.kmeans import kmeans_fit  # noqa: E402
from obsgrid.session import local_session  # noqa: E402

spark = local_session(8)
n = int(sys.argv[1])
feats = [f"f{i}" for i in range(20)]
df = spark.range(n).select(F.col("id").cast("double").alias("longitude"), F.lit(0.0).alias("latitude"),
                           *[(F.rand(i) * 10 + (F.col("id") % 3) * 20).alias(f) for i, f in enumerate(feats)])
t = time.time()
labelled, centres = kmeans_fit(df, feats, k=3, rounds=10)
sizes = sorted(r["count"] for r in labelled.groupBy("cluster").count().collect())
print("kmeans", n, "rows", round(time.time() - t, 1), "s", sizes)
