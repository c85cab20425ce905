"""Stress check (not part of the suite): CSV -> clean -> both layouts.

python tests/stress_load.py 2000000   (rows; 100 stations, hourly readings)
"""
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from obsgrid.schema import RAW_FIELDS  # noqa: E402
from obsgrid.session import local_session, scratch_path  # noqa: E402
from obsgrid.sources.csv_ingest import ORDER_COLS, clean, read_raw  # noqa: E402
from obsgrid.sources.layouts import upsert_station, upsert_time  # noqa: E402

spark = local_session(8)
n = int(sys.argv[1])
i = F.col("id")
# one reading per station and hour: every (station, instant) key is distinct
ts = F.make_timestamp_ntz(F.lit(2010), F.lit(1), F.lit(1), F.lit(0), F.lit(50), F.lit(0)) + F.make_dt_interval(
    F.lit(0), (i / 100).cast("int"), F.lit(0), F.lit(0))
cols = {f: F.lit("null") for f in RAW_FIELDS}
cols.update({"station": F.concat(F.lit("ST"), (i % 100).cast("string")),
             "valid": F.date_format(ts, "yyyy-MM-dd HH:mm"),
             "lon": ((i % 100) * 0.1 + 7).cast("string"), "lat": ((i % 100) * 0.1 + 38).cast("string"),
             "tmpf": F.format_number(F.rand(1) * 60 + 20, 1), "skyc1": F.lit("FEW"), "metar": F.lit("X")})
src = scratch_path(spark, "stress-csv")
spark.range(n).select(*[cols[f].alias(f) for f in RAW_FIELDS]).write.option("header", True).csv(src)
t = time.time()
good, rejects = clean(read_raw(spark, src))
good = good.persist()
st = upsert_station(spark, good, scratch_path(spark, "stress-st"), order=ORDER_COLS)
tm = upsert_time(spark, good, scratch_path(spark, "stress-tm"), order=ORDER_COLS)
print("load", n, "rows", round(time.time() - t, 1), "s; station rows", st.count(), "time rows", tm.count(),
      "rejects", rejects.count())
