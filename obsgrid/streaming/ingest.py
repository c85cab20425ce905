"""Incremental load of new observation CSV files into both layouts.

A Structured Streaming file source picks up files as they arrive in a folder;
each micro-batch's files are read by their own headers, cleaned and upserted into the station and time layouts
(the same last-row-wins rule as a batch load). The stream's checkpoint keeps
track of the files already loaded, and the upsert is idempotent, so a
restarted or retried batch gives the same tables and rejects. If a batch
stopped while partition folders were moved, the next upsert finishes that first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from obsgrid.session import scratch_path
from obsgrid.sources.csv_ingest import ORDER_COLS, clean, read_raw
from obsgrid.sources.layouts import upsert_station, upsert_time


def read_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The paths of new CSV files of ``folder`` as a stream; contents are not read here."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    r = spark.readStream.format("binaryFile").schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder).select("path")


def start_ingest(spark: SparkSession, folder: str, station_path: str, time_path: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 rejects_path: str | None = None, max_files: int | None = None,
                 num_tasks: int | None = None) -> StreamingQuery:
    """Start the stream; each micro-batch is upserted into both layouts.

    ``max_files`` caps the files per micro-batch; ``num_tasks`` sizes the
    layout writes of each batch.
    """
    checkpoint = checkpoint or scratch_path(spark, "ingest-stream")

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]      # the batch's files, max_files at most
        if not files:
            return
        good, rejects = clean(read_raw(spark, files))
        good = good.persist()
        try:
            upsert_station(spark, good, station_path, order=ORDER_COLS, num_tasks=num_tasks)
            upsert_time(spark, good, time_path, order=ORDER_COLS, num_tasks=num_tasks)
            if rejects_path:
                # the batch's own folder: a retried batch writes it again instead of adding to it
                rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            good.unpersist()

    w = read_stream(spark, folder, max_files).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
