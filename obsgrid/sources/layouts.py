"""Keyed upsert sinks for the two Parquet layouts.

Parquet has no MERGE. An upsert here:
1. reduces the incoming rows to the last row per key (``max_by`` over the
   ingest order: an aggregate with partial aggregation, so a key repeated
   very often is reduced in every map task before the shuffle);
2. counts the batch's rows per partition folder. A NULL or empty partition
   value stops the upsert before anything is written: it names no folder;
3. reads the stored rows of exactly those partitions (a semi join; up to
   ``PRUNED`` partitions it is broadcast and also given as filters on the
   partition columns, so the scan lists and reads only those folders). They
   rank below every new row, and the union is reduced again;
4. writes the merged partitions once, sorted, to a stage inside the table's
   own folder (hidden from readers, and on the same file system, so that a move
   is a rename; no clean-up of scratch folders reaches it), then writes a
   journal of every folder to move with its files and their sizes, by a Spark
   job too;
5. for each folder, renames the old one aside and then the new one into its
   place. A folder's state is read from what is there: staged, old set aside, or
   moved. Only when all are moved is the upsert marked as done, and the old
   folders go. Where the table is in a folder that the machines share (``file:``),
   more than ``HERE`` folders are moved and removed by Spark tasks; on other file
   systems the driver moves them through Hadoop's client.

A stop at any point leaves the old table (no journal yet), or a journal that the
next upsert, or ``finish_upsert``, first works off: to the new table if every
folder that is not yet moved is whole in the stage; else back to the old
table, with ``StageLost``. If neither can be had, ``StageLost`` says which
folders are missing and nothing is removed. One writer at a time is assumed.

A table is whatever data its folder holds: markers don't matter, and no step
ever overwrites the folder as a whole. A first load (no data yet) of up to
``LISTED`` folders is written straight into it.

Files are range-partitioned on the full key and sorted within partitions, so
a partition that holds a large share of the rows is written by many tasks,
and min/max statistics of the clustering columns stay selective.

Spark's file reader and writer keep an entry on the driver for every folder and
file. Beyond ``LISTED`` folders of a shared (``file:``) table none of that grows:
the same folders and files are listed, read and written by tasks, with Arrow, and
a first load is staged like any other batch. The frame that an upsert returns is
then not pruned by filters; ``read_layout`` always is, and always lists.
"""

from __future__ import annotations

import os
import posixpath
import re
import shutil
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, suppress
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsgrid.schema import STATION_LAYOUT, TIME_LAYOUT, Layout
from obsgrid.session import shared_dir

# touched partitions up to which the scan gets them as filters
PRUNED = 10_000
# incoming rows for each write task
ROWS_PER_TASK = 2_000_000
# partition folders that the driver moves at once, and up to which it moves them itself
MOVERS = 16
HERE = 1_000
# partition folders up to which Spark's reader lists a table and Spark's writer lays out a batch; beyond, tasks do
LISTED = 10_000
# rows that such a task holds for a row group, or for a batch that it passes on
ROW_GROUP, ROWS_AT_ONCE = 100_000, 10_000
# tasks for each core that list a table's folders, or move them
TASKS_PER_CORE = 4
# types that such tasks read and write, and those of partition values
INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
PLAIN = (T.StringType, *INTS, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
NAMING = (T.StringType, *INTS, T.DateType)
# what Spark escapes in a folder's name, and its name for NULL
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# marks of a file by which Spark's reader tells the calendar of its old dates: of today, as tasks write them, or of before 1582
TODAYS, JULIAN = b"org.apache.spark.version", (b"org.apache.spark.legacyDateTime", b"org.apache.spark.legacyINT96")
# folder in the table's folder with the stage, the journal and the old folders of an upsert that has not finished
PENDING = "_pending_upsert"
NEW, OLD, JOURNAL, DONE = "new", "old", "journal", "done"
# a line of the journal: folder to move, whether the table had it, its files from there and their lengths
MOVE = "folder string, replaces boolean, files map<string,bigint>"


class StageLost(RuntimeError):
    """An upsert that stopped part-way can't be finished, because staged folders are missing or cut short."""


def dedup_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key by ``order`` (the whole row wins, NULLs included)."""
    key = list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None)
    out = df.groupBy(*key).agg(F.max_by(payload, ordering).alias("_row"))
    return out.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds any data: a partition folder or a file that isn't a marker."""
    if (shared := _Folder(spark, path).shared()) and os.path.isdir(shared.path()):
        with os.scandir(shared.path()) as found:        # as they are found: there may be very many
            return any(not one.name.startswith(("_", ".")) for one in found)
    fs, p = _fs_path(spark, path)
    return fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


class _Folder:
    """Paths below one folder, as the cluster's file system has them."""

    def __init__(self, spark: SparkSession, top: str):
        self.spark, jvm = spark, spark.sparkContext._jvm
        self.top = top.rstrip("/")
        # looked up once: the gateway asks for each part of a class name, every time
        self._path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self.fs = self._path(self.top).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self._path(posixpath.join(self.top, *parts))

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.path(*parts))

    def rename(self, source: Sequence[str], target: Sequence[str]) -> None:
        to = self.path(*target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(*source), to):
            raise OSError(f"cannot move {self.path(*source)} to {to}")

    def remove(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)

    def write(self, text: str, *parts: str) -> None:
        """A file that is either whole or not there."""
        draft = self.path(*parts[:-1], f".{parts[-1]}-{uuid.uuid4().hex}")
        out = self.fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.fs.rename(draft, self.path(*parts)):
            raise OSError(f"cannot write {self.path(*parts)}")

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.path(*parts))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def data_files(self, *parts: str) -> DataFrame:
        """Data files anywhere below a folder, listed by Spark: their path from there and length."""
        if not self.exists(*parts):
            return self.spark.createDataFrame([], "file string, length bigint")
        top = self.fs.makeQualified(self.path(*parts)).toUri().getPath()
        with _listing(self.spark):
            found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(posixpath.join(self.top, *parts))
        path = F.regexp_replace("path", "^[A-Za-z][^:/]*:(//[^/]*)?", "")
        return found.select(F.substring(path, len(top.rstrip("/")) + 2, 2 ** 31 - 1).alias("file"), "length")

    def files(self, *parts: str) -> dict[str, int]:
        """Data files below a folder: path from there -> length."""
        return {f.file: f.length for f in self.data_files(*parts).collect()}

    def shared(self) -> _Shared | None:
        """The same folder as every machine has it, if it is in a plain folder that they share."""
        if self.fs.getUri().getScheme() != "file":
            return None
        return _Shared(self.fs.makeQualified(self._path(self.top)).toUri().getPath())


class _Shared:
    """Paths below one folder that driver and executors share; goes to tasks."""

    def __init__(self, top: str):
        self.top = top

    def path(self, *parts: str) -> str:
        return os.path.join(self.top, *parts)

    def exists(self, *parts: str) -> bool:
        return os.path.exists(self.path(*parts))

    def rename(self, source: Sequence[str], target: Sequence[str]) -> None:
        to = self.path(*target)
        os.makedirs(os.path.dirname(to), exist_ok=True)
        os.rename(self.path(*source), to)

    def remove(self, *parts: str) -> None:
        shutil.rmtree(self.path(*parts), ignore_errors=True)        # the upsert's whole folder is removed after it

    def files(self, *parts: str) -> dict[str, int]:
        """Data files below a folder, without those that Spark's readers skip: path from there -> length."""
        top, out = self.path(*parts), {}
        for at, folders, files in os.walk(top):
            folders[:] = [f for f in folders if not _hidden(f)]
            out |= {os.path.relpath(os.path.join(at, f), top): os.path.getsize(os.path.join(at, f)) for f in files if not _hidden(f)}
        return out

    def below(self, *parts: str) -> Iterator[str]:
        """Names of the folders in a folder, without those that Spark's readers skip, as they are found."""
        with suppress(FileNotFoundError), os.scandir(self.path(*parts)) as found:
            for one in found:
                if one.is_dir() and not _hidden(one.name):
                    yield one.name

    def lowest(self, *parts: str) -> Iterator[str]:
        """Folders below a folder that have none below them."""
        at = None
        for at in self.below(*parts):
            yield from (os.path.join(at, f) for f in self.lowest(*parts, at))
        if at is None:
            yield ""

    def many(self, limit: int, *parts: str) -> bool:
        """Whether a folder has more lowest folders than that."""
        return next(islice(self.lowest(*parts), limit, None), None) is not None

    def share(self, k: int, n: int, *parts: str) -> list[str]:
        """The k-th of n shares of the folders below a folder, on the highest level that has enough to deal out."""
        level, above = [""], None
        while len(level) < 16 * n and level != above:
            above = level
            level = [os.path.join(f, d) if d else f for f in above for d in ([*self.below(*parts, f)] or [""])]
        return sorted(f for f in level if zlib.crc32(f.encode()) % n == k)

    def shares(self, spark: SparkSession, *parts: str) -> RDD:
        """The folders below a folder, dealt to some tasks per core, each of which looks for its own."""
        n = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        return spark.sparkContext.parallelize(range(n), n).flatMap(lambda k: self.share(k, n, *parts))


def _clear(table: _Folder, *parts: str) -> None:
    """Remove a folder: more than ``HERE`` folders below it by tasks."""
    if (shared := table.shared()) and shared.many(HERE, *parts):
        shared.shares(table.spark, *parts).foreach(lambda at: shared.remove(*parts, at))
    table.remove(*parts)


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders listed by some tasks per core: by itself Spark takes a task for each folder, up to 10 000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _pending(spark: SparkSession, path: str) -> str | None:
    """The stage of an upsert that has a journal but has not finished. Stages without one are what a stop before it left: they go."""
    table = _Folder(spark, path)
    if not table.exists(PENDING):
        return None
    if table.fs.getFileStatus(table.path(PENDING)).isFile():
        raise StageLost(f"{path}/{PENDING} is an older version's note of a stage at {table.read(PENDING).strip()}: finish it by that version")
    left = [str(st.getPath().getName()) for st in table.fs.listStatus(table.path(PENDING))]
    for one in left:
        if not table.exists(PENDING, one, JOURNAL):
            _clear(table, PENDING, one)
    left = [one for one in left if table.exists(PENDING, one, JOURNAL)]
    if not left:
        table.remove(PENDING)
        return None
    return posixpath.join(path.rstrip("/"), PENDING, left[0], NEW)


def read_layout(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a layout with an explicit schema (partition values are not type-inferred)."""
    with _listing(spark):
        return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_layout(df: DataFrame, path: str, layout: Layout, mode: str = "append",
                 num_tasks: int | None = None) -> None:
    """Range-partition on the full key (explicit task count, so adaptive execution
    does not fold a write over many partition folders into one task), sort within
    tasks, write one folder per partition value."""
    (_laid_out(df, layout, num_tasks)
     .write.mode(mode).partitionBy(*layout.partition_by).parquet(path))


def _laid_out(df: DataFrame, layout: Layout, num_tasks: int | None) -> DataFrame:
    cols = [c for c in layout.key if c in df.columns]
    n = num_tasks or df.sparkSession.sparkContext.defaultParallelism
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


def _tasks_can(schema: T.StructType, partition_by: Sequence[str]) -> bool:
    """Whether tasks can read and write such rows as Spark does."""
    return set(partition_by) <= set(schema.names) and all(isinstance(f.dataType, NAMING if f.name in partition_by else PLAIN) for f in schema.fields)


def _folder_of(names: Sequence[str], values: Sequence[str]) -> str:
    """A partition's folder, as Spark names it."""
    return "/".join(f"{n}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', v)}" for n, v in zip(names, values))


def _values_of(folder: str) -> dict[str, str | None]:
    """Partition values that a folder's path names."""
    found = (part.partition("=") for part in folder.split("/") if "=" in part)
    return {n: None if v == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda c: chr(int(c[1], 16)), v) for n, _, v in found}


class _Writer:
    """One file of a folder. It gets its name when it is whole, the same name if the task runs again."""

    def __init__(self, folder: str, task: int, codec: str, version: str):
        os.makedirs(folder, exist_ok=True)
        self.place, self.codec, self.version = os.path.join(folder, f"part-{task:05d}.parquet"), codec, version
        self.draft, self.out = os.path.join(folder, f".part-{uuid.uuid4().hex}"), None
        self.held, self.rows = [], 0

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.rows += rows.num_rows
        if self.rows >= ROW_GROUP:
            self.flush()

    def flush(self) -> None:
        table = pa.Table.from_batches(self.held).replace_schema_metadata({TODAYS: self.version})
        self.out = self.out or pq.ParquetWriter(self.draft, table.schema, compression=self.codec)
        self.out.write_table(table)
        self.held, self.rows = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        self.out.close()
        os.replace(self.draft, self.place)


def _write_by_tasks(df: DataFrame, to: _Shared, layout: Layout, num_tasks: int | None = None) -> None:
    """The files of ``write_layout``, without an entry on the driver for each folder."""
    names = list(layout.partition_by)
    data = [c for c in df.columns if c not in names]
    version, codec = df.sparkSession.version, df.sparkSession.conf.get("spark.sql.parquet.compression.codec").lower()
    codec = {"uncompressed": "none", "lz4_raw": "lz4", "lz4raw": "lz4"}.get(codec, codec)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now, file, rows = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            at = [batch.column(len(data) + i) for i in range(len(names))]
            new = np.ones(batch.num_rows, bool)
            new[1:] = False
            for c in at:
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(len(c) - 1, 0))).to_numpy(zero_copy_only=False)
            rest = batch.select(list(range(len(data))))
            starts = np.flatnonzero(new).tolist()
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                folder = _folder_of(names, [c[start].as_py() for c in at])
                if folder != now:
                    if file:
                        file.close()
                    now, file = folder, _Writer(to.path(folder), task, codec, version)
                file.add(rest.slice(start, end - start))
            rows += batch.num_rows
        if file:
            file.close()
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    # partition values as Spark writes them in a folder's name
    values = [F.col(c).cast("string").alias(c) for c in names]
    _laid_out(df, layout, num_tasks).select(*data, *values).mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()


def _as(found: pa.Array, kind: pa.DataType, where: str) -> pa.Array:
    """A file's column as the schema has it, where Spark's reader would take it too."""
    has, is_ = found.type, pa.types
    if has == kind:
        return found
    wider = any(f(has) and f(kind) and has.bit_width <= kind.bit_width for f in (is_.is_floating, is_.is_signed_integer))
    instant = is_.is_timestamp(has) and is_.is_timestamp(kind) and (kind.tz or not has.tz)
    text = any(all(f(t) or g(t) for t in (has, kind)) for f, g in ((is_.is_string, is_.is_large_string), (is_.is_binary, is_.is_large_binary)))
    if not (wider or instant or text):
        raise TypeError(f"{where} holds {has}, not {kind}")
    return found.cast(kind)


def _rows_by_tasks(spark: SparkSession, table: _Shared, files: RDD, schema: T.StructType, names: Sequence[str]) -> DataFrame:
    """Rows of a layout's files, dealt out by file, so that a folder of many is read by many tasks; columns as Spark's reader has them."""
    columns = [*[f for f in schema.fields if f.name not in names], *[schema[n] for n in names]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in columns])
    kinds = spark.createDataFrame([], schema).toArrow().schema
    # an instant is the same in any zone
    kinds = pa.schema([(f.name, pa.timestamp("us", "UTC") if pa.types.is_timestamp(f.type) and f.type.tz else f.type) for f in kinds])
    exact = spark.conf.get("spark.sql.caseSensitive").lower() == "true"

    def of(file: str) -> Iterator[pa.RecordBatch]:
        values = _values_of(posixpath.dirname(file))
        with pq.ParquetFile(table.path(file), coerce_int96_timestamp_unit="us") as source:
            if any(mark in (source.metadata.metadata or {}) for mark in JULIAN):
                raise ValueError(f"{file} has dates of the Julian calendar: write the table anew without the LEGACY rebase mode")
            has = {n if exact else n.lower(): n for n in source.schema_arrow.names}
            wanted = {f.name: has.get(f.name if exact else f.name.lower()) for f in kinds if f.name not in values}
            for batch in source.iter_batches(ROWS_AT_ONCE, columns=[n for n in wanted.values() if n]):
                def column(f: pa.Field) -> pa.Array:
                    if f.name in values:
                        return pa.repeat(pa.scalar(values[f.name], pa.string()).cast(f.type), batch.num_rows)
                    if not wanted[f.name]:
                        return pa.nulls(batch.num_rows, f.type)
                    return _as(batch.column(wanted[f.name]), f.type, f"{file}: {f.name}")

                yield pa.RecordBatch.from_arrays([column(f) for f in kinds], schema=kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in (part for names in batches for file in names.column(0).to_pylist() for part in of(file)):
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = spark.createDataFrame(files.map(lambda f: (f,)), "file string")
    return listed.repartition(tasks, "file").mapInArrow(read, schema)


def _stored(spark: SparkSession, path: str, schema: T.StructType, layout: Layout) -> DataFrame:
    """The table's rows: by Spark's reader, or by tasks if it has more than ``LISTED`` folders."""
    shared = _Folder(spark, path).shared()
    if shared is None or not _tasks_can(schema, layout.partition_by) or not shared.many(LISTED):
        return read_layout(spark, path, schema)
    files = shared.shares(spark).flatMap(lambda at: (os.path.join(at, f) for f in shared.files(at)))
    return _rows_by_tasks(spark, shared, files, schema, layout.partition_by)


def _stored_at(spark: SparkSession, path: str, schema: T.StructType, layout: Layout, touched: DataFrame) -> DataFrame:
    """Stored rows of the touched partitions."""
    names = list(layout.partition_by)
    shared = _Folder(spark, path).shared()
    if shared is None or not _tasks_can(schema, names) or not shared.many(LISTED):
        return touched_rows(read_layout(spark, path, schema), touched, names)
    folders = (touched.select(*[F.col(c).cast("string") for c in names])
               .repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, *names).rdd.map(lambda r: _folder_of(names, r)))
    files = folders.flatMap(lambda at: (os.path.join(at, f) for f in shared.files(at)))
    return _rows_by_tasks(spark, shared, files, schema, layout.partition_by)


def touched_partitions(batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The batch's distinct partition values with their row counts, kept in the shared folder."""
    pb = list(partition_by)
    shared_dir(batch.sparkSession)
    touched = batch.groupBy(*pb).agg(F.count("*").alias("_rows")).checkpoint(eager=True)
    unnamed = touched.where(" OR ".join(f"`{c}` IS NULL OR CAST(`{c}` AS STRING) = ''" for c in pb)).limit(1).collect()
    if unnamed:
        raise ValueError(f"a row's partition value is NULL or empty: {unnamed[0].asDict()}; nothing was written")
    return touched


def touched_rows(stored: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows of the touched partitions."""
    pb = list(partition_by)
    if touched.count() > PRUNED:
        return stored.join(touched.select(*pb), pb, "left_semi")
    rows = touched.select(*pb).collect()        # at most PRUNED
    prune = F.lit(True)
    for c in pb:
        prune = prune & F.col(c).isin(sorted({r[c] for r in rows}))
    return stored.where(prune).join(F.broadcast(touched.select(*pb)), pb, "left_semi")


def upsert(spark: SparkSession, incoming: DataFrame, path: str, layout: Layout,
           order: Sequence[str] = ("seq",), num_tasks: int | None = None) -> DataFrame:
    """Insert-or-replace ``incoming`` into the layout at ``path``; returns the table.

    The stored rows keep the incoming columns except the order columns.
    ``num_tasks`` is the number of write tasks (default: one per ``ROWS_PER_TASK``
    incoming rows, as many as the cluster has cores at least).
    """
    missing = [c for c in order if c not in incoming.columns]
    if missing:
        raise ValueError(f"order column(s) {missing} not in the batch: they decide which of a key's rows "
                         "is the last one")
    order = list(order)
    schema_cols = [c for c in incoming.columns if c not in order]
    batch = incoming.select(*schema_cols, *order, F.lit(1).alias("_batch"))
    touched = touched_partitions(batch, layout.partition_by)
    if num_tasks is None:
        rows = touched.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        num_tasks = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    schema = incoming.select(*schema_cols).schema
    if (left := _pending(spark, path)) is not None:
        finish_upsert(spark, left, path, layout, schema)
    exists = _table_exists(spark, path)
    shared = _Folder(spark, path).shared()
    by_tasks = shared is not None and _tasks_can(schema, layout.partition_by) and touched.count() > LISTED
    if exists:
        old = _stored_at(spark, path, schema, layout, touched)
        old = old.select(*schema_cols, *[F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in order],
                         F.lit(0).alias("_batch"))
        batch = batch.unionByName(old)
    merged = dedup_last(batch, layout.key, ["_batch", *order]).select(*schema_cols)
    if not exists and not by_tasks:
        # first load: nothing is read from the target, write it directly
        write_layout(merged, path, layout, num_tasks=num_tasks)
        return read_layout(spark, path, merged.schema)
    staging = posixpath.join(path.rstrip("/"), PENDING, uuid.uuid4().hex, NEW)
    if by_tasks:
        _write_by_tasks(merged, _Folder(spark, staging).shared(), layout, num_tasks)
    else:
        write_layout(merged, staging, layout, num_tasks=num_tasks)
    write_journal(spark, staging, path, layout)
    try:
        return finish_upsert(spark, staging, path, layout, merged.schema)
    except Exception as e:
        raise RuntimeError(f"the merged partitions are staged at {staging}; run finish_upsert(spark, "
                           f"{staging!r}, {path!r}, ...) to complete the upsert") from e


def _unit(fs: _Shared | _Folder, folder: str) -> tuple[str, bool]:
    """The folder to move, and whether the table has it: the partition folder, or the highest one above it that the table doesn't have."""
    unit = folder
    while (above := posixpath.dirname(unit)) and not fs.exists(above):
        unit = above
    return unit, fs.exists(unit)


def write_journal(spark: SparkSession, staging: str, path: str, layout: Layout) -> None:
    """List every folder to move: a partition folder, or the highest folder above it that the table doesn't have yet."""
    table = _Folder(spark, path)
    own = posixpath.relpath(posixpath.dirname(staging), path.rstrip("/"))
    if shared := table.shared():
        files = shared.shares(spark, own, NEW).flatMap(lambda at: ((os.path.join(at, f), n) for f, n in shared.files(own, NEW, at).items()))
        units = files.map(lambda f: (*_unit(shared, posixpath.dirname(f[0])), *f))
    else:
        found = table.data_files(own, NEW).withColumn("at", F.regexp_replace("file", "/?[^/]*$", "")).collect()
        of = {at: _unit(table, at) for at in {f.at for f in found}}
        units = [(*of[f.at], f.file, f.length) for f in found]
    name = F.ltrim(F.expr("substring(file, length(folder) + 1)"), F.lit("/"))
    moves = (spark.createDataFrame(units, "folder string, replaces boolean, file string, length bigint")
             .groupBy("folder").agg(F.bool_or("replaces").alias("replaces"),
                                    F.map_from_entries(F.collect_list(F.struct(name, "length"))).alias("files")))
    draft = f".{JOURNAL}-{uuid.uuid4().hex}"
    moves.write.json(posixpath.join(path.rstrip("/"), own, draft))
    table.rename((own, draft), (own, JOURNAL))      # whole or not there


def _state(fs: _Shared | _Folder, own: str, move: Row, here: dict[str, int]) -> str:
    """Where a folder's move stands, ``here`` being the files that its stage still has."""
    folder = move.folder
    if here or fs.exists(own, NEW, folder):
        return "lost" if here != move.files else "staged" if fs.exists(folder) else "aside"
    # a new folder is at its place, or an old one has gone aside and the new one taken its place
    return "moved" if fs.exists(folder) and (not move.replaces or fs.exists(own, OLD, folder)) else "lost"


def _forward(fs: _Shared | _Folder, own: str, move: Row, now: str, before: Callable[[str, str], None]) -> None:
    folder = move.folder
    if now == "staged":
        before(folder, now)
        fs.rename((folder,), (own, OLD, folder))
        now = "aside"
    if now == "aside":
        before(folder, now)
        fs.rename((own, NEW, folder), (folder,))


def _back(fs: _Shared | _Folder, own: str, move: Row) -> None:
    folder = move.folder
    if move.replaces:
        if fs.exists(own, OLD, folder):
            if fs.exists(folder):
                fs.rename((folder,), (own, NEW, folder))
            fs.rename((own, OLD, folder), (folder,))
    elif fs.exists(folder):
        fs.rename((folder,), (own, NEW, folder))


def _gone(fs: _Shared | _Folder, own: str, move: Row) -> bool:
    """Whether neither the table nor the folders set aside have what was there before."""
    return move.replaces and not fs.exists(move.folder) and not fs.exists(own, OLD, move.folder)


def _move_by_tasks(fs: _Shared, own: str, moves: DataFrame) -> tuple[list[str], list[str]]:
    """Move the journal's folders by Spark tasks; else the first lost folders, and those gone altogether.

    A task that runs again finds what it moved before as moved.
    """
    rdd = moves.repartition(TASKS_PER_CORE * moves.sparkSession.sparkContext.defaultParallelism).rdd

    def state(move: Row) -> str:
        return _state(fs, own, move, fs.files(own, NEW, move.folder))

    def some(test: Callable[[Row], bool]) -> list[str]:
        return rdd.mapPartitions(lambda part: islice((m.folder for m in part if test(m)), 5)).collect()[:5]

    lost = some(lambda m: state(m) == "lost")
    if not lost:
        rdd.foreach(lambda m: _forward(fs, own, m, state(m), lambda folder, now: None))
        return [], []
    gone = some(lambda m: _gone(fs, own, m))
    if not gone:
        rdd.foreach(lambda m: _back(fs, own, m))
    return lost, gone


def _move_here(fs: _Shared | _Folder, own: str, moves: list[Row], before: Callable[[str, str], None]) -> tuple[list[str], list[str]]:
    """The same from the driver, some folders at once."""
    if isinstance(fs, _Shared):
        staged = {m.folder: fs.files(own, NEW, m.folder) for m in moves}
    else:
        units, staged = {m.folder for m in moves}, {}
        for file, length in fs.files(own, NEW).items():
            unit = posixpath.dirname(file)
            while unit and unit not in units:
                unit = posixpath.dirname(unit)
            staged.setdefault(unit, {})[file[len(unit):].lstrip("/")] = length
    with ThreadPoolExecutor(MOVERS) as pool:
        states = list(pool.map(lambda m: _state(fs, own, m, staged.get(m.folder, {})), moves))
        lost = [m.folder for m, now in zip(moves, states) if now == "lost"]
        gone = [m.folder for m in moves if _gone(fs, own, m)] if lost else []
        if not lost:
            list(pool.map(lambda one: _forward(fs, own, *one, before), zip(moves, states)))
        elif not gone:
            list(pool.map(lambda m: _back(fs, own, m), moves))
    return lost, gone


def finish_upsert(spark: SparkSession, staging: str, path: str, layout: Layout, schema: T.StructType,
                  step: Callable[[str, str], None] | None = None) -> DataFrame:
    """Work off the journal of the upsert staged at ``staging``; also the recovery step, which may run again and again.

    Raises ``StageLost`` if staged folders are missing: the table is then the one before the upsert, if the old folders
    are still there. ``step`` is called with a folder and the state it is about to leave; all folders are then moved by the driver.
    """
    table = _Folder(spark, path)
    shared = table.shared()
    own = posixpath.relpath(posixpath.dirname(staging), path.rstrip("/"))
    if not table.exists(own, DONE):
        moves = spark.read.schema(MOVE).option("mode", "FAILFAST").json(posixpath.join(path.rstrip("/"), own, JOURNAL))
        first = moves.limit(HERE + 1).collect()
        by_tasks = shared is not None and step is None and len(first) > HERE
        if by_tasks:
            lost, gone = _move_by_tasks(shared, own, moves)
        else:
            lost, gone = _move_here(shared or table, own, first if len(first) <= HERE else moves.collect(), step or (lambda folder, state: None))
        if gone:
            raise StageLost(f"neither the old nor the new folder is whole: {gone[:5]}; nothing was removed from {staging}")
        if lost:
            _clear(table, own)
            table.remove(PENDING)
            spark.catalog.refreshByPath(path)
            raise StageLost(f"staged folders were missing or cut short ({lost[:5]}): the table is the one before the upsert; load the batch again")
        table.write("", own, DONE)
    # the old folders go only now that all new ones are in place
    _clear(table, own)
    table.remove(PENDING)
    spark.catalog.refreshByPath(path)
    return _stored(spark, path, schema, layout)


def station_rows(obs: DataFrame) -> DataFrame:
    """Observation rows in the station layout's column set (no valid_date)."""
    return obs.drop("valid_date") if "valid_date" in obs.columns else obs


def time_rows(obs: DataFrame) -> DataFrame:
    """Observation rows for the time layout: rows whose instant is real."""
    return obs.where(F.col("valid_date").isNotNull())


def upsert_station(spark: SparkSession, obs: DataFrame, path: str, order: Sequence[str] = ("seq",),
                   num_tasks: int | None = None) -> DataFrame:
    """Upsert into the "station over time" layout."""
    return upsert(spark, station_rows(obs), path, STATION_LAYOUT, order, num_tasks)


def upsert_time(spark: SparkSession, obs: DataFrame, path: str, order: Sequence[str] = ("seq",),
                num_tasks: int | None = None) -> DataFrame:
    """Upsert into the "all stations at one instant" layout."""
    return upsert(spark, time_rows(obs), path, TIME_LAYOUT, order, num_tasks)
