"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.session import scratch_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(base: str) -> str:
    """A column name that no input table has."""
    return f"__{base}_{uuid.uuid4().hex[:12]}"


def keep_in_shared(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (NULL id: fold of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def broadcast_if_small(df: DataFrame, rows: int, row_limit: int) -> DataFrame:
    """Broadcast a side only when its counted ``rows`` stay within ``row_limit``;
    beyond it the join is left to a shuffle."""
    return F.broadcast(df) if rows <= row_limit else df


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    The same as setting ``spark.executorEnv.PYTHONPATH`` for a session that
    runs already; on a cluster whose nodes don't share that folder, install
    the package there or submit it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])
    # workers live on after a query: give what Arrow batches held back to the system
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator: what is built on them reads them, and the optimizer can't work them out again in place."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
