"""Session helpers: a local session for tests and benches, and the shared folder.

Library functions never build their own session; they take the caller's.
The shared folder is the one the cluster names in ``spark.checkpoint.dir``.
Only a local session (tests, benches) may fall back to a fresh temporary
folder, because a machine-local folder is not visible to other executors.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "obsgrid") -> SparkSession:
    """Session for tests and benches: UTC, ANSI, AQE on, UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and staged writes.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session gets a temporary folder of
    its own when none is set.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):      # one JVM; a local cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder for the cluster")
    own = tempfile.mkdtemp(prefix="obsgrid-ckpt-")
    sc.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder, in this application's own part of it."""
    return f"{shared_dir(spark)}/obsgrid/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote with ``scratch_path``; frames that read it end with it.

    Checkpoints go with their frames where ``spark.cleaner.referenceTracking.cleanCheckpoints``
    is set, as in ``local_session``.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/obsgrid/{spark.sparkContext.applicationId}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
