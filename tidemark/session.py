"""Spark session helpers.

The library never mutates a caller's session except through
``ensure_checkpoint_dir`` (only when the cluster did not name one).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidemark",
                  driver_memory: str | None = None) -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the cluster's own session.

    In local mode the driver JVM runs every task, so its heap is the engine's
    memory: it is sized explicitly (default 1 GB would be far too small).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory",
                                     driver_memory or os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting it on the SparkContext if need be.

    ``spark.checkpoint.dir`` of the session comes first, then a folder that the
    application has set through ``SparkContext.setCheckpointDir``. Only a local
    master may go without: it gets a scratch folder, which every task can see.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or _CHOSEN.get(sc.applicationId) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    _CHOSEN[sc.applicationId] = base
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


#: The chosen folder by application, so that its name does not depend on who asks first.
_CHOSEN: dict[str, str] = {}


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: for what several branches of a plan read."""
    path = shared_path(df.sparkSession, *parts[:-1], f"{parts[-1]}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
