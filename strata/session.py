"""Session helpers: shared checkpoint folder and a local builder for tests/bench.

Operators never build or reconfigure a session; they take the caller's.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import warnings
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without the setting gets a private scratch folder; on a cluster an unset folder is an error, because a
    machine-local path would not survive the loss of that machine.  A ``file:``
    folder on a cluster must be a mount that all machines share; as Spark cannot
    tell, it is accepted with a warning.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # Spark appends a per-application uuid folder; use its parent as the root
        return current.rstrip("/").rsplit("/", 1)[0] if "/" in current else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a shared folder "
                "(HDFS/S3/ABFS) before running strata jobs on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    elif not _is_local(spark) and configured.startswith(("file:", "/")):
        warnings.warn(f"spark.checkpoint.dir is {configured}: every machine must have this folder mounted", stacklevel=2)
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    app = spark.sparkContext.applicationId
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],))
    return os.path.join(root, "strata-scratch", app, leaf)


#: has Spark delete the shuffle files of a query when the query ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings with ``values``, for what is run meanwhile."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go with the write, not at some later garbage collection."""
    with settings(spark, {SHUFFLE_CLEANUP: "true"}):
        yield


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def local_session(cores: int | str = "*", app: str = "strata", shuffle_partitions: int = 8,
                  event_log_dir: str | None = None) -> SparkSession:
    """Builder used by tests and bench.py only (never by operators)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
