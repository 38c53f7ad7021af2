"""Session helpers: a local session for tests/bench, and shared scratch space.

On a cluster the session is built by the platform; library code only *reads*
settings from it.  Scratch output (landed fixtures, staging tables, stream
checkpoints) goes under the shared folder named by ``spark.checkpoint.dir``;
only when that is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lakestrata") -> SparkSession:
    """A ``local[cpus]`` session configured like the production job.

    AQE re-plans joins and coalesces shuffle partitions at runtime; the UI is
    off (no server); the session zone is UTC so timestamp text is unambiguous.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (decision D7: UTC everywhere)."""
    # no default argument: get(key, default) returns the default whenever the
    # key was not set explicitly, hiding the host zone the session really uses
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only a ``local`` master with neither set -- tests -- gets
    a private folder; on a cluster that is an error, since executors could
    not see it.
    """
    global _LOCAL_SCRATCH
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if current is None:
            # set at runtime only: make DataFrame.checkpoint() use it too
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that "
                           "the driver and all executors share")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
    context.setCheckpointDir(_LOCAL_SCRATCH)
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/lakestrata/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path whose folder is removed at the end, also after an error."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Every execution in here removes its shuffle files when it ends; else they stay until the driver
    collects its garbage, which a large heap puts off."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can touch a local path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
