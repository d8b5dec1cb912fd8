"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from granary.sources import files

_held: ContextVar[list[str] | None] = ContextVar("scratch paths of a load", default=None)

# Runtime settings the jobs count on. All can be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A value that does not fit its column stops the load instead of turning NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One product, territory or order may hold a third of the rows: split its
    # join partition even where that costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "granary", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (RUNTIME_SETTINGS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_settings(executors: int, cores_per_executor: int) -> dict[str, str]:
    """Shuffle sizing for a large cluster.

    Start from many small shuffle partitions and let adaptive execution merge
    them to 256 MB, so one setting serves both a five-row lookup and a fact of
    tens of terabytes.
    """
    slots = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(max(200, slots * 4)),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(200, slots * 10)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, reachable by all executors.

    The cluster names it in ``spark.checkpoint.dir``. A session without that
    setting uses a folder in its warehouse, which executors share as well.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/granary/{label}-{uuid.uuid4().hex}"
    held = _held.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch paths made inside, once their last reader is done."""
    held: list[str] = []
    token = _held.set(held)
    try:
        yield
    finally:
        _held.reset(token)
        for path in held:
            files.delete(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query as it ends, not when the driver happens to collect its garbage."""
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


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back, so that its files' size decides on joins."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
