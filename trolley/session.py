"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trolley.settings import Settings

JOB_SCRATCH = "trolley.scratch"
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "+00:00", "GMT", "UCT")
BLOOM_FILTER = "spark.sql.optimizer.runtime.bloomFilter"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STATE_STORE = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    settings: Settings | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the settings every job here relies on.

    Times are UTC, AQE sizes and splits the shuffle partitions, and streaming
    state lives in RocksDB instead of on the executor heap. ``conf`` holds
    further Spark options.
    """
    settings = settings or Settings.from_env()
    builder = (
        SparkSession.builder.appName(settings.app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(STATE_STORE, ROCKSDB_STATE_STORE)
        # Joins with a filtered list of ids drop rows at the scan from these sizes on.
        .config(f"{BLOOM_FILTER}.enabled", "true")
        .config(f"{BLOOM_FILTER}.applicationSideScanSizeThreshold", "1GB")
        .config(f"{BLOOM_FILTER}.creationSideThreshold", "256MB")
    )
    if settings.master:
        builder = builder.master(settings.master)
    if settings.batch_partitions:
        # Only the upper bound for AQE: streams keep spark.sql.shuffle.partitions,
        # which fixes the number of their state stores.
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(settings.batch_partitions),
        )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> SparkSession:
    """Dates and windows are cut in UTC; a session in another zone would move them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone has to be UTC, not {zone}")
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the cluster names for checkpoints and intermediate tables."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder of the running job, or else the shared folder."""
    folder = spark.conf.get(JOB_SCRATCH, None) or shared_folder(spark)
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return f"{folder.rstrip('/')}/trolley/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name in its store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any store; nothing if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder for all that is staged in the block.

    It is removed after the block and kept if that failed.
    """
    path = scratch_path(spark, "job")
    before = spark.conf.get(JOB_SCRATCH, None)
    spark.conf.set(JOB_SCRATCH, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(JOB_SCRATCH)
        else:
            spark.conf.set(JOB_SCRATCH, before)
    remove(spark, path)


@contextmanager
def passing_scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path that is removed after the block, unless that failed."""
    path = scratch_path(spark, name)
    yield path
    remove(spark, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back, its schema passed on."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several results need the same large intermediate rows: they are
    computed once, survive the loss of executors, and are read with pruned
    columns. The folder stays, as the caller may pass the result on.
    """
    return written(df, scratch_path(df.sparkSession, name))
