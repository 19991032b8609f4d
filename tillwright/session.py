"""Spark session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys of a small delivery are looked up by value; Parquet then tests each against its Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Streaming keyed state lives in RocksDB on the executors, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Shuffled bytes one task should hold, well below the memory of an executor core.
TASK_BYTES = 512 << 20


def shuffle_settings(data_bytes: int) -> dict[str, str]:
    """Shuffle partitions for a given volume; adaptive execution merges those that turn out small.

    A streaming query keeps the number it was first started with, so size it for its state.
    """
    return {"spark.sql.shuffle.partitions": str(max(200, -(-data_bytes // TASK_BYTES)))}


def build_session(app_name: str = "tillwright", master: str | None = None,
                  conf: dict[str, str] | None = None, data_bytes: int | None = None) -> SparkSession:
    """Session with this package's settings, sized for ``data_bytes``; ``conf`` may override all."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    sized = shuffle_settings(data_bytes) if data_bytes is not None else {}
    for key, value in {**SETTINGS, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A machine-local folder is used only when Spark itself runs inside this one process.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillwright-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Evaluate once and cut the lineage through the reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete what they shuffled as they end, not when the driver next collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
