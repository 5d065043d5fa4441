"""Session settings every job of this package relies on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Result-relevant: wall-clock arithmetic and the period bounds are in UTC.
_SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
}

# Plan-relevant: let AQE size shuffle partitions by bytes (they become the
# output files of the silver write) and split hot join and rebalance keys.
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Shuffle bytes are wider than Parquet bytes, so 256 MB of shuffle data gives
# files of roughly 128 MB.
FILE_SIZING = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def prepare(spark: SparkSession, more: dict[str, str] | None = None) -> SparkSession:
    """Apply the settings to a session the caller already owns."""
    for key, value in {**_SEMANTICS, **_ADAPTIVE, **(more or {})}.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(job_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Initial number of shuffle partitions for the largest job.

    AQE only ever merges partitions, so the start has to be fine enough for
    the largest shuffle; small ones are merged to the advisory size.
    """
    return min(max(job_bytes // partition_bytes, 200), 100_000)


def cluster_session(
    app_name: str = "tripmart", largest_job_bytes: int = 2 << 40, **conf: str
) -> SparkSession:
    """Session for a real deployment; extra settings override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        **_SEMANTICS,
        **_ADAPTIVE,
        **FILE_SIZING,
        "spark.scheduler.mode": "FAIR",
        "spark.sql.shuffle.partitions": str(shuffle_partitions(largest_job_bytes)),
        "spark.sql.files.maxPartitionBytes": "256m",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_parallel(spark: SparkSession, task: Callable, items: Iterable, workers: int) -> list:
    """Submit independent Spark jobs from driver threads; results keep the order."""
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    On a cluster an unset folder is an error: a machine-local path would not
    be visible to the other executors. Only local mode falls back to /tmp.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = "/tmp/tripmart"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
