"""Helpers of the training-data operators: written steps, slices of batches, components."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import shared_folder

#: Bytes of text that one vectorised step works on; a longer text is one step of its own.
STEP_BYTES = 2 << 20
#: Bytes of a batch that Spark hands to a task's Python process; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of ids or numbers (some 16 bytes each) that may be sent to all tasks.
BROADCAST_ROWS = 1 << 18


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again.

    Cuts the lineage: a lost executor costs the running stage, not the steps
    before it. The schema is passed on, so an empty frame stays readable.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_side(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Narrow rows marked for broadcast if there are few enough, else left to a shuffle join."""
    return F.broadcast(rows) if rows.count() <= most else rows


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session by BATCH_BYTES unless they are smaller already.

    Batches are counted in rows otherwise, so that long texts fill the memory of
    executors on both sides of the pipe. No result depends on where batches end.
    """
    size = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    # Tasks import this package from where the driver did, also if it is not installed.
    own = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if own not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([own, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Only the GNU C library has this function.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """What an operator keeps in a worker process between its tasks.

    One thing at a time: a process that goes on to another operator, or to
    another model, lets go of what it held before.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Tasks that keep nothing drop what earlier ones have left in their process."""
    _held.clear()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, which Arrow and the C library keep otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def byte_view(column: pa.Array):
    """Offsets and bytes of a string column as numpy views; null counts as empty."""
    import numpy as np

    column = column.fill_null("") if column.null_count else column
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.large_string())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at.astype(np.int64), raw


def steps(at, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row stands alone."""
    first, rows = 0, len(at) - 1
    while first < rows:
        end = first + 1
        while end < rows and at[end + 1] - at[first] <= most:
            end += 1
        yield first, end
        first = end
    give_back()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over the edges (a, b).

    Alternating large and small stars: every round is two groupings and two
    joins of the edge list, and rounds grow with the logarithm of a path.
    """
    pairs = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        purpose,
    )
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e")
        )
        pairs = stored(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), purpose)
        # Sums of hashes do not overflow into one another: both have to stand still.
        state = pairs.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))
        ).first()
        if tuple(state) == before:
            return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        before = tuple(state)
