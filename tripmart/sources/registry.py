"""Run registry: an append-only table of events, and its snapshots."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.planning import latest_events
from tripmart.schema import REGISTRY_EVENT
from tripmart.sources.files import Folder
from tripmart.sources.lake import append_rows

_TICK = timedelta(microseconds=1)
_lock = threading.Lock()
_last = datetime.min


def read_events(spark: SparkSession, path: str) -> DataFrame:
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], REGISTRY_EVENT)
    return spark.read.schema(REGISTRY_EVENT).parquet(path)


def _moment(newest: datetime | None) -> datetime:
    """Now, but after every moment given out here or already in the registry.

    A clock that stands or goes back would otherwise let an older event win.
    """
    global _last
    with _lock:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        _last = max(now, _last + _TICK, *([newest + _TICK] if newest else []))
        return _last


def record(
    spark: SparkSession,
    path: str,
    stage: str,
    outcomes: list[tuple[str, str, str, str | None]],
) -> None:
    """Append (dataset, period, status, detail) outcomes of one stage.

    Appending needs no lock: several threads and runs may record at once.
    """
    newest = read_events(spark, path).agg(F.max(F.col("at").cast("string"))).first()[0]
    at = _moment(datetime.fromisoformat(newest) if newest else None).isoformat(sep=" ")
    rows = [(d, p, stage, status, detail, at) for d, p, status, detail in outcomes]
    names = [f.name for f in REGISTRY_EVENT.fields]
    events = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    append_rows(events.withColumn("at", F.col("at").cast("timestamp")), path)


def compact_events(spark: SparkSession, path: str, keep_seconds: float = 3600) -> int:
    """Put the deciding events into one file and drop the others' files; returns how many.

    The snapshot is added first: with or without the files it stands for, the
    state is the same, so a stop in between and events recorded meanwhile do no
    harm. Files younger than ``keep_seconds`` stay for readers that have listed them.
    """
    folder = Folder(spark, path)
    before = dict(folder.changed_at("*.parquet"))
    if len(before) < 2:
        return 0
    paths = [f"{path.rstrip('/')}/{name}" for name in before]
    events = spark.read.schema(REGISTRY_EVENT).parquet(*paths)
    append_rows(latest_events(events), path)
    limit = (time.time() - keep_seconds) * 1000
    gone = [name for name, changed in before.items() if changed < limit]
    for name in gone:
        folder.delete(name)
    return len(gone)
