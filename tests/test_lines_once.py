"""What the queries over raw files and small files shuffle, write and sort."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.operators.align import SHAPES
from tripmart.plans import queries
from tripmart.schema import DATASETS, PARTITIONS, SILVER
from tripmart.sources import derived
from tripmart.sources.lake import silver_table
from tripmart.sources.versions import VersionedTable


@pytest.fixture
def line_writes(monkeypatch):
    """Paths written by jobs that read the order lines."""
    seen, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **more):
        if any(f.endswith("lineitem.parquet") for f in self._df.inputFiles()):
            seen.append(path)
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_history_is_cut_by_its_size(spark, monkeypatch):
    monkeypatch.setattr(queries, "TASK_ROWS", 100)
    trips = queries._history_trips(spark, SMALL).cache()
    rows = derived.table(spark, SMALL, "lineitem").count()
    cut = queries._scattered(trips, rows)
    dealt = cut.withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("task").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert tasks[0] <= 400 and tasks[1] > 16
    met = dealt.groupBy(*PARTITIONS).agg(F.count_distinct("task").alias("n")).agg(F.min("n"), F.max("n")).first()
    assert 1 <= met[0] and 1 < met[1] <= 17
    assert _rows(cut) == _rows(trips)
    trips.unpersist()


def test_compaction_does_not_shuffle_rows_to_the_file_list(spark, folder, monkeypatch):
    table = silver_table(spark, folder)
    month = queries._history_trips(spark, SMALL).where("year = 1997 and month < 4")
    table.publish(month.repartition(4))
    plans, stage = [], VersionedTable.stage
    monkeypatch.setattr(
        VersionedTable, "stage", lambda self, f: (plans.append(f._jdf.queryExecution().toString()), stage(self, f))[1]
    )
    before = _rows(table.read(SILVER))
    assert set(table.compact_files(SILVER).values()) == {1}
    assert "SortMergeJoin" not in plans[0] and "BroadcastHashJoin" in plans[0]
    assert _rows(table.read(SILVER)) == before


def test_delivery_joins_the_lines_once(spark, folder, line_writes):
    months = [f"1998-{m:02d}" for m in range(1, 4)]
    queries._deliver(spark, SMALL, folder, months)
    assert len(line_writes) == len(DATASETS)
    for dataset in DATASETS:
        raw = derived.raw_lines(spark, SMALL, dataset)
        pickup = F.col(SHAPES[dataset].raw_name("pickup_datetime"))
        for i, month in enumerate(months):
            got = spark.read.parquet(f"{folder}/{queries.FILE_PREFIX[dataset]}_{month}.parquet")
            assert got.dtypes == raw.dtypes
            assert _rows(got) == _rows(raw.filter(F.month(pickup) % 3 == i))


def test_delivery_of_a_month_without_lines(spark, folder):
    # No month leaves the rest 0 by 13.
    months = [f"1997-{m:02d}" for m in range(1, 14)]
    queries._deliver(spark, SMALL, folder, months)
    empty = spark.read.parquet(f"{folder}/{queries.FILE_PREFIX['green']}_1997-01.parquet")
    assert empty.count() == 0 and empty.dtypes == derived.raw_lines(spark, SMALL, "green").dtypes


def test_lines_meet_orders_that_know_their_customer(spark):
    lines = derived.raw_lines(spark, SMALL, "yellow")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "Join" in line and "c_custkey" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = []
    for line in lines[at + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert "o_custkey" in "".join(below) and "l_orderkey" not in "".join(below)


def test_schema_drift_joins_the_lines_once(spark, line_writes):
    queries.raw_schema_drift(spark, SMALL).collect()
    assert len(line_writes) == len(DATASETS)
