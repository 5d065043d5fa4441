"""Gap-aware planning, the compacted registry, quality against history, files by size."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import text_frame
from tripmart.operators.planning import next_missing, registry_state
from tripmart.operators.quality import against_history, rejects_by_month
from tripmart.schema import REGISTRY_EVENT
from tripmart.session import in_parallel
from tripmart.sources import registry
from tripmart.sources.registry import compact_events, read_events, record
from tripmart.sources.files import Folder
from tripmart.sources.versions import VersionedTable


def events(spark, *rows):
    names = [f.name for f in REGISTRY_EVENT.fields]
    return text_frame(spark, [dict(zip(names, r)) for r in rows], REGISTRY_EVENT)


def done(dataset, period, status="DONE"):
    return (dataset, period, "silver", status, None, "2025-01-01 00:00:00")


@pytest.fixture
def datasets(spark):
    return spark.createDataFrame([("yellow",), ("green",)], "dataset string")


def plan(spark, datasets, state, as_of="2024-08-20"):
    found = next_missing(datasets, registry_state(state), F.lit(as_of).cast("date"))
    return {r["dataset"]: (r["period"], r["year"], r["month"], r["hasWork"]) for r in found.collect()}


def test_a_month_built_by_name_leaves_no_gap(spark, datasets):
    state = events(spark, done("yellow", "2024-03"))
    assert plan(spark, datasets, state) == {"yellow": ("2024-01", 2024, 1, True), "green": ("2024-01", 2024, 1, True)}
    state = events(spark, *[done("yellow", f"2024-0{m}") for m in (1, 3, 4)], done("yellow", "2024-02", "FAILED"))
    assert plan(spark, datasets, state)["yellow"] == ("2024-02", 2024, 2, True)
    state = events(spark, *[done("yellow", f"2024-0{m}") for m in range(1, 7)])
    assert plan(spark, datasets, state)["yellow"] == (None, None, None, False)


def test_equal_moments_have_one_answer(spark):
    a, b = done("yellow", "2024-01", "FAILED"), done("yellow", "2024-01")
    for rows in ((a, b), (b, a), (a, b, a)):
        frame = events(spark, *rows).repartition(3)
        assert registry_state(frame).first()["silver_status"] == "FAILED"


def test_moments_grow_even_if_the_clock_does_not(spark, folder, monkeypatch):
    path = f"{folder}/registry"

    class Clock(datetime):
        @classmethod
        def now(cls, zone=None):
            return cls(2020, 1, 1, tzinfo=zone)

    monkeypatch.setattr(registry, "datetime", Clock)
    for status in ("FAILED", "DONE", "FAILED", "DONE"):
        record(spark, path, "silver", [("yellow", "2024-01", status, None)])
    assert registry_state(read_events(spark, path)).first()["silver_status"] == "DONE"
    moments = [r["at"] for r in read_events(spark, path).orderBy("at").collect()]
    assert len(set(moments)) == 4


def test_compaction_keeps_the_state_and_later_events(spark, folder):
    path = f"{folder}/registry"

    def add(i):
        record(spark, path, "bronze" if i % 2 else "silver", [("yellow", f"2024-0{1 + i % 3}", "DONE" if i % 4 else "FAILED", str(i))])

    in_parallel(spark, add, range(10), 4)
    before = sorted(map(str, registry_state(read_events(spark, path)).collect()))
    assert compact_events(spark, path) == 0  # young files stay beside the snapshot
    assert sorted(map(str, registry_state(read_events(spark, path)).collect())) == before
    assert compact_events(spark, path, keep_seconds=-1) > 0
    assert len(Folder(spark, path).glob("*.parquet")) == 1
    assert sorted(map(str, registry_state(read_events(spark, path)).collect())) == before
    record(spark, path, "silver", [("yellow", "2024-01", "DONE", None)])
    assert registry_state(read_events(spark, path)).where("period = '2024-01'").first()["silver_status"] == "DONE"


def test_a_drop_against_the_months_before_fails(spark):
    counts = [100, 110, 90, 40, 105, 100, 0]
    rows = [("a", f"2024-0{i + 1}", n) for i, n in enumerate(counts)] + [("b", "2024-01", 5)]
    frame = spark.createDataFrame(rows, "k string, period string, n bigint")
    got = against_history(frame, ("k",), "period", "n", least=0.5, months=3).orderBy("k", "period").collect()
    assert [r["outcome"] for r in got] == ["Passed"] * 3 + ["Failed"] + ["Passed"] * 2 + ["Failed", "Passed"]
    assert got[3]["usual"] == 100 and got[0]["usual"] is None


def test_rejects_by_month_count_every_row_once_per_predicate(spark):
    frame = spark.createDataFrame(
        [("2024-01-05", 1), ("2024-01-06", -1), ("2024-02-01", None), (None, 3)], "d string, x int"
    ).select(F.to_timestamp("d").alias("pickup_datetime"), "x")
    rules = {"there": F.col("pickup_datetime").isNotNull(), "positive": F.col("x") > 0}
    got = {(r["year"], r["month"], r["predicate"]): r["nb_rows"] for r in rejects_by_month(frame, rules).collect()}
    assert got[2024, 1, "rows_read"] == 2 and got[2024, 1, "rows_kept"] == 1 and got[2024, 1, "positive"] == 1
    assert got[2024, 2, "positive"] == 1 and got[None, None, "there"] == 1 and got[None, None, "rows_kept"] == 0


def test_small_files_are_put_together_by_size(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", ("part",))
    frame = spark.range(4000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 2).cast("int").alias("part"))
    table.publish(frame.repartition(8))
    sizes = table.files()
    assert all(len(s) == 8 for s in sizes.values())
    table.publish(frame.where("part = 1").coalesce(1))
    kept = table.current()["part=1"]
    need = -(-sum(sizes["part=0"]) // 60_000)
    assert table.compact_files(frame.schema, file_bytes=60_000) == {"part=0": need}
    assert len(table.files()["part=0"]) == need > 1 and table.current()["part=1"] == kept
    assert sorted(r["id"] for r in table.read(frame.schema).collect()) == list(range(4000))
    assert table.compact_files(frame.schema, file_bytes=1 << 30) == {"part=0": 1}
    assert table.compact_files(frame.schema, file_bytes=1 << 30) == {}
