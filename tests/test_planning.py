import pytest
from pyspark.sql import functions as F

from tests.conftest import text_frame
from tripmart.functions.periods import (
    landing_folder,
    period_from_parts,
    period_start,
    publishable_until,
    source_file,
)
from tripmart.operators.planning import (
    backlog,
    last_done,
    next_periods,
    not_landed,
    registry_state,
)
from tripmart.schema import REGISTRY_EVENT


@pytest.fixture
def state(spark):
    def make(*events):
        names = ("dataset", "period", "stage", "status", "detail", "at")
        rows = [dict(zip(names, e)) for e in events]
        return registry_state(text_frame(spark, rows, REGISTRY_EVENT))

    return make


@pytest.fixture
def datasets(spark):
    return spark.createDataFrame([("yellow",), ("green",)], "dataset string")


def on(text):
    return F.lit(text).cast("date")


DONE = ("yellow", "2024-12", "silver", "DONE", None, "2025-03-02 00:00:00")


def test_landing_resets_silver(state):
    landed = ("yellow", "2024-12", "bronze", "DONE", "ingested", "2025-03-01 00:00:00")
    again = ("yellow", "2024-12", "bronze", "DONE", "skipped", "2025-03-03 00:00:00")
    row = state(landed, DONE).first()
    assert (row.silver_status, row.bronze_detail) == ("DONE", "ingested")
    row = state(landed, DONE, again).first()
    assert (row.silver_status, row.bronze_detail) == ("PENDING", "skipped")
    assert row.silver_done_at is None and str(row.bronze_done_at) == "2025-03-03 00:00:00"


def test_failed_landing_has_no_detail(state):
    good = ("green", "2024-01", "bronze", "DONE", "ingested", "2024-03-01 00:00:00")
    bad = ("green", "2024-01", "bronze", "FAILED", None, "2024-03-02 00:00:00")
    row = state(good, bad).first()
    assert (row.bronze_status, row.bronze_detail, row.silver_status) == ("FAILED", None, "PENDING")


def test_next_period_carries_the_year_and_starts_at_the_start(state, datasets):
    rows = next_periods(datasets, state(DONE), on("2025-06-30"), "2024-01", 2)
    got = {r.dataset: (r.period, r.year, r.month, r.hasWork) for r in rows.collect()}
    assert got == {"yellow": ("2025-01", 2025, 1, True), "green": ("2024-01", 2024, 1, True)}


@pytest.mark.parametrize("as_of, work", [("2025-02-28", False), ("2025-03-01", True)])
def test_publication_lag(state, datasets, as_of, work):
    row = next_periods(datasets, state(DONE), on(as_of)).filter("dataset = 'yellow'").first()
    assert row.hasWork is work
    assert (row.period, row.year, row.month) == (("2025-01", 2025, 1) if work else (None,) * 3)


def test_failed_month_comes_up_again(state, datasets):
    failed = ("yellow", "2025-01", "silver", "FAILED", None, "2025-04-01 00:00:00")
    current = state(DONE, failed)
    assert last_done(current).first().last_done == "2024-12"
    row = next_periods(datasets, current, on("2025-09-01")).filter("dataset = 'yellow'").first()
    assert row.period == "2025-01"


def test_backlog_fills_gaps_of_every_dataset(state, datasets):
    got = backlog(datasets, state(DONE), on("2025-03-15"), "2024-11", 2)
    assert sorted((r.dataset, r.period) for r in got.collect()) == [
        ("green", "2024-11"),
        ("green", "2024-12"),
        ("green", "2025-01"),
        ("yellow", "2024-11"),
        ("yellow", "2025-01"),
    ]
    assert backlog(datasets, state(DONE), on("2024-01-15"), "2024-11", 2).count() == 0


def test_not_landed(spark):
    plan = spark.createDataFrame([("yellow", "2024-01"), ("yellow", "2024-02")], "dataset string, period string")
    left = not_landed(plan, plan.filter("period = '2024-01'"))
    assert [tuple(r) for r in left.collect()] == [("yellow", "2024-02")]


def test_upper_bound_crosses_the_year(spark):
    row = spark.range(1).select(publishable_until(on("2025-01-31"), 2).alias("d")).first()
    assert str(row.d) == "2024-11-01"


def test_paths_and_period_parts(spark):
    frame = spark.createDataFrame(
        [("fhvhv", "2024-07", 1, 1), ("green", None, 2023, 4), ("yellow", "", 2023, 12)],
        "dataset string, period string, year long, month long",
    )
    period = period_from_parts(F.col("period"), F.col("year"), F.col("month"))
    day = period_start(period)
    rows = frame.select(
        period, source_file(F.col("dataset"), day, "/in%d/"), landing_folder(F.col("dataset"), day)
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("2024-07", "/in%d/fhvhv_tripdata_2024-07.parquet", "fhvhv/year=2024/month=07"),
        ("2023-04", "/in%d/green_tripdata_2023-04.parquet", "green/year=2023/month=04"),
        ("2023-12", "/in%d/yellow_tripdata_2023-12.parquet", "yellow/year=2023/month=12"),
    ]


def test_unknown_dataset_in_a_plan_fails(spark):
    frame = spark.createDataFrame([("purple",)], "dataset string")
    with pytest.raises(Exception, match="unknown dataset: purple"):
        frame.select(source_file(F.col("dataset"), on("2024-01-01"), "/x")).collect()
