import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.operators import marts
from tripmart.operators.clean import Span
from tripmart.operators.quality import Compare, QualityGateError, RowCount
from tripmart.plans.queries import PEPPER, RULES
from tripmart.plans.silver import build_silver
from tripmart.schema import SILVER, UNIFIED
from tripmart.session import in_parallel, shared_folder, shuffle_partitions
from tripmart.sources import derived
from tripmart.sources.catalog import register_silver, register_table, replace_unified_view
from tripmart.sources.lake import (
    append_rows,
    materialise,
    overwrite_partitions,
    publish_view,
    read_silver,
    unified_by_branch,
    unified_trips,
    with_partitions,
    write_gated,
)
from tripmart.sources.zones import checked, read_zones

MAY = Span.month(date(1998, 5, 1))
JUNE = Span.month(date(1998, 6, 1))


def build(spark, target, span, dataset="fhvhv", **more):
    raw = [derived.raw_lines(spark, SMALL, dataset)]
    return build_silver(
        raw, dataset, span, target, PEPPER, derived.LINE_BOUNDS, more.pop("rules", RULES), **more
    )


def rows(frame):
    return sorted(map(str, frame.collect()))


def files(path):
    return sorted(
        os.path.join(base, f)
        for base, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    )


def test_running_a_month_twice_gives_the_same_silver(spark, folder):
    report = build(spark, folder, MAY)
    once = rows(read_silver(spark, folder))
    assert len(once) == 17 and report.filter("outcome = 'Passed'").count() == 9
    build(spark, folder, MAY)
    assert rows(read_silver(spark, folder)) == once
    assert os.path.isdir(f"{folder}/service_type=fhvhv/year=1998/month=5")


def test_only_the_partitions_of_the_run_are_replaced(spark, folder):
    build(spark, folder, MAY)
    build(spark, folder, JUNE)
    june = files(f"{folder}/service_type=fhvhv/year=1998/month=6")
    may = files(f"{folder}/service_type=fhvhv/year=1998/month=5")
    build(spark, folder, MAY)
    assert files(f"{folder}/service_type=fhvhv/year=1998/month=6") == june
    assert files(f"{folder}/service_type=fhvhv/year=1998/month=5") != may


def test_failed_gate_publishes_nothing(spark, folder):
    build(spark, folder, MAY)
    before = files(folder)
    with pytest.raises(QualityGateError):
        build(spark, folder, MAY, rules=(Compare("trip_distance", ">", 10),))
    assert files(folder) == before


def test_empty_month_fails_and_keeps_the_old_one(spark, folder):
    build(spark, folder, MAY)
    before = files(folder)
    trips = with_partitions(
        derived.line_trips(spark, SMALL).filter("trip_distance < 0")
    )
    with pytest.raises(QualityGateError) as error:
        write_gated(trips, folder, (RowCount(0),))
    assert error.value.failed == ["RowCount > 0"]
    with pytest.raises(QualityGateError):
        build(spark, folder, Span.month(date(2050, 1, 1)))
    assert files(folder) == before


def test_observed_measures_equal_a_separate_evaluation(spark, folder):
    report = build(spark, folder, None)
    from tripmart.operators.quality import evaluate

    assert rows(report) == rows(evaluate(read_silver(spark, folder), RULES))


def test_history_in_one_job_equals_single_months(spark, folder):
    build(spark, f"{folder}/all", Span(date(1998, 4, 1), date(1998, 7, 1)))
    for month in (4, 5, 6):
        build(spark, f"{folder}/each", Span.month(date(1998, month, 1)))
    assert rows(read_silver(spark, f"{folder}/all")) == rows(read_silver(spark, f"{folder}/each"))


def test_file_count_can_be_forced(spark, folder):
    build(spark, folder, MAY, files=3)
    assert len(files(f"{folder}/service_type=fhvhv")) == 3


def test_dynamic_overwrite_with_nothing_changes_nothing(spark, folder):
    month = spark.createDataFrame([(1, 1), (2, 2)], "x int, month int")
    overwrite_partitions(month, folder, "month")
    overwrite_partitions(month.filter("x < 0"), folder, "month")
    overwrite_partitions(month.filter("month = 2").withColumn("x", F.lit(9)), folder, "month")
    assert rows(spark.read.parquet(folder)) == ["Row(x=1, month=1)", "Row(x=9, month=2)"]


def test_views_agree_and_minimise_columns(spark, folder):
    for dataset in ("yellow", "green", "fhvhv"):
        build(spark, folder, None, dataset)
    one, branches = unified_trips(spark, folder), unified_by_branch(spark, folder)
    assert one.columns == branches.columns == list(UNIFIED)
    assert rows(one) == rows(branches)
    plan = one.filter("service_type = 'green' AND month = 5")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(service_type" in plan.toString()
    branch = branches.filter("service_type = 'green'")._jdf.queryExecution().executedPlan()
    assert branch.toString().count("FileScan") == 1

    publish_view(one, "trips_view")
    assert spark.sql("SELECT count(*) FROM trips_view").first()[0] == one.count()

    register_silver(spark, folder, "t_silver")
    assert rows(spark.table("t_silver").select(*UNIFIED)) == rows(one)
    replace_unified_view(spark, "t_silver", "t_unified")
    replace_unified_view(spark, "t_silver", "t_unified")
    assert rows(spark.table("t_unified")) == rows(one)
    again = register_silver(spark, folder, "t_silver")
    assert set(again.columns) == set(SILVER.names) and files(folder)


def test_mart_is_replaced_as_a_whole(spark, folder):
    zones = checked(derived.zones(spark, SMALL))
    trips = derived.line_trips(spark, SMALL)
    target = f"{folder}/gold/od_matrix"
    materialise(marts.od_matrix(trips, zones, k=1), target)
    old = files(target)
    materialise(marts.od_matrix(trips, zones), target)
    assert not set(old) & set(files(target))
    assert all(f.endswith(".snappy.parquet") for f in files(target))
    assert os.listdir(f"{folder}/gold") == ["od_matrix"]
    assert register_table(spark, "gold_od", target).count() == 98


def test_zone_csv_of_any_quoting_and_order(spark, folder):
    with open(f"{folder}/zones.csv", "w") as out:
        out.write(
            '"LocationID","Borough","Zone","service_zone"\n'
            '132,"Queens","JFK Airport","Airports"\n'
            '138,Queens,LaGuardia Airport,Airports\n'
            '140,"Manhattan","""Lenox Hill East""","Yellow, Zone"\n'
            'x,,,\n'
        )
    got = [tuple(r) for r in read_zones(spark, f"{folder}/zones.csv").collect()]
    assert got == [
        (132, "Queens", "JFK Airport"),
        (138, "Queens", "LaGuardia Airport"),
        (140, "Manhattan", "Lenox Hill East"),
        (None, None, None),
    ]


def test_parallel_appends_lose_nothing(spark, folder):
    target = f"{folder}/log"

    def add(i):
        append_rows(spark.createDataFrame([(i,)], "i int"), target)

    in_parallel(spark, add, range(12), 6)
    assert sorted(r.i for r in spark.read.parquet(target).collect()) == list(range(12))


class Session:
    """Just what shared_folder asks a session for."""

    def __init__(self, master, setting):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master = master


def test_shared_folder_follows_the_session():
    assert shared_folder(Session("yarn", "hdfs:///x/"), "a").startswith("hdfs:///x/a-")
    assert shared_folder(Session("local[2]", None), "a").startswith("/tmp/")
    with pytest.raises(ValueError):
        shared_folder(Session("yarn", None), "a")


def test_shuffle_partitions_grow_with_the_job():
    assert shuffle_partitions(1 << 30) == 200
    assert shuffle_partitions(2 << 40) == 16_384
    assert shuffle_partitions(1 << 60) == 100_000
