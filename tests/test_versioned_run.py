"""Whole runs over a lake of versions: the path users take."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.test_run import lake as plain_lake  # noqa: F401
from tests.test_run import state
from tripmart.operators.quality import Compare, RowCount
from tripmart.plans.run import RunFailed, read_mart, run
from tripmart.plans.refresh import refresh_versioned_parts
from tripmart.schema import UNIFIED
from tripmart.sources.lake import read_silver, silver_table
from tripmart.sources.versions import ConcurrentCommit, VersionedTable

AS_OF = date(1998, 8, 20)


@pytest.fixture
def lake(plain_lake):  # noqa: F811
    return replace(plain_lake, versioned=True, catalog="versioned_run")


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_versioned_run_equals_the_plain_one(spark, lake):
    plain = replace(lake, root=lake.root + "-plain", versioned=False, catalog=None)
    assert run(spark, lake, AS_OF, whole_backlog=True) == run(spark, plain, AS_OF, whole_backlog=True)
    columns = UNIFIED
    one, other = (read_silver(spark, x.table("silver/trips")).select(*columns) for x in (lake, plain))
    assert rows(one) == rows(other) and one.count() > 0
    for name in lake.marts:
        assert rows(read_mart(spark, lake, name)) == rows(read_mart(spark, plain, name))
    # All six months were published by one record per dataset.
    assert silver_table(spark, lake.table("silver/trips")).head() == 3


def test_second_session_reads_tables_and_view_after_each_run(spark, lake):
    run(spark, lake, AS_OF)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    first = other.table("versioned_run.gold_trips_unified").count()
    assert first == read_silver(spark, lake.table("silver/trips")).count() > 0
    assert rows(other.table("versioned_run.gold_service_comparison")) == rows(read_mart(spark, lake, "service_comparison"))
    run(spark, lake, AS_OF)
    view = other.table("versioned_run.gold_trips_unified")
    assert view.count() == read_silver(spark, lake.table("silver/trips")).count() > first
    assert view.where("service_type = 'green' and month = 6").count() > 0
    assert rows(other.table("versioned_run.gold_demand_timeseries")) == rows(read_mart(spark, lake, "demand_timeseries"))
    spark.sql("DROP DATABASE versioned_run CASCADE")


def test_plain_lake_is_registered_too(spark, lake):
    plain = replace(lake, versioned=False, catalog="plain_run")
    run(spark, plain, AS_OF, ["green"])
    assert spark.newSession().table("plain_run.gold_trips_unified").count() > 0
    with pytest.raises(ValueError, match="other layout"):
        run(spark, lake, AS_OF, ["green"])
    spark.sql("DROP DATABASE plain_run CASCADE")


def test_failed_months_stay_invisible_and_old_ones_in_place(spark, lake):
    run(spark, lake, AS_OF, ["yellow"])
    silver = lake.table("silver/trips")
    before, mart = rows(read_silver(spark, silver)), rows(read_mart(spark, lake, "od_matrix"))
    strict = replace(lake, rules=(RowCount(0), Compare("trip_distance", ">", 30)))
    with pytest.raises(RunFailed, match="quality rule"):
        run(spark, strict, AS_OF, periods=[("yellow", "1998-05")])
    assert rows(read_silver(spark, silver)) == before
    assert rows(read_mart(spark, lake, "od_matrix")) == mart
    assert state(spark, lake)["yellow", "1998-05"][2] == "FAILED"


def test_a_month_written_again_reaches_parts_and_marts(spark, lake):
    run(spark, lake, AS_OF, ["green", "fhvhv"], whole_backlog=True)
    loose = replace(lake, bounds=replace(lake.bounds, max_distance=20))
    run(spark, loose, AS_OF, periods=[("fhvhv", "1998-05")])
    full = replace(lake, incremental=False, root=lake.root)
    parts = rows(read_mart(spark, lake, "service_comparison").drop("tip_pct", "driver_share_pct"))
    run(spark, full, AS_OF, [], periods=[])
    assert parts == rows(read_mart(spark, lake, "service_comparison").drop("tip_pct", "driver_share_pct"))
    # Only the month written again was computed anew.
    silver = silver_table(spark, lake.table("silver/trips"))
    price = VersionedTable(spark, lake.table("parts/price"), silver.partitions)
    assert price.head() == 2
    refresh_versioned_parts(spark, silver, lake.table("parts"))
    assert price.head() == 2


def test_two_runs_of_one_month_do_not_mix(spark, lake, monkeypatch):
    """While a run builds a month, another publishes it: the first one fails and publishes nothing."""
    from tripmart.sources import lake as lake_module

    run(spark, lake, AS_OF, ["green"])
    silver = silver_table(spark, lake.table("silver/trips"))
    evaluate = lake_module.evaluate_months

    def meanwhile(written, planned, rules):
        silver.publish(written.limit(1))
        return evaluate(written, planned, rules)

    monkeypatch.setattr(lake_module, "evaluate_months", meanwhile)
    with pytest.raises(RunFailed, match="replaced meanwhile"):
        run(spark, lake, AS_OF, periods=[("green", "1998-05")])
    assert silver.read().count() == 1
    assert issubclass(ConcurrentCommit, Exception)


def test_a_changed_source_is_fetched_when_its_month_is_built_again(spark, lake):
    run(spark, lake, AS_OF, ["green"])
    path = f"{lake.source}/green_tripdata_1998-05.parquet"
    kept = spark.read.parquet(path).where("trip_distance <= 10")
    spark.createDataFrame(kept.collect(), kept.schema).coalesce(1).write.mode("overwrite").parquet(path)
    assert run(spark, lake, AS_OF, periods=[("green", "1998-05")]) == [("green", "1998-05")]
    assert state(spark, lake)["green", "1998-05"] == ("DONE", "ingested", "DONE")
    assert read_silver(spark, lake.table("silver/trips")).agg(F.max("trip_distance")).first()[0] <= 10
