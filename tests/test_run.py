import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.functions.privacy import PEPPER_SETTING
from tripmart.operators.marts import MARTS
from tripmart.operators.parts import MARTS_FROM_PARTS, PARTS
from tripmart.operators.planning import registry_state
from tripmart.operators.quality import Compare
from tripmart.plans.run import Lake, RunFailed, _spans, plan_run, read_mart, run
from tripmart.operators.align import align
from tripmart.operators.clean import Span
from tripmart.schema import DATASETS
from tripmart.sources import derived
from tripmart.plans.refresh import forget_parts
from tripmart.plans.silver import build_silver
from tripmart.sources.lake import read_silver, with_partitions
from tripmart.sources.raw import land, landed_periods, scan_raw
from tripmart.sources.registry import read_events
from tripmart.sources.zones import checked


@pytest.fixture
def lake(spark, tmp_path):
    """Monthly files 1998-05 to 1998-07 of all services, and a zone file."""
    spark.conf.set(PEPPER_SETTING, "test-pepper")
    source = tmp_path / "source"
    pickup = {
        "yellow": "tpep_pickup_datetime",
        "green": "lpep_pickup_datetime",
        "fhvhv": "pickup_datetime",
    }
    for dataset in DATASETS:
        raw = derived.raw_lines(spark, SMALL, dataset).cache()
        for month in (5, 6, 7):
            rows = raw.filter(F.date_format(pickup[dataset], "yyyy-M") == f"1998-{month}")
            rows.coalesce(1).write.parquet(f"{source}/{dataset}_tripdata_1998-{month:02d}.parquet")
        raw.unpersist()
    zones = derived.zones(spark, SMALL).orderBy("locationid").collect()
    with open(tmp_path / "zones.csv", "w") as out:
        out.write("LocationID,Borough,Zone\n")
        out.writelines(f'{z.locationid},"{z.borough}","{z.zone}"\n' for z in zones)
    yield Lake(
        source=str(source),
        root=str(tmp_path / "lake"),
        zones_csv=str(tmp_path / "zones.csv"),
        first_period="1998-05",
        bounds=derived.LINE_BOUNDS,
        rules=(Compare("trip_distance", ">", 0),),
    )
    spark.conf.unset(PEPPER_SETTING)


def state(spark, lake):
    rows = registry_state(read_events(spark, lake.table("registry"))).collect()
    return {(r.dataset, r.period): (r.bronze_status, r.bronze_detail, r.silver_status) for r in rows}


def plan(spark, *pairs):
    return spark.createDataFrame(list(pairs), "dataset string, period string")


def test_landing_once_and_unchanged(spark, lake):
    bronze = lake.table("bronze")
    wanted = plan(spark, ("yellow", "1998-05"), ("green", "1998-06"), ("green", "1999-01"))
    first = {(x.dataset, x.period): x for x in land(spark, wanted, lake.source, bronze)}
    assert first["yellow", "1998-05"].detail == "ingested"
    assert not first["green", "1999-01"].ok
    again = {(x.dataset, x.period): x for x in land(spark, wanted, lake.source, bronze)}
    assert again["yellow", "1998-05"].detail == "skipped"
    assert not again["green", "1999-01"].ok
    assert sorted(tuple(r) for r in landed_periods(spark, bronze).collect()) == [
        ("green", "1998-06"),
        ("yellow", "1998-05"),
    ]
    source = spark.read.parquet(f"{lake.source}/yellow_tripdata_1998-05.parquet")
    landed = spark.read.parquet(f"{bronze}/yellow/year=1998/month=05")
    assert landed.schema == source.schema
    assert sorted(map(str, landed.collect())) == sorted(map(str, source.collect()))


def test_scan_covers_months_of_different_types(spark, tmp_path):
    raw = derived.raw_lines(spark, SMALL, "yellow").limit(20)
    root = f"{tmp_path}/yellow"
    raw.write.parquet(f"{root}/year=2024/month=01")
    raw.withColumn("passenger_count", F.lit(2).cast("long")).write.parquet(f"{root}/year=2024/month=02")
    raw.drop("Airport_fee").write.parquet(f"{root}/year=2024/month=03")
    raw.toDF(*[c.upper() for c in raw.columns]).write.parquet(f"{root}/year=2024/month=12")
    parts = scan_raw(spark, str(tmp_path), "yellow")
    assert len(parts) == 3
    assert sum(align(p, "yellow").count() for p in parts) == 80
    near = scan_raw(spark, str(tmp_path), "yellow", Span.month(date(2024, 2, 1)))
    assert sum(p.count() for p in near) == 60


def test_one_month_per_run_until_nothing_is_due(spark, lake):
    as_of = date(1998, 8, 20)  # two months lag: June is the last one
    assert run(spark, lake, as_of) == [(d, "1998-05") for d in sorted(DATASETS)]
    assert state(spark, lake)["green", "1998-05"] == ("DONE", "ingested", "DONE")
    assert run(spark, lake, as_of) == [(d, "1998-06") for d in sorted(DATASETS)]
    before = sorted(map(str, read_mart(spark, lake, "demand_timeseries").collect()))
    assert run(spark, lake, as_of) == []
    assert sorted(map(str, read_mart(spark, lake, "demand_timeseries").collect())) == before
    months = read_silver(spark, lake.table("silver/trips")).select("service_type", "month")
    assert months.distinct().count() == 6
    total = read_mart(spark, lake, "service_comparison").agg(F.sum("nb_courses")).first()[0]
    assert 0 < total <= months.count()
    assert spark.table("gold_trips_unified").count() == months.count()
    assert spark.read.parquet(lake.table("quality")).count() == 6


def test_whole_backlog_at_once_equals_month_by_month(spark, lake):
    from dataclasses import replace

    as_of = date(1998, 9, 1)
    bulk = replace(lake, root=lake.root + "-bulk")
    assert len(run(spark, bulk, as_of, whole_backlog=True)) == 9
    for _ in range(3):
        run(spark, lake, as_of)
    for name in ("silver/trips", "gold/service_comparison", "gold/demand_timeseries"):
        one = spark.read.parquet(lake.table(name))
        other = spark.read.parquet(bulk.table(name)).select(*one.columns)
        assert one.count() > 0 or name == "gold/demand_timeseries"
        if name.startswith("silver"):
            assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
        else:
            assert one.select(F.sum("nb_courses")).first() == other.select(F.sum("nb_courses")).first()


@pytest.mark.parametrize("name", ["service_comparison", "od_matrix", "demand_timeseries"])
def test_parts_give_the_direct_marts(spark, name):
    lookup = checked(derived.zones(spark, SMALL))
    trips = with_partitions(derived.line_trips(spark, SMALL))
    parts = {n: build(trips) for n, build in PARTS.items()}
    direct = MARTS[name](trips, lookup, k=2)
    again = MARTS_FROM_PARTS[name](parts, lookup, k=2)
    assert direct.columns == again.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, again.collect()))


def test_incremental_marts_follow_a_month_written_again(spark, lake):
    from dataclasses import replace

    as_of = date(1998, 8, 20)
    run(spark, lake, as_of, whole_backlog=True)
    silver, parts = lake.table("silver/trips"), lake.table("parts")
    loose = replace(lake.bounds, max_distance=20)
    raw = scan_raw(spark, lake.table("bronze"), "fhvhv")
    build_silver(
        raw, "fhvhv", Span.month(date(1998, 5, 1)), silver, "p", loose, lake.rules
    )
    forget_parts(spark, parts, "fhvhv", ["1998-05"])
    kept = set(os.listdir(f"{parts}/route/service_type=fhvhv/year=1998"))
    assert kept == {"month=6"}
    run(spark, lake, as_of)
    columns = ["service_type", "borough", "nb_courses", "part_marche_pct", "panier_median"]
    one = sorted(map(str, read_mart(spark, lake, "service_comparison").select(columns).collect()))
    full = replace(lake, incremental=False)
    run(spark, full, as_of)
    other = read_mart(spark, full, "service_comparison").select(columns).collect()
    assert one and one == sorted(map(str, other))


def test_backlog_is_cut_into_jobs_of_consecutive_months():
    periods = ["2024-01", "2023-12", "2024-02", "2024-05"]
    assert [names for _, names in _spans(periods, 12)] == [
        ["2023-12", "2024-01", "2024-02"],
        ["2024-05"],
    ]
    assert [(str(span.start), str(span.end)) for span, _ in _spans(periods, 2)] == [
        ("2023-12-01", "2024-02-01"),
        ("2024-02-01", "2024-03-01"),
        ("2024-05-01", "2024-06-01"),
    ]


def test_failures_are_recorded_and_block_the_marts(spark, lake):
    from dataclasses import replace

    strict = replace(lake, rules=(Compare("trip_distance", ">", 30),))
    with pytest.raises(RunFailed, match="quality rule"):
        run(spark, strict, date(1998, 8, 20), datasets=("yellow", "green"))
    assert state(spark, lake) == {
        ("yellow", "1998-05"): ("DONE", "ingested", "FAILED"),
        ("green", "1998-05"): ("DONE", "ingested", "FAILED"),
    }
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_mart(spark, lake, "od_matrix")
    due = plan_run(spark, lake, date(1998, 8, 20), ("yellow", "green"))
    assert {r.period for r in due.collect()} == {"1998-05"}
    assert run(spark, lake, date(1998, 8, 20), datasets=("yellow",)) == [("yellow", "1998-05")]
    assert state(spark, lake)["yellow", "1998-05"] == ("DONE", "skipped", "DONE")


def test_missing_source_file_fails_the_landing_only(spark, lake):
    from dataclasses import replace

    early = replace(lake, first_period="1998-04")
    with pytest.raises(RunFailed, match="green 1998-04"):
        run(spark, early, date(1998, 8, 20), datasets=("green",))
    assert state(spark, lake) == {("green", "1998-04"): ("FAILED", None, "PENDING")}


def test_nothing_published_yet(spark, lake):
    assert run(spark, lake, date(1998, 6, 30)) == []
    assert state(spark, lake) == {}


def test_unknown_dataset_is_refused(spark, lake):
    with pytest.raises(Exception, match="unknown dataset: purple"):
        run(spark, lake, date(1998, 8, 20), datasets=("purple",))


@pytest.mark.parametrize("months_per_job", [1, 2, 12])
def test_bulk_judges_every_month_on_its_own(spark, lake, months_per_job):
    """An empty month in the middle fails alone, is reported, and comes up again first."""
    from dataclasses import replace

    from tripmart.operators.quality import RowCount

    path = f"{lake.source}/yellow_tripdata_1998-06.parquet"
    spark.read.parquet(path).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}.empty")
    os.rename(path, f"{path}.good")
    os.rename(f"{path}.empty", path)
    strict = replace(lake, rules=(RowCount(0),), months_per_job=months_per_job)
    as_of = date(1998, 9, 1)
    with pytest.raises(RunFailed, match="1998-06"):
        run(spark, strict, as_of, ["yellow"], whole_backlog=True)
    done = {p: s for (d, p), (_, _, s) in state(spark, strict).items()}
    assert done == {"1998-05": "DONE", "1998-06": "FAILED", "1998-07": "DONE"}
    months = read_silver(spark, strict.table("silver/trips")).select("month").distinct().collect()
    assert sorted(r["month"] for r in months) == [5, 7]
    report = spark.read.parquet(strict.table("quality")).collect()
    assert {(r["period"], r["actual"] > 0, r["outcome"]) for r in report} == {
        ("1998-05", True, "Passed"), ("1998-06", False, "Failed"), ("1998-07", True, "Passed"),
    }
    assert [tuple(r) for r in plan_run(spark, strict, as_of, ["yellow"]).collect()] == [("yellow", "1998-06")]


def test_given_months_are_built_again(spark, lake):
    as_of = date(1998, 8, 20)
    run(spark, lake, as_of, ["green"])
    before = read_mart(spark, lake, "demand_timeseries").agg(F.sum("nb_courses")).first()[0]
    silver = lake.table("silver/trips")
    from dataclasses import replace

    loose = replace(lake, bounds=replace(lake.bounds, max_distance=5))
    assert run(spark, loose, as_of, periods=[("green", "1998-05")]) == [("green", "1998-05")]
    assert read_silver(spark, silver).agg(F.max("trip_distance")).first()[0] <= 5
    after = read_mart(spark, lake, "demand_timeseries").agg(F.sum("nb_courses")).first()[0]
    assert (after or 0) < (before or 1)


def test_files_of_one_month_may_differ(spark, tmp_path):
    raw = derived.raw_lines(spark, SMALL, "yellow").limit(30).cache()
    folder = f"{tmp_path}/yellow/year=2024/month=01"
    raw.coalesce(1).write.parquet(folder)
    raw.drop("Airport_fee").coalesce(1).write.mode("append").parquet(folder)
    raw.withColumn("passenger_count", F.lit(2).cast("long")).coalesce(1).write.mode("append").parquet(folder)
    parts = scan_raw(spark, str(tmp_path), "yellow")
    assert len(parts) == 3 and sum(align(p, "yellow").count() for p in parts) == 90
    fees = sum(p.where("airport_fee is not null").count() for p in parts if "airport_fee" in p.columns)
    assert fees == 2 * raw.where("Airport_fee is not null").count()


def test_command_line():
    from tripmart.__main__ import arguments

    base = ["--source", "s", "--root", "r", "--zones", "z"]
    assert arguments([*base, "--dataset", "yellow", "--year", "2024", "--month", "2"]).period == "2024-02"
    with pytest.raises(SystemExit):
        arguments([*base, "--backlog", "--period", "2024-02"])
