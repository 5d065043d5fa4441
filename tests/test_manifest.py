import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.operators.align import align
from tripmart.operators.clean import Span
from tripmart.sources import derived
from tripmart.sources.files import Folder
from tripmart.sources.manifest import adopt, entries, last_landings, listed, scan_landed
from tripmart.sources.raw import land

MAY = Span.month(date(2024, 5, 1))
JUNE = Span.month(date(2024, 6, 1))


def trips(spark, *days):
    """Yellow raw rows picked up at the given times."""
    one = derived.raw_lines(spark, SMALL, "yellow").limit(1).drop("tpep_pickup_datetime", "tpep_dropoff_datetime").collect()
    base = spark.createDataFrame(one * 1)
    times = spark.createDataFrame([(datetime.fromisoformat(d),) for d in days], "t timestamp_ntz")
    return base.crossJoin(times).withColumnsRenamed({"t": "tpep_pickup_datetime"}).withColumn(
        "tpep_dropoff_datetime", F.col("tpep_pickup_datetime") + F.expr("interval 1 hour")
    )


@pytest.fixture
def raw(spark, tmp_path):
    """Months of which one brings a trip a year late and one has another shape."""
    root = f"{tmp_path}/yellow"
    put = lambda frame, month: frame.coalesce(1).write.mode("append").parquet(f"{root}/year={month[:4]}/month={month[5:]}")
    put(trips(spark, "2024-05-01 00:00:00", "2024-05-31 23:59:59"), "2024-05")
    put(trips(spark, "2024-06-01 00:00:00"), "2024-06")
    put(trips(spark, "2025-05-03 10:00:00", "2024-05-20 10:00:00"), "2025-05")
    put(trips(spark, "2024-05-07 10:00:00").withColumnRenamed("passenger_count", "PASSENGER_COUNT").drop("Airport_fee"), "2024-05")
    put(trips(spark, "2024-05-07 10:00:00").limit(0), "2024-07")
    return str(tmp_path)


def in_month(frames, span):
    kept = [align(f, "yellow").where((F.col("pickup_datetime") >= F.lit(str(span.start))) & (F.col("pickup_datetime") < F.lit(str(span.end)))) for f in frames]
    return sum(f.count() for f in kept)


def test_a_trip_delivered_a_year_late_is_found_and_other_files_are_not_read(spark, raw):
    manifest = f"{raw}/_manifest"
    frames = scan_landed(spark, raw, manifest, "yellow", MAY)
    assert len(frames) == 2  # two shapes
    files = [f for frame in frames for f in frame.inputFiles()]
    assert {f.split("/yellow/")[1].rsplit("/", 1)[0] for f in files} == {"year=2024/month=05", "year=2025/month=05"}
    assert len(files) == 3 and in_month(frames, MAY) == 4
    june = scan_landed(spark, raw, manifest, "yellow", JUNE)
    # The late file spans a year, so it may hold June trips as well.
    assert len([f for frame in june for f in frame.inputFiles()]) == 2 and in_month(june, JUNE) == 1
    everything = scan_landed(spark, raw, manifest, "yellow")
    assert sum(f.count() for f in everything) == 6


def test_no_footer_is_opened_once_a_file_is_known(spark, raw, monkeypatch):
    manifest = f"{raw}/_manifest"
    assert adopt(spark, raw, manifest, "yellow") == 5
    assert adopt(spark, raw, manifest, "yellow") == 0
    # With the data gone a footer could not be read; planning still works from the manifest.
    sizes = listed(spark, raw, "yellow").collect()
    monkeypatch.setattr("tripmart.sources.manifest.listed", lambda *_: spark.createDataFrame(sizes, "file string, bytes bigint"))
    for row in sizes:
        path = f"{raw}/yellow/{row['file']}"
        with open(path, "r+b") as file:
            file.seek(0)
            file.write(b"\0" * row["bytes"])
    frames = scan_landed(spark, raw, manifest, "yellow", MAY)
    assert sum(len(f.inputFiles()) for f in frames) == 3


def test_replaced_and_removed_files(spark, raw):
    manifest = f"{raw}/_manifest"
    adopt(spark, raw, manifest, "yellow")
    folder = f"{raw}/yellow/year=2024/month=06"
    shutil.rmtree(folder)
    trips(spark, "2024-05-09 00:00:00", "2024-06-02 00:00:00", "2024-06-03 00:00:00").coalesce(1).write.parquet(folder)
    assert in_month(scan_landed(spark, raw, manifest, "yellow", MAY), MAY) == 5
    found = entries(spark, raw, manifest, "yellow").collect()
    assert len(found) == 5 and sum(r["nb_rows"] for r in found) == 8


def test_unknown_pickup_is_never_left_out(spark, tmp_path):
    folder = f"{tmp_path}/yellow/year=2024/month=01"
    trips(spark, "2024-01-01 00:00:00").drop("tpep_pickup_datetime").write.parquet(folder)
    frames = scan_landed(spark, str(tmp_path), f"{tmp_path}/_manifest", "yellow", MAY)
    assert sum(f.count() for f in frames) == 1
    with pytest.raises(ValueError, match="tpep_pickup_datetime"):
        align(frames[0], "yellow")


def test_nothing_landed_and_nothing_in_the_span(spark, raw):
    assert scan_landed(spark, raw, f"{raw}/_manifest", "green", MAY) == []
    frames = scan_landed(spark, raw, f"{raw}/_manifest", "yellow", Span.month(date(1990, 1, 1)))
    assert len(frames) == 1 and align(frames[0], "yellow").count() == 0


def test_landing_writes_both_tables_and_sees_a_changed_source(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"{tmp_path}/raw"
    manifest, ledger = f"{tmp_path}/manifest", f"{tmp_path}/ledger"
    os.mkdir(source)
    path = f"{source}/yellow_tripdata_2024-05.parquet"
    plan = spark.createDataFrame([("yellow", "2024-05")], "dataset string, period string")

    def go(**more):
        (x,) = land(spark, plan, source, root, manifest=manifest, ledger=ledger, **more)
        return x.detail, x.changed

    trips(spark, "2024-05-01 00:00:00", "2024-05-02 00:00:00").coalesce(1).write.parquet(path)
    assert go() == ("ingested", False)
    assert go() == ("skipped", False)
    assert adopt(spark, root, manifest, "yellow") == 0
    (row,) = entries(spark, root, manifest, "yellow").collect()
    assert (row["nb_rows"], str(row["first_pickup"]), str(row["last_pickup"])) == (2, "2024-05-01 00:00:00", "2024-05-02 00:00:00")
    # The same rows written again, in other order: not a change.
    trips(spark, "2024-05-02 00:00:00", "2024-05-01 00:00:00").coalesce(1).write.mode("overwrite").parquet(path)
    assert go() == ("skipped", False)
    trips(spark, "2024-05-01 00:00:00", "2024-05-03 00:00:00").coalesce(1).write.mode("overwrite").parquet(path)
    assert go() == ("skipped", True)
    assert go(refresh=True) == ("ingested", False)
    assert go(refresh=True) == ("skipped", False)
    frames = scan_landed(spark, root, manifest, "yellow", MAY)
    assert sum(f.count() for f in frames) == 2
    assert str(max(r[0] for f in frames for r in f.select(F.max("tpep_pickup_datetime")).collect())) == "2024-05-03 00:00:00"
    assert last_landings(spark, ledger).count() == 1
    # A source that was cleared away does not hinder a landed month.
    Folder(spark, path).delete()
    assert go() == ("skipped", False)
