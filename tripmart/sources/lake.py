"""Silver and datamart tables as Parquet folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.clean import Span
from tripmart.operators.quality import (
    SILVER_RULES,
    Rule,
    evaluate_months,
    measures,
    require_passed,
    rule_table_from_observed,
)
from tripmart.schema import DATASETS, PARTITIONS, SILVER, UNIFIED
from tripmart.sources.files import Folder
from tripmart.sources.versions import VersionedTable

# Below the table folder, yet invisible to its readers (leading underscore).
_STAGING = "_staging"


def with_partitions(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")}
    )


def arrange(trips: DataFrame, span: Span | None, files: int | None = None) -> DataFrame:
    """Decide how many files the write produces.

    One month: the partitions of the dedup shuffle, sized in bytes by AQE, are
    the files; no further shuffle. Several months: REBALANCE on the partition
    columns, which AQE merges when small and splits when one month is hot.
    ``files`` forces a number.
    """
    if files is not None:
        return trips.repartition(files)
    if span is not None and span.single_month:
        return trips
    return trips.hint("rebalance", *PARTITIONS)


def write_gated(
    trips: DataFrame,
    target: str,
    rules: tuple[Rule, ...] = SILVER_RULES,
    partitions: tuple[str, ...] = PARTITIONS,
) -> DataFrame:
    """Write to staging, judge, then replace just the partitions of this run.

    The rule measures are observed while the staged files are written: the
    input is computed once, nothing is cached, and nothing can be seen by
    readers before the gate passed. They sit after the last shuffle, where a
    task that runs again after a lost executor is counted once.
    """
    spark = trips.sparkSession
    table = Folder(spark, target)
    run = f"{_STAGING}/{uuid.uuid4().hex}"
    staged = f"{target.rstrip('/')}/{run}"
    seen = Observation("quality")
    try:
        (
            trips.observe(seen, *measures(rules))
            .write.mode("errorifexists")
            .partitionBy(*partitions)
            .parquet(f"{staged}/new")
        )
        report = rule_table_from_observed(spark, seen.get, rules)
        require_passed(report)
    except Exception:
        table.delete(run)
        raise
    # From here on a failure keeps the staging folder: what was replaced so far
    # is in it, and running the same months again completes the rest.
    depth = "/".join(f"{p}=*" for p in partitions)
    for part in Folder(spark, f"{staged}/new").glob(depth):
        table.move_here(f"{staged}/new/{part}", part, f"{staged}/old/{part}")
    table.delete(run)
    return report


def write_gated_months(
    trips: DataFrame,
    target: str,
    months: list[tuple[int, int]],
    rules: tuple[Rule, ...] = SILVER_RULES,
    partitions: tuple[str, ...] = PARTITIONS,
) -> list[Row]:
    """Write several months in one job, judge and publish each on its own.

    The staged files are read once more for the measures: these are grouped by
    month, which an observation cannot do. Only months that pass are published;
    the rows (year, month, rule, actual, outcome) of all of them are returned,
    a few per planned month.
    """
    spark = trips.sparkSession
    table = Folder(spark, target)
    run = f"{_STAGING}/{uuid.uuid4().hex}"
    staged = f"{target.rstrip('/')}/{run}"
    try:
        trips.write.mode("errorifexists").partitionBy(*partitions).parquet(f"{staged}/new")
        written = spark.read.schema(trips.schema).parquet(f"{staged}/new")
        planned = spark.createDataFrame(months, "year int, month int")
        report = evaluate_months(written, planned, rules).collect()
    except Exception:
        table.delete(run)
        raise
    failed = {(r["year"], r["month"]) for r in report if r["outcome"] == "Failed"}
    keep = set(months) - failed
    depth = "/".join(f"{p}=*" for p in partitions)
    for part in Folder(spark, f"{staged}/new").glob(depth):
        values = dict(piece.split("=", 1) for piece in part.split("/"))
        if (int(values["year"]), int(values["month"])) in keep:
            table.move_here(f"{staged}/new/{part}", part, f"{staged}/old/{part}")
    table.delete(run)
    return report


def silver_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, PARTITIONS)


def write_gated_versions(
    trips: DataFrame,
    target: str,
    months: list[tuple[int, int]],
    rules: tuple[Rule, ...] = SILVER_RULES,
    partitions: tuple[str, ...] = PARTITIONS,
) -> list[Row]:
    """As ``write_gated_months``, published by one commit record.

    All months that pass become visible at once, those that fail stay a version
    that no reader sees. A run that replaced the same months meanwhile makes
    this one fail before it publishes anything.
    """
    spark = trips.sparkSession
    table = VersionedTable(spark, target, partitions)
    since = table.head()
    version = table.stage(trips)
    written = spark.read.schema(trips.schema).parquet(table.folder(version))
    planned = spark.createDataFrame(months, "year int, month int")
    report = evaluate_months(written, planned, rules).collect()
    keep = set(months) - {(r["year"], r["month"]) for r in report if r["outcome"] == "Failed"}
    parts = [part for part in table.parts_of(version) if _month_of(part) in keep]
    if parts:
        table.commit(version, parts, since)
    return report


def _month_of(part: str) -> tuple[int, int]:
    values = dict(piece.split("=", 1) for piece in part.split("/"))
    return int(values["year"]), int(values["month"])


def overwrite_partitions(df: DataFrame, target: str, *partitions: str) -> None:
    """Replace only the partitions present in ``df``; an empty one changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(target)
    )


def append_rows(df: DataFrame, target: str) -> None:
    """Add a few rows as one file.

    Spark's own append shares one working folder per table, which parallel
    writers would delete under each other. Here every writer has its own and
    moves one finished file into the table.
    """
    spark = df.sparkSession
    table, run = Folder(spark, target), f"{_STAGING}/{uuid.uuid4().hex}"
    staged = f"{table.path}/{run}"
    df.coalesce(1).write.parquet(staged)
    for name in Folder(spark, staged).glob("*.parquet"):
        table.move_here(f"{staged}/{name}", name, f"{staged}/old/{name}")
    table.delete(run)


def materialise(mart: DataFrame, target: str) -> None:
    """Write beside the old mart and swap, so readers never see half of one."""
    spark = mart.sparkSession
    work = f"{target.rstrip('/')}__{uuid.uuid4().hex}"
    mart.write.option("compression", "snappy").parquet(f"{work}/new")
    Folder(spark, target).move_here(f"{work}/new", "", f"{work}/old")
    Folder(spark, work).delete()


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Silver of either layout: plain partition folders, or versions with a commit log."""
    table = silver_table(spark, root)
    if table.exists() or Folder(spark, root).glob("version=*"):
        return table.read(SILVER)
    return spark.read.schema(SILVER).parquet(root)


def unified_trips(spark: SparkSession, root: str) -> DataFrame:
    """The columns published from silver, over all services, as one scan."""
    return read_silver(spark, root).select(*UNIFIED)


def unified_by_branch(spark: SparkSession, root: str) -> DataFrame:
    """The same rows as a union of one tagged branch per service, for layouts
    in which every service is a table of its own."""
    union = None
    for service in DATASETS:
        branch = (
            read_silver(spark, root)
            .filter(F.col("service_type") == service)
            .withColumn("service_type", F.lit(service))
            .select(*UNIFIED)
        )
        union = branch if union is None else union.unionByName(branch)
    return union


def publish_view(trips: DataFrame, name: str = "gold_trips_unified") -> None:
    trips.createOrReplaceTempView(name)
