"""Landing raw monthly files and scanning what has landed."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.periods import landing_folder, next_month, period_start, source_file
from tripmart.operators.align import lower_names
from tripmart.operators.clean import Span
from tripmart.schema import DATASETS, check_dataset
from tripmart.session import in_parallel
from tripmart.sources.files import Folder
from tripmart.sources.manifest import (
    content_digest,
    last_landings,
    record_landing,
    source_changed,
    source_state,
    write_down,
)


@dataclass(frozen=True)
class Landing:
    """Outcome of one (dataset, period): ``ingested``, ``skipped`` or an error.

    ``changed`` tells that the source of a skipped month holds other rows now.
    """

    dataset: str
    period: str
    detail: str
    ok: bool = True
    changed: bool = False


def landed_periods(spark: SparkSession, raw_root: str) -> DataFrame:
    """(dataset, period) of every landed month, from folder names alone."""
    rows = [(p,) for p in Folder(spark, raw_root).glob("*/year=*/month=*")]
    pattern = r"^(.+)/year=(\d+)/month=(\d+)$"
    return (
        spark.createDataFrame(rows, "path string")
        .select(
            F.regexp_extract("path", pattern, 1).alias("dataset"),
            F.format_string(
                "%04d-%02d",
                F.regexp_extract("path", pattern, 2).cast("int"),
                F.regexp_extract("path", pattern, 3).cast("int"),
            ).alias("period"),
        )
        .filter(F.col("dataset").isin(*DATASETS))
    )


def land(
    spark: SparkSession,
    plan: DataFrame,
    source_root: str,
    raw_root: str,
    parallel: int = 3,
    manifest: str | None = None,
    ledger: str | None = None,
    refresh: bool = False,
) -> list[Landing]:
    """Land each planned (dataset, period) unchanged, once.

    Each month keeps its own schema, so months are separate Spark writes; the
    rows of a month never leave the executors. A month is written aside and
    moved into place when complete, so its folder is there either whole or not
    at all. Only the plan, one line per dataset and month, is read on the driver.

    With a ``manifest`` the new files are written down there, with a ``ledger``
    the source is, so that a changed one is noticed the next time. Such a month
    is landed again with ``refresh``, else it is reported as changed.
    """
    lake = Folder(spark, raw_root)
    aside = f"_staging/{uuid.uuid4().hex}"
    landed = landed_periods(spark, raw_root).withColumn("landed", F.lit(True))
    name, day = F.col("dataset"), period_start(F.col("period"))
    todo = plan.join(landed, ["dataset", "period"], "left").select(
        "dataset",
        "period",
        F.coalesce("landed", F.lit(False)).alias("landed"),
        source_file(name, day, source_root).alias("source"),
        landing_folder(name, day).alias("folder"),
    )

    before = {}
    if ledger is not None:
        known = last_landings(spark, ledger).join(plan, ["dataset", "period"], "left_semi")
        before = {(r["dataset"], r["period"]): r for r in known.collect()}

    def one(row) -> Landing:
        staged = f"{lake.path}/{aside}/{row['folder']}"
        try:
            if row["landed"]:
                last = before.get((row["dataset"], row["period"]))
                changed = last is not None and source_changed(spark, last, row["source"])
                if not (changed and refresh):
                    return Landing(row["dataset"], row["period"], "skipped", changed=changed)
            # Looked at before the rows are read: a source that changes meanwhile is read again.
            state = source_state(spark, row["source"]) if ledger is not None else None
            frame, seen = spark.read.parquet(row["source"]), Observation("landing")
            frame.observe(seen, F.count(F.lit(1)).alias("n"), content_digest(frame).alias("digest")).write.parquet(staged)
            lake.move_here(staged, row["folder"], f"{lake.path}/{aside}/old/{row['folder']}")
            if manifest is not None:
                write_down(spark, raw_root, manifest, row["dataset"], row["folder"], frame.schema)
            if ledger is not None:
                counted = seen.get
                record_landing(
                    spark, ledger, row["dataset"], row["period"], row["source"], state, counted["n"], counted["digest"]
                )
        except Exception as error:  # recorded per month; the others go on
            reason = f"{type(error).__name__}: {error}"
            return Landing(row["dataset"], row["period"], reason, ok=False)
        return Landing(row["dataset"], row["period"], "ingested")

    outcomes = in_parallel(spark, one, todo.orderBy("dataset", "period").collect(), parallel)
    lake.delete(aside)
    return outcomes


def scan_raw(
    spark: SparkSession, raw_root: str, dataset: str, near: Span | None = None
) -> list[DataFrame]:
    """Scans that together cover everything landed for a dataset.

    Files with the same column names and types share one scan, also when a
    month was delivered in several files of different shapes. A change of type,
    which a merged schema would refuse, starts another scan.

    ``near`` keeps only the folders of that span and one month on either side.
    It saves listing and footer reads but loses trips that were delivered in a
    file further away, so it is off by default.
    """
    root = f"{raw_root.rstrip('/')}/{check_dataset(dataset)}"
    files = [f for f in Folder(spark, root).glob("year=*/month=*/*") if _is_data(f)]
    if near is not None:
        files = [f for f in files if _within(f.rsplit("/", 1)[0], near)]

    def shape(file: str) -> tuple:
        schema = spark.read.parquet(f"{root}/{file}").schema
        return tuple((f.name.lower(), f.dataType.json()) for f in schema.fields)

    groups: dict[tuple, list[str]] = {}
    for file, key in zip(files, in_parallel(spark, shape, files, 8)):
        groups.setdefault(key, []).append(f"{root}/{file}")
    return [
        lower_names(spark.read.option("basePath", root).parquet(*group))
        for group in groups.values()
    ]


def _is_data(path: str) -> bool:
    return not path.rsplit("/", 1)[1].startswith(("_", "."))


def _within(folder: str, near: Span) -> bool:
    year, month = (int(part.split("=")[1]) for part in folder.split("/"))
    return next_month(near.start, -1) <= date(year, month, 1) <= near.end
