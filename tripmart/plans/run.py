"""One scheduled run: plan, land, clean, then rebuild the datamarts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.periods import parse_period
from tripmart.functions.privacy import configured_pepper
from tripmart.operators.clean import Bounds, Span
from tripmart.operators.marts import MARTS
from tripmart.operators.planning import (
    FIRST_PERIOD,
    LAG_MONTHS,
    backlog,
    next_missing,
    registry_state,
)
from tripmart.operators.quality import SILVER_RULES, Rule
from tripmart.plans.refresh import (
    build_marts,
    forget_parts,
    refresh_parts,
    refresh_versioned_parts,
)
from tripmart.plans.silver import build_silver_months
from tripmart.schema import DATASETS, PARTITIONS, SILVER, check_dataset
from tripmart.session import FILE_SIZING, in_parallel, prepare
from tripmart.sources.catalog import (
    point_table,
    register_silver,
    register_table,
    replace_unified_view,
)
from tripmart.sources.files import Folder
from tripmart.sources.lake import (
    append_rows,
    publish_view,
    silver_table,
    unified_trips,
    write_gated_months,
    write_gated_versions,
)
from tripmart.sources.manifest import scan_landed
from tripmart.sources.raw import land
from tripmart.sources.registry import read_events, record
from tripmart.sources.versions import VersionedTable
from tripmart.sources.zones import checked, read_zones


class RunFailed(Exception):
    """At least one dataset failed; the datamarts were not rebuilt."""


@dataclass(frozen=True)
class Lake:
    """Where the tables are, and the settings of a deployment."""

    source: str
    root: str
    zones_csv: str
    first_period: str = FIRST_PERIOD
    lag_months: int = LAG_MONTHS
    bounds: Bounds = Bounds()
    rules: tuple[Rule, ...] = SILVER_RULES
    marts: tuple[str, ...] = tuple(MARTS)
    files: dict[str, int] = field(default_factory=dict)
    # A backlog of consecutive months is one Spark job up to this many months.
    months_per_job: int = 12
    # False rebuilds every datamart from the trips of all history.
    incremental: bool = True
    # True writes silver and datamarts as versions that a commit record switches;
    # False replaces their folders. A lake keeps the layout it began with.
    versioned: bool = False
    # Database of the external tables and the permanent view; None leaves them out.
    catalog: str | None = "tripmart"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def dataset_frame(spark: SparkSession, datasets: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in datasets], "dataset string")


def plan_run(
    spark: SparkSession,
    lake: Lake,
    as_of: date,
    datasets: Iterable[str] = DATASETS,
    whole_backlog: bool = False,
) -> DataFrame:
    """(dataset, period) still to do: the first missing month each, or all of them."""
    state = registry_state(read_events(spark, lake.table("registry")))
    wanted, day = dataset_frame(spark, datasets), F.lit(as_of)
    if whole_backlog:
        planned = backlog(wanted, state, day, lake.first_period, lake.lag_months)
    else:
        planned = next_missing(
            wanted, state, day, lake.first_period, lake.lag_months
        ).filter("hasWork")
    return planned.select("dataset", "period")


def _spans(periods: list[str], longest: int) -> list[tuple[Span, list[str]]]:
    """Consecutive months together: one scan and one job for all of them."""
    spans: list[tuple[Span, list[str]]] = []
    for period in sorted(periods):
        month = Span.month(parse_period(period))
        span, names = spans[-1] if spans else (None, [])
        if span and span.end == month.start and len(names) < longest:
            spans[-1] = (Span(span.start, month.end), [*names, period])
        else:
            spans.append((month, [period]))
    return spans


_REPORT = (
    "dataset string, period string, evaluated_at string, rule string, actual double, outcome string"
)


def _clean_dataset(
    spark: SparkSession, lake: Lake, dataset: str, periods: list[str], pepper: str
) -> list[str]:
    """Build silver for the landed periods; return the errors.

    A job covers several months, but each month is judged, published and
    recorded on its own, as if it had been built alone.
    """
    errors = []
    for span, names in _spans(periods, lake.months_per_job):
        days = {name: parse_period(name) for name in names}
        try:
            if not lake.versioned:
                forget_parts(spark, lake.table("parts"), dataset, names)
            report = build_silver_months(
                scan_landed(spark, lake.table("bronze"), lake.table("manifest"), dataset, span),
                dataset,
                span,
                [(day.year, day.month) for day in days.values()],
                lake.table("silver/trips"),
                pepper,
                lake.bounds,
                lake.rules,
                lake.files.get(dataset),
                write_gated_versions if lake.versioned else write_gated_months,
            )
            stamp = datetime.now(timezone.utc).isoformat()
            rows, failed = [], {}
            for name, day in days.items():
                for r in report:
                    if (r["year"], r["month"]) == (day.year, day.month):
                        rows.append((dataset, name, stamp, r["rule"], r["actual"], r["outcome"]))
                        if r["outcome"] == "Failed":
                            failed.setdefault(name, []).append(r["rule"])
            # Failed months are reported as well: that is where the reasons are.
            append_rows(spark.createDataFrame(rows, _REPORT), lake.table("quality"))
            errors += [
                f"{dataset} {name}: {len(rules)} quality rule(s) failed: {', '.join(rules)}"
                for name, rules in failed.items()
            ]
        except Exception as error:  # recorded; other datasets go on
            errors.append(f"{dataset} {names[0]}..{names[-1]}: {error}")
            failed = dict.fromkeys(names, [])
        record(
            spark,
            lake.table("registry"),
            "silver",
            [(dataset, name, "FAILED" if name in failed else "DONE", None) for name in names],
        )
    return errors


def read_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    mart = VersionedTable(spark, lake.table(f"gold/{name}"))
    return mart.read() if mart.exists() else spark.read.parquet(mart.root)


def register(spark: SparkSession, lake: Lake) -> None:
    """External tables of silver and the datamarts, and the view of published columns."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {lake.catalog}")
    silver, name = lake.table("silver/trips"), f"{lake.catalog}.silver_trips"
    if lake.versioned:
        point_table(spark, name, silver_table(spark, silver), SILVER)
    else:
        register_silver(spark, silver, name)
    for mart in lake.marts:
        root, entry = lake.table(f"gold/{mart}"), f"{lake.catalog}.gold_{mart}"
        if lake.versioned:
            point_table(spark, entry, VersionedTable(spark, root))
        else:
            register_table(spark, entry, root)
    replace_unified_view(spark, name, f"{lake.catalog}.gold_trips_unified")


def run(
    spark: SparkSession,
    lake: Lake,
    as_of: date,
    datasets: Iterable[str] = DATASETS,
    whole_backlog: bool = False,
    periods: Iterable[tuple[str, str]] | None = None,
) -> list[tuple[str, str]]:
    """Process what is due and return the (dataset, period) pairs done.

    ``periods`` names (dataset, period) pairs to build instead, whether they
    are done or not; a month that has landed is fetched again only if its source
    holds other rows now. The marts are rebuilt on every run, also when nothing
    was due, and only when no dataset failed.
    """
    prepare(spark, FILE_SIZING)
    pepper = configured_pepper(spark)
    silver = lake.table("silver/trips")
    if Folder(spark, silver).glob(f"{PARTITIONS[0]}=*" if lake.versioned else "version=*"):
        raise ValueError(f"{silver} was begun in the other layout")
    if periods is None:
        plan = plan_run(spark, lake, as_of, datasets, whole_backlog)
    else:
        asked = sorted({(check_dataset(d), parse_period(p).strftime("%Y-%m")) for d, p in periods})
        plan = spark.createDataFrame(asked, "dataset string, period string")
    landings = land(
        spark,
        plan,
        lake.source,
        lake.table("bronze"),
        manifest=lake.table("manifest"),
        ledger=lake.table("ledger"),
        refresh=periods is not None,
    )
    if landings:
        record(
            spark,
            lake.table("registry"),
            "bronze",
            [
                (x.dataset, x.period, "DONE" if x.ok else "FAILED", x.detail if x.ok else None)
                for x in landings
            ],
        )
    errors = [f"{x.dataset} {x.period}: {x.detail}" for x in landings if not x.ok]

    landed: dict[str, list[str]] = {}
    for x in landings:
        if x.ok:
            landed.setdefault(x.dataset, []).append(x.period)
    for more in in_parallel(
        spark,
        lambda item: _clean_dataset(spark, lake, item[0], item[1], pepper),
        list(landed.items()),
        3,
    ):
        errors += more
    if errors:
        raise RunFailed("; ".join(errors))

    if not Folder(spark, silver).exists():
        return []  # nothing has ever been due
    if lake.versioned and not silver_table(spark, silver).exists():
        return []  # nothing has passed its gate yet
    trips = unified_trips(spark, silver)
    publish_view(trips)
    zones = checked(read_zones(spark, lake.zones_csv))
    parts = None
    if lake.incremental and lake.versioned:
        parts = refresh_versioned_parts(spark, silver_table(spark, silver), lake.table("parts"))
    elif lake.incremental:
        parts = refresh_parts(spark, silver, lake.table("parts"))
    build_marts(spark, trips, zones, lake.table("gold"), lake.marts, parts, lake.versioned)
    if lake.catalog:
        register(spark, lake)
    return sorted((x.dataset, x.period) for x in landings)
