"""Building the datamarts, from all trips or from monthly parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tripmart.functions.periods import parse_period
from tripmart.operators.marts import MARTS
from tripmart.operators.parts import MARTS_FROM_PARTS, PARTS
from tripmart.schema import PARTITIONS, SILVER, UNIFIED
from tripmart.session import in_parallel
from tripmart.sources.files import Folder
from tripmart.sources.lake import materialise, overwrite_partitions
from tripmart.sources.versions import VersionedTable
from tripmart.sources.zones import Zones

_MONTHS = "/".join(f"{key}=*" for key in PARTITIONS)


def forget_parts(
    spark: SparkSession, root: str, dataset: str, periods: Iterable[str]
) -> None:
    """Remove the parts of months about to be written again.

    Done before silver changes: a run that stops in between leaves months
    without parts, which the next refresh fills in, never outdated parts.
    """
    for period in periods:
        day = parse_period(period)
        for name in PARTS:
            Folder(spark, f"{root}/{name}").delete(
                f"service_type={dataset}/year={day.year}/month={day.month}"
            )


def _same_types(spark: SparkSession, path: str, name: str) -> bool:
    wanted = PARTS[name](spark.createDataFrame([], SILVER).select(*UNIFIED)).schema
    have = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    return all(have.get(f.name) == f.dataType for f in wanted.fields)


def refresh_parts(spark: SparkSession, silver: str, root: str) -> dict[str, DataFrame]:
    """Compute the parts of every silver month that has none, in one job each."""
    months = set(Folder(spark, silver).glob(_MONTHS))

    def fill(name: str) -> None:
        folder = Folder(spark, f"{root}/{name}")
        have = set(folder.glob(_MONTHS))
        if have and not _same_types(spark, folder.path, name):
            # Written by an earlier release with other types: all are computed anew.
            for month in have:
                folder.delete(month)
            have = set()
        for gone in have - months:
            folder.delete(gone)
        missing = sorted(months - have)
        if missing:
            trips = (
                spark.read.schema(SILVER)
                .option("basePath", silver)
                .parquet(*[f"{silver}/{month}" for month in missing])
                .select(*UNIFIED)
            )
            part = PARTS[name](trips).hint("rebalance", *PARTITIONS)
            overwrite_partitions(part, folder.path, *PARTITIONS)

    in_parallel(spark, fill, PARTS, len(PARTS))
    return {name: spark.read.parquet(f"{root}/{name}") for name in PARTS}


def refresh_versioned_parts(
    spark: SparkSession, silver: VersionedTable, root: str
) -> dict[str, DataFrame]:
    """Parts of the current silver version of every month.

    A part is kept with the silver version it was computed from, so a month
    that was written again, by whomever, is noticed and computed anew.
    """
    wanted = {part: version for part, (version, _) in silver.current().items()}

    def fill(name: str) -> DataFrame:
        table = VersionedTable(spark, f"{root}/{name}", PARTITIONS)
        since, own = table.head(), table.current()
        if gone := set(own) - set(wanted):
            since = table.commit(None, gone, since)
        stale = sorted(part for part, version in wanted.items() if own.get(part, (None, None))[1] != version)
        if stale:
            trips = (
                spark.read.schema(SILVER)
                .option("basePath", silver.root)
                .parquet(*[silver.folder(wanted[part], part) for part in stale])
                .select(*UNIFIED)
            )
            version = table.stage(PARTS[name](trips).hint("rebalance", *PARTITIONS))
            made = set(table.parts_of(version))
            # A month may have no trip that counts; what it had before goes.
            if empty := set(stale) & set(own) - made:
                since = table.commit(None, empty, since)
            if made:
                table.commit(version, made, since, sources=wanted)
        return table.read() if table.exists() and table.current() else PARTS[name](silver.read(SILVER).select(*UNIFIED))

    names = list(PARTS)
    return dict(zip(names, in_parallel(spark, fill, names, len(names))))


def build_marts(
    spark: SparkSession,
    trips: DataFrame,
    zones: Zones,
    root: str,
    names: Iterable[str],
    parts: dict[str, DataFrame] | None = None,
    versioned: bool = False,
) -> None:
    """Replace the named datamarts, four at a time; versioned ones by a commit record."""

    def build(name: str) -> None:
        if parts is not None and name in MARTS_FROM_PARTS:
            mart = MARTS_FROM_PARTS[name](parts, zones)
        else:
            mart = MARTS[name](trips, zones)
        if versioned:
            VersionedTable(spark, f"{root}/{name}").publish(mart)
        else:
            materialise(mart, f"{root}/{name}")

    in_parallel(spark, build, list(names), 4)
