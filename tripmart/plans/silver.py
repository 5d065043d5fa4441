"""From raw scans to one gated silver month (or several at once)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row

from tripmart.functions.privacy import pseudonymise
from tripmart.operators.align import align, union_aligned
from tripmart.operators.clean import (
    Bounds,
    Span,
    drop_repeats,
    keep_valid,
    raw_zone_guard,
    validity,
)
from tripmart.operators.quality import SILVER_RULES, Rule
from tripmart.schema import IDENTIFIERS
from tripmart.sources.lake import arrange, with_partitions, write_gated, write_gated_months


def silver_trips(
    raw: list[DataFrame],
    dataset: str,
    span: Span | None,
    pepper: str,
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """Aligned, valid, distinct and pseudonymised trips of a span of months.

    Repeats are removed before hashing: fewer rows to hash, and rows that only
    differ in unmapped raw columns collapse. The one shuffle is the dedup.
    """
    aligned = union_aligned([align(raw_zone_guard(r, dataset, bounds), dataset) for r in raw])
    distinct = drop_repeats(keep_valid(aligned, validity(span, bounds)))
    return with_partitions(pseudonymise(distinct, IDENTIFIERS, pepper))


def build_silver(
    raw: list[DataFrame],
    dataset: str,
    span: Span | None,
    target: str,
    pepper: str,
    bounds: Bounds = Bounds(),
    rules: tuple[Rule, ...] = SILVER_RULES,
    files: int | None = None,
) -> DataFrame:
    """Write the span's silver partitions and return the rule table."""
    trips = silver_trips(raw, dataset, span, pepper, bounds)
    return write_gated(arrange(trips, span, files), target, rules)


def build_silver_months(
    raw: list[DataFrame],
    dataset: str,
    span: Span,
    months: list[tuple[int, int]],
    target: str,
    pepper: str,
    bounds: Bounds = Bounds(),
    rules: tuple[Rule, ...] = SILVER_RULES,
    files: int | None = None,
    write: Callable[..., list[Row]] = write_gated_months,
) -> list[Row]:
    """Build the span in one job; every month passes or fails the gate alone."""
    trips = silver_trips(raw, dataset, span, pepper, bounds)
    return write(arrange(trips, span, files), target, months, rules)
