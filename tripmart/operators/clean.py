"""Validity rules, period bounds and removal of repeated trips."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.periods import next_month
from tripmart.operators.align import SHAPES, lower_names
from tripmart.schema import MANDATORY


@dataclass(frozen=True)
class Bounds:
    """Limits a valid trip has to keep."""

    max_duration_sec: float = 86_400
    max_distance: float = 200
    first_zone: int = 1
    last_zone: int = 265
    # NaN compares above every number, so NaN money would pass ``>= 0`` and
    # then poison every sum it is part of. False keeps such rows.
    reject_nan: bool = True


@dataclass(frozen=True)
class Span:
    """Half-open range of months ``[start, end)`` on the pickup time."""

    start: date
    end: date

    @classmethod
    def month(cls, first: date) -> Span:
        return cls(first, next_month(first))

    @property
    def single_month(self) -> bool:
        return self.end == next_month(self.start)


def _instant(day: date) -> Column:
    # Text, not a Python datetime: that would be read in the driver's zone.
    return F.lit(day.isoformat()).cast("timestamp")


def validity(span: Span | None, bounds: Bounds = Bounds()) -> dict[str, Column]:
    """Named predicates; a row is valid when every one of them is true."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    rules = {f"{name}_present": F.col(name).isNotNull() for name in MANDATORY}
    if span is not None:
        rules["pickup_in_period"] = (pickup >= _instant(span.start)) & (
            pickup < _instant(span.end)
        )
    rules["chronology"] = dropoff > pickup
    for name, column, top in (
        ("duration_range", "trip_duration_sec", bounds.max_duration_sec),
        ("distance_range", "trip_distance", bounds.max_distance),
    ):
        rules[name] = (F.col(column) > 0) & (F.col(column) <= top)
    for name in ("fare_amount", "total_amount"):
        paid = F.col(name)
        floor = paid >= 0
        rules[f"{name}_not_negative"] = (
            floor & ~F.isnan(paid) if bounds.reject_nan else floor
        )
    for name in ("pu_location_id", "do_location_id"):
        rules[f"{name}_known"] = F.col(name).between(bounds.first_zone, bounds.last_zone)
    return rules


def keep_valid(aligned: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return aligned.filter(reduce(and_, rules.values()))


def raw_zone_guard(raw: DataFrame, dataset: str, bounds: Bounds) -> DataFrame:
    """Repeat the zone bounds on integer raw columns.

    Narrowing casts stop a predicate from reaching the Parquet scan; on an
    integer column the same bound holds before the cast, so row groups can be
    skipped. Other types may round into the range and are left to the cleaning.
    """
    raw = lower_names(raw)
    types = {f.name: f.dataType for f in raw.schema.fields}
    for canonical in ("pu_location_id", "do_location_id"):
        name = SHAPES[dataset].raw_name(canonical)
        if isinstance(types.get(name), T.IntegralType):
            raw = raw.filter(
                F.col(name).between(bounds.first_zone, bounds.last_zone)
            )
    return raw


def drop_repeats(trips: DataFrame) -> DataFrame:
    """One row per distinct canonical trip.

    Grouping on all columns is combined inside each map task first, so however
    often a row is repeated, a task sends it on only once.
    """
    return trips.dropDuplicates()


def reject_report(aligned: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows failing each predicate, plus rows seen and kept, in one pass."""
    failed = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(name)
        for name, rule in rules.items()
    ]
    kept = F.coalesce(reduce(and_, rules.values()), F.lit(False))
    counted = aligned.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(kept).alias("rows_kept"), *failed
    )
    names = counted.columns
    return counted.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("predicate"), F.col(n).alias("nb_rows"))
                    for n in names
                ]
            )
        ).alias("line")
    ).select("line.predicate", "line.nb_rows")
