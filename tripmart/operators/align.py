"""Bring any raw dataset to the canonical trip schema in one projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schema import MANDATORY, TRIP, check_dataset


@dataclass(frozen=True)
class RawShape:
    """How one raw dataset maps to canonical columns.

    ``own`` columns keep their name, ``renamed`` maps canonical to raw names,
    ``derived`` is computed from several raw columns. A canonical column in
    none of the three is a typed NULL.
    """

    own: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def raw_name(self, canonical: str) -> str | None:
        return canonical if canonical in self.own else self.renamed.get(canonical)


def null_strict_sum(*terms: str | Column) -> Column:
    """Left-to-right sum that is NULL as soon as one term is NULL."""
    return reduce(add, [F.col(t) if isinstance(t, str) else t for t in terms])


_ZONES = {"pu_location_id": "pulocationid", "do_location_id": "dolocationid"}


def _metered(prefix: str, *extra: str) -> RawShape:
    return RawShape(
        own=(
            "passenger_count",
            "trip_distance",
            "fare_amount",
            "tip_amount",
            "tolls_amount",
            "total_amount",
            "congestion_surcharge",
            "payment_type",
            *extra,
        ),
        renamed={
            "pickup_datetime": f"{prefix}_pickup_datetime",
            "dropoff_datetime": f"{prefix}_dropoff_datetime",
            **_ZONES,
        },
    )


# Raw columns of each dataset.
SHAPES: dict[str, RawShape] = {
    "yellow": _metered("tpep", "airport_fee"),
    "green": _metered("lpep"),
    "fhvhv": RawShape(
        own=(
            "pickup_datetime",
            "dropoff_datetime",
            "congestion_surcharge",
            "airport_fee",
            "driver_pay",
            "dispatching_base_num",
            "originating_base_num",
            "hvfhs_license_num",
        ),
        renamed={
            **_ZONES,
            "trip_distance": "trip_miles",
            "trip_duration_sec": "trip_time",
            "fare_amount": "base_passenger_fare",
            "tip_amount": "tips",
            "tolls_amount": "tolls",
        },
        derived={
            # No total in the raw file: the price paid is the sum of its parts,
            # of which only the airport fee may be missing.
            "total_amount": lambda: null_strict_sum(
                "base_passenger_fare",
                "tolls",
                "bcf",
                "sales_tax",
                "congestion_surcharge",
                F.coalesce("airport_fee", F.lit(0.0)),
                "tips",
            )
        },
    ),
}


def lower_names(df: DataFrame) -> DataFrame:
    """Raw files differ in the case of their column names."""
    return df.toDF(*[name.lower() for name in df.columns])


def _fit(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast; where the value may not fit, a bad one becomes NULL, not an error."""
    if have == want:
        return column
    widens = isinstance(want, T.DoubleType) and isinstance(have, T.NumericType)
    if widens or isinstance(have, T.NullType):
        return column.cast(want)
    return column.try_cast(want)


def _with_optional_columns(raw: DataFrame, dataset: str, shape: RawShape) -> DataFrame:
    """Older files lack some columns: add them as NULL, unless no trip can do
    without them."""
    absent = {}
    for target in TRIP.fields:
        name = shape.raw_name(target.name)
        if name is None or name in raw.columns:
            continue
        if target.name in MANDATORY and target.name != "trip_duration_sec":
            raise ValueError(f"{dataset}: raw column {name} is missing")
        absent[name] = F.lit(None).cast(target.dataType)
    return raw.withColumns(absent) if absent else raw


def align(raw: DataFrame, dataset: str) -> DataFrame:
    shape = SHAPES[check_dataset(dataset)]
    raw = _with_optional_columns(lower_names(raw), dataset, shape)
    types = {f.name: f.dataType for f in raw.schema.fields}

    def canonical(target: T.StructField) -> Column:
        if target.name == "service_type":
            return F.lit(dataset)
        if target.name in shape.derived:
            return shape.derived[target.name]().cast(target.dataType)
        name = shape.raw_name(target.name)
        if name is None:
            return F.lit(None).cast(target.dataType)
        return _fit(F.col(name), types[name], target.dataType)

    projected = raw.select(*[canonical(t).alias(t.name) for t in TRIP.fields])
    elapsed = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    return projected.withColumn(
        "trip_duration_sec", F.coalesce("trip_duration_sec", elapsed.cast("double"))
    )


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
