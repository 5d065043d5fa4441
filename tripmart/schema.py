"""Fixed schemas of the trip tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed value: the datasets.
DATASETS = ("yellow", "green", "fhvhv")

# Canonical column order and types.
TRIP = T.StructType(
    [
        T.StructField("service_type", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("trip_duration_sec", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("driver_pay", T.DoubleType()),
        T.StructField("dispatching_base_num", T.StringType()),
        T.StructField("originating_base_num", T.StringType()),
        T.StructField("hvfhs_license_num", T.StringType()),
    ]
)

# Fixed value: columns that are pseudonymised.
IDENTIFIERS = ("dispatching_base_num", "originating_base_num", "hvfhs_license_num")

# Fixed value: columns every trip needs.
MANDATORY = (
    "pickup_datetime",
    "dropoff_datetime",
    "trip_distance",
    "trip_duration_sec",
    "total_amount",
    "pu_location_id",
    "do_location_id",
)

# Fixed value: partition columns of silver.
PARTITIONS = ("service_type", "year", "month")

# Silver files: the canonical columns plus the two derived partition columns.
SILVER = T.StructType(
    [
        *TRIP.fields,
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# Fixed value: columns that may leave silver; everything else is minimised away.
UNIFIED = (
    "service_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "trip_distance",
    "trip_duration_sec",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "driver_pay",
    "payment_type",
    "year",
    "month",
)

ZONE = T.StructType(
    [
        T.StructField("locationid", T.LongType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
    ]
)

REGISTRY_EVENT = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def check_dataset(dataset: str) -> str:
    """Return a known dataset name or raise."""
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}, expected one of {DATASETS}")
    return dataset
