"""Sums of doubles that do not depend on order, and the one pass behind sums and median."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.functions.measures import exact_sum, size_bucket
from tripmart.operators.marts import MARTS
from tripmart.operators.parts import MARTS_FROM_PARTS, PARTS
from tripmart.schema import UNIFIED
from tripmart.sources import derived
from tripmart.sources.lake import with_partitions
from tripmart.sources.zones import checked


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_sums_of_doubles_are_exact_in_any_order(spark):
    draw = random.Random(3)
    values = [round(draw.uniform(-500, 5000), 2) for _ in range(3000)] + [0.1] * 10 + [1e15, -1e15, 8.9e12, 9.1e12, -3.25]
    exact = sum(Decimal(repr(v)) for v in values)
    for seed in range(3):
        draw.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(1 + 3 * seed)
        assert frame.agg(exact_sum(frame, "v")).first()[0] == exact


def test_nulls_and_what_is_no_number(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([("a", None), ("b", 1.5), ("b", None), ("c", nan), ("c", 2.0), ("d", inf)], "k string, v double")
    got = dict(map(tuple, frame.groupBy("k").agg(exact_sum(frame, "v")).collect()))
    assert got == {"a": None, "b": Decimal("1.5"), "c": Decimal(2), "d": None}


def test_decimals_and_whole_numbers_are_added_as_they_are(spark):
    frame = spark.createDataFrame([(Decimal("1.10"), 3), (Decimal("2.20"), 4)], "d decimal(12,2), n bigint")
    assert tuple(frame.agg(exact_sum(frame, "d"), exact_sum(frame, "n")).first()) == (Decimal("3.30"), 7)


@pytest.fixture(scope="module")
def silver(spark):
    """Trips with doubles that no binary fraction holds."""
    cents = derived.line_trips(spark, SMALL)
    money = {c: (F.col(c).cast("double") / 3) for c in ("fare_amount", "tip_amount", "total_amount", "driver_pay", "trip_distance")}
    return with_partitions(cents.withColumns(money).withColumn("payment_type", F.lit(1))).select(*UNIFIED).cache()


@pytest.mark.parametrize("name", sorted(MARTS))
def test_marts_are_the_same_under_any_partitioning(spark, silver, name):
    zones = checked(derived.zones(spark, SMALL))
    first = None
    for parts in (1, 4, 9):
        dealt = silver.repartition(parts, F.rand(parts))
        found = rows(MARTS[name](dealt, zones, k=1))
        again = rows(MARTS_FROM_PARTS[name]({n: build(dealt) for n, build in PARTS.items()}, zones, k=1))
        first = first or found
        assert found == first == again


def test_buckets_never_fall(spark):
    values = [-1e12, -5.0, -4.999, -0.001, -1e-300, 0.0, 1e-300, 0.001, 0.99, 1.0, 1.01, 2.0, 19.99, 20.0, 1e12, 1e300]
    frame = spark.createDataFrame([(v,) for v in values], "v double").withColumn("b", size_bucket(F.col("v"))).orderBy("v")
    buckets = [r["b"] for r in frame.collect()]
    assert buckets == sorted(buckets) and len(set(buckets)) == 13


def test_services_scan_the_trips_once(spark):
    """Sums and median come from one set of lines: every table is read once."""
    zones = checked(derived.zones(spark, SMALL))
    mart = MARTS["service_comparison"](derived.line_trips(spark, SMALL), zones)
    mart.collect()
    plan = mart._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    for table in ("lineitem", "orders", "customer", "supplier"):
        assert len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan)) == 1, table
