from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.functions.periods import next_month, parse_period
from tripmart.operators.align import align
from tripmart.operators.clean import (
    Bounds,
    Span,
    drop_repeats,
    keep_valid,
    raw_zone_guard,
    reject_report,
    validity,
)
from tripmart.plans.silver import silver_trips
from tripmart.sources import derived

MARCH = Span.month(parse_period("2024-03"))
NAN = float("nan")


def kept(trips, *changes, bounds=Bounds(), span=MARCH):
    return keep_valid(trips(*changes), validity(span, bounds)).count()


@pytest.mark.parametrize(
    "change, valid",
    [
        ({}, True),
        ({"trip_duration_sec": 0.0}, False),
        ({"trip_duration_sec": 1.0}, True),
        ({"trip_duration_sec": 86400.0}, True),
        ({"trip_duration_sec": 86401.0}, False),
        ({"trip_duration_sec": None}, False),
        ({"trip_duration_sec": NAN}, False),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": 0.01}, True),
        ({"trip_distance": 200.0}, True),
        ({"trip_distance": 200.01}, False),
        ({"trip_distance": None}, False),
        ({"trip_distance": NAN}, False),
        ({"fare_amount": None}, False),
        ({"fare_amount": -0.01}, False),
        ({"fare_amount": 0.0}, True),
        ({"fare_amount": NAN}, False),
        ({"total_amount": None}, False),
        ({"total_amount": -1.0}, False),
        ({"total_amount": NAN}, False),
        ({"pu_location_id": 0}, False),
        ({"pu_location_id": 265}, True),
        ({"pu_location_id": 266}, False),
        ({"do_location_id": None}, False),
        ({"do_location_id": 266}, False),
        ({"passenger_count": None, "tip_amount": None}, True),
        ({"pickup_datetime": None}, False),
        ({"dropoff_datetime": None}, False),
        ({"dropoff_datetime": "2024-03-10 08:00:00"}, False),
        ({"dropoff_datetime": "2024-03-10 07:59:59"}, False),
        ({"dropoff_datetime": "2024-04-02 00:00:00"}, True),
        ({"pickup_datetime": "2024-02-29 23:59:59.999999"}, False),
        ({"pickup_datetime": "2024-03-01 00:00:00"}, True),
        (
            {
                "pickup_datetime": "2024-03-31 23:59:59.999999",
                "dropoff_datetime": "2024-04-01 00:10:00",
            },
            True,
        ),
        (
            {
                "pickup_datetime": "2024-04-01 00:00:00",
                "dropoff_datetime": "2024-04-01 00:10:00",
            },
            False,
        ),
    ],
)
def test_boundaries(trips, change, valid):
    assert kept(trips, change) == int(valid)


def test_nan_money_can_be_let_through(trips):
    assert kept(trips, {"fare_amount": NAN}, bounds=Bounds(reject_nan=False)) == 1


def test_period_arithmetic():
    assert parse_period("2024-12") == date(2024, 12, 1)
    assert next_month(date(2024, 12, 1)) == date(2025, 1, 1)
    assert next_month(date(2024, 1, 1), -1) == date(2023, 12, 1)
    assert next_month(date(2024, 3, 1), -14) == date(2023, 1, 1)
    assert MARCH.single_month and not Span(date(2024, 1, 1), date(2024, 3, 1)).single_month
    with pytest.raises(ValueError):
        parse_period("2024-13")


def test_dedup_on_canonical_columns_with_nulls(trips):
    out = drop_repeats(trips({}, {}, {"tip_amount": None}, {"tip_amount": None}, {"fare_amount": 9.0}))
    assert out.count() == 3
    assert drop_repeats(out).count() == 3


def test_rows_differing_in_unmapped_columns_collapse(spark):
    raw = derived.raw_lines(spark, SMALL, "yellow").limit(3)
    more = raw.unionByName(raw.withColumn("VendorID", F.col("VendorID") + 7))
    once = silver_trips([raw], "yellow", None, "p", derived.LINE_BOUNDS).count()
    assert silver_trips([more], "yellow", None, "p", derived.LINE_BOUNDS).count() == once


def test_dedup_combines_inside_map_tasks(trips):
    plan = drop_repeats(trips({}, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert plan.rindex("HashAggregate") > plan.index("Exchange")


def test_reject_report_counts_each_predicate(trips):
    frame = trips({}, {"trip_distance": None}, {"trip_distance": 300.0, "fare_amount": -1.0})
    got = {r.predicate: r.nb_rows for r in reject_report(frame, validity(MARCH)).collect()}
    assert got["rows_read"] == 3 and got["rows_kept"] == 1
    assert got["trip_distance_present"] == 1 and got["distance_range"] == 2
    assert got["fare_amount_not_negative"] == 1 and got["chronology"] == 0


def test_guard_keeps_rows_that_round_into_the_range(spark):
    whole = derived.raw_lines(spark, SMALL, "yellow").limit(1)
    edge = whole.withColumn("PULocationID", F.lit(265.5))
    assert raw_zone_guard(edge, "yellow", Bounds()).count() == 1
    far = whole.withColumn("PULocationID", F.lit(266).cast("long"))
    assert raw_zone_guard(far, "yellow", Bounds()).count() == 0


def test_silver_scan_gets_period_and_zone_filters(spark, folder):
    derived.raw_lines(spark, SMALL, "fhvhv").write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    out = silver_trips([raw], "fhvhv", Span.month(date(1998, 5, 1)), "p", derived.LINE_BOUNDS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    for wanted in (
        "GreaterThanOrEqual(pickup_datetime,1998-05-01",
        "LessThan(pickup_datetime,1998-06-01",
        "GreaterThanOrEqual(PULocationID,1)",
        "LessThanOrEqual(DOLocationID,25)",
        "LessThanOrEqual(trip_miles,45.0)",
    ):
        assert wanted in plan, (wanted, pushed)
    assert "shared_request_flag" not in plan.split("ReadSchema")[1]
    assert "Python" not in plan


def test_period_of_whole_history(spark):
    aligned = align(derived.raw_lines(spark, SMALL, "fhvhv"), "fhvhv")
    assert aligned.count() == 1968
    month = validity(Span.month(date(1998, 5, 1)), derived.LINE_BOUNDS)
    assert keep_valid(aligned, month).count() == 17
