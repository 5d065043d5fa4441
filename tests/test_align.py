import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.operators.align import align, lower_names, union_aligned
from tripmart.schema import DATASETS, TRIP
from tripmart.sources import derived


def hired(spark, **changes):
    base = {
        "pickup_datetime": "TIMESTAMP_NTZ '2024-03-10 08:00:00.9'",
        "dropoff_datetime": "TIMESTAMP_NTZ '2024-03-10 08:00:02.1'",
        "PULocationID": "1L",
        "DOLocationID": "2L",
        "trip_miles": "2.5D",
        "trip_time": "CAST(NULL AS BIGINT)",
        "base_passenger_fare": "10D",
        "tolls": "1D",
        "bcf": "0.5D",
        "sales_tax": "0.25D",
        "congestion_surcharge": "2D",
        "airport_fee": "CAST(NULL AS DOUBLE)",
        "tips": "3D",
        "driver_pay": "7D",
        "dispatching_base_num": "'B1'",
        "originating_base_num": "CAST(NULL AS STRING)",
        "hvfhs_license_num": "'HV1'",
        **changes,
    }
    return spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in base.items()))


def test_schema_is_canonical_for_every_dataset(spark):
    for dataset in DATASETS:
        out = align(derived.raw_lines(spark, SMALL, dataset), dataset)
        assert [(f.name, f.dataType) for f in out.schema] == [
            (f.name, f.dataType) for f in TRIP
        ]


def test_missing_columns_are_null(spark):
    green = align(derived.raw_lines(spark, SMALL, "green"), "green")
    counts = green.agg(*[F.count(c).alias(c) for c in ("airport_fee", "driver_pay")]).first()
    assert tuple(counts) == (0, 0)
    assert align(hired(spark), "fhvhv").first().payment_type is None


def test_older_file_without_optional_column(spark):
    assert align(hired(spark).drop("airport_fee"), "fhvhv").first().total_amount == 16.75


def test_missing_mandatory_column_is_an_error(spark):
    with pytest.raises(ValueError, match="trip_miles"):
        align(hired(spark).drop("trip_miles"), "fhvhv")


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="purple"):
        align(hired(spark), "purple")


def test_total_is_sum_of_seven_parts(spark):
    assert align(hired(spark), "fhvhv").first().total_amount == 16.75
    assert align(hired(spark, airport_fee="2.5D"), "fhvhv").first().total_amount == 19.25


@pytest.mark.parametrize(
    "part", ["base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "tips"]
)
def test_total_is_null_when_a_part_is(spark, part):
    row = align(hired(spark, **{part: "CAST(NULL AS DOUBLE)"}), "fhvhv").first()
    assert row.total_amount is None


def test_duration_given_or_from_whole_seconds(spark):
    # 00.9 -> 02.1 is two whole seconds apart: both sides are cut off first
    assert align(hired(spark), "fhvhv").first().trip_duration_sec == 2.0
    assert align(hired(spark, trip_time="77L"), "fhvhv").first().trip_duration_sec == 77.0


def test_duration_across_clock_change(spark):
    row = align(
        hired(
            spark,
            pickup_datetime="TIMESTAMP_NTZ '2024-03-10 01:30:00'",
            dropoff_datetime="TIMESTAMP_NTZ '2024-03-10 03:30:00'",
        ),
        "fhvhv",
    ).first()
    assert row.trip_duration_sec == 7200.0


def test_values_that_do_not_fit_become_null(spark):
    raw = derived.raw_lines(spark, SMALL, "yellow").limit(1)
    cases = {"1.7D": 1, "3e10D": None, "'many'": None, "'4'": 4}
    for given, expected in cases.items():
        out = align(raw.withColumn("passenger_count", F.expr(given)), "yellow").first()
        assert out.passenger_count == expected


def test_names_are_case_insensitive(spark):
    raw = hired(spark)
    upper = raw.toDF(*[c.upper() for c in raw.columns])
    assert align(upper, "fhvhv").collect() == align(raw, "fhvhv").collect()
    assert lower_names(upper).columns == [c.lower() for c in raw.columns]


def test_union_keeps_everything(spark):
    parts = [align(derived.raw_lines(spark, SMALL, d), d) for d in DATASETS]
    assert union_aligned(parts).count() == sum(p.count() for p in parts)
