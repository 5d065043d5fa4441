import os
import sys
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from tripmart.session import prepare

    yield prepare(session)
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


TRIP_DEFAULTS = {
    "service_type": "yellow",
    "pickup_datetime": "2024-03-10 08:00:00",
    "dropoff_datetime": "2024-03-10 08:10:00",
    "pu_location_id": 1,
    "do_location_id": 2,
    "passenger_count": 1,
    "trip_distance": 2.0,
    "trip_duration_sec": 600.0,
    "fare_amount": 10.0,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "total_amount": 12.0,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
    "payment_type": 1,
    "driver_pay": None,
    "dispatching_base_num": None,
    "originating_base_num": None,
    "hvfhs_license_num": None,
}


def moment(text):
    return None if text is None else datetime.fromisoformat(text)


def text_frame(spark, rows, schema):
    """Rows with timestamps given as text, cast by Spark in the session zone."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    loose = T.StructType(
        [
            T.StructField(
                f.name,
                T.StringType() if f.dataType.typeName().startswith("timestamp") else f.dataType,
            )
            for f in schema.fields
        ]
    )
    frame = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], loose)
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@pytest.fixture
def trips(spark):
    from tripmart.schema import TRIP

    def make(*changes):
        return text_frame(spark, [{**TRIP_DEFAULTS, **c} for c in changes], TRIP)

    return make


@pytest.fixture
def zones(spark):
    from tripmart.schema import ZONE
    from tripmart.sources.zones import checked

    rows = [
        (1, "Queens", "JFK Airport"),
        (2, "Queens", "LaGuardia Airport"),
        (3, "Bronx", "Belmont"),
        (4, "Bronx", "Norwood"),
    ]
    return checked(spark.createDataFrame(rows, ZONE))
