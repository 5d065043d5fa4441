"""Trips, zones and registry derived from the supplied star-schema tables.

They stand in for monthly trip files, so that every operator runs over whole
tables of any size. Money is DECIMAL in the ready-made trips: its sums do not
depend on the order in which rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.clean import Bounds
from tripmart.schema import DATASETS, check_dataset

# Stand-in limits: durations are days and distances quantities of 1 to 50.
LINE_BOUNDS = Bounds(
    max_duration_sec=1000 * 86_400.0, max_distance=45, first_zone=1, last_zone=25
)
FLAG = {"yellow": "A", "green": "N", "fhvhv": "R"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs.

    The last nation has a zone id that no trip uses, so that its trips are unmapped.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.when(F.col("n_nationkey") < 24, F.col("n_nationkey") + 1).otherwise(265).cast("long").alias("locationid"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone"),
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with both nations. Joins carry no hints: every side grows
    with the data, so size statistics and AQE choose the strategy. Orders meet
    their customers first, so that the wide lines are shuffled by order only."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return (
        line.join(orders.join(customer, orders.o_custkey == customer.c_custkey), line.l_orderkey == orders.o_orderkey)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumns(
            {
                # Whole cents and per cents: exact products without a decimal
                # object per row.
                "cents": F.rint(F.col("l_extendedprice") * 100).cast("long"),
                "off": F.rint(F.col("l_discount") * 100).cast("long"),
                "levy": F.rint(F.col("l_tax") * 100).cast("long"),
                "pu": (F.col("c_nationkey") + 1).cast("long"),
                "do": (F.col("s_nationkey") + 1).cast("long"),
            }
        )
    )


def _service(flag: Column) -> Column:
    name = F.when(flag == "A", "yellow").when(flag == "N", "green")
    return name.when(flag == "R", "fhvhv")


def _money(units: Column, scale: int) -> Column:
    """Exact decimal from a whole number of units of ``10 ** -scale``."""
    step = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
    return units.cast("decimal(18,0)") * step


def line_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid trips of all services over the whole order history."""
    cents, off, levy = F.col("cents"), F.col("off"), F.col("levy")
    total = _money(cents * (100 - off) * (100 + levy), 6)
    pay = F.when(F.col("l_returnflag") == "R", _money(cents * 75, 4))
    pickup = F.col("o_orderdate").cast("timestamp")
    dropoff = F.col("l_shipdate").cast("timestamp")
    trips = _lines(spark, sf_dir).select(
        _service(F.col("l_returnflag")).alias("service_type"),
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        F.col("pu").cast("int").alias("pu_location_id"),
        F.col("do").cast("int").alias("do_location_id"),
        F.col("l_quantity").alias("trip_distance"),
        (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup))
        .cast("double")
        .alias("trip_duration_sec"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("fare_amount"),
        _money(cents * off, 4).alias("tip_amount"),
        total.alias("total_amount"),
        pay.alias("driver_pay"),
    )
    return trips.filter(
        (F.col("dropoff_datetime") > F.col("pickup_datetime"))
        & (F.col("trip_distance") > 0)
        & (F.col("trip_distance") <= LINE_BOUNDS.max_distance)
        & F.col("pu_location_id").between(1, 25)
        & F.col("do_location_id").between(1, 25)
    )


def raw_lines(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Order lines of one service in the shape of its raw monthly files."""
    lines = _lines(spark, sf_dir).filter(
        F.col("l_returnflag") == FLAG[check_dataset(dataset)]
    )
    zero = F.lit(0.0)
    tip = F.col("cents") * F.col("off") / 10_000.0
    tax = F.col("cents") * F.col("levy") / 10_000.0
    places = [F.col("pu").alias("PULocationID"), F.col("do").alias("DOLocationID")]
    if dataset == "fhvhv":
        first = F.col("l_linenumber") == 1
        base = F.concat(F.lit("B"), F.col("l_suppkey").cast("string"))
        return lines.select(
            F.concat(F.lit("HV"), (F.col("l_partkey") % 4).cast("string")).alias(
                "hvfhs_license_num"
            ),
            base.alias("dispatching_base_num"),
            F.when(~first, base).alias("originating_base_num"),
            F.col("o_orderdate").alias("pickup_datetime"),
            F.col("l_shipdate").alias("dropoff_datetime"),
            *places,
            F.col("l_quantity").alias("trip_miles"),
            F.lit(None).cast("long").alias("trip_time"),
            F.col("l_extendedprice").alias("base_passenger_fare"),
            zero.alias("tolls"),
            zero.alias("bcf"),
            tax.alias("sales_tax"),
            zero.alias("congestion_surcharge"),
            F.lit(None).cast("double").alias("airport_fee"),
            tip.alias("tips"),
            (F.col("cents") * 75 / 10_000.0).alias("driver_pay"),
            F.col("l_linestatus").alias("shared_request_flag"),
        )
    prefix = "tpep" if dataset == "yellow" else "lpep"
    columns = [
        (F.col("l_partkey") % 2).alias("VendorID"),
        F.col("o_orderdate").alias(f"{prefix}_pickup_datetime"),
        F.col("l_shipdate").alias(f"{prefix}_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        *places,
        (F.col("l_linenumber") % 6).cast("long").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        tip.alias("tip_amount"),
        zero.alias("tolls_amount"),
        (F.col("l_extendedprice") + tax).alias("total_amount"),
        zero.alias("congestion_surcharge"),
    ]
    if dataset == "yellow":
        columns.append(zero.alias("Airport_fee"))
    return lines.select(*columns)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with hours, from the event log."""
    kind = F.col("event_type")
    service = F.when(kind == "click", "yellow").when(kind == "view", "green").otherwise("fhvhv")
    pickup = F.col("ts").cast("timestamp")
    seconds = (F.col("event_id") % 61) * 60
    fare = F.col("value").cast("decimal(12,2)")
    return table(spark, sf_dir, "events").select(
        service.alias("service_type"),
        pickup.alias("pickup_datetime"),
        F.timestamp_add("SECOND", seconds, pickup).alias("dropoff_datetime"),
        ((F.col("user_id") % 5) * 6 + 1).cast("int").alias("pu_location_id"),
        (F.col("event_id") % 25 + 1).cast("int").alias("do_location_id"),
        ((F.col("event_id") % 90) / 2.0).alias("trip_distance"),
        seconds.cast("double").alias("trip_duration_sec"),
        fare.alias("fare_amount"),
        (fare * F.lit("0.10").cast("decimal(3,2)")).alias("tip_amount"),
        (fare * F.lit("1.10").cast("decimal(3,2)")).alias("total_amount"),
        F.lit(None).cast("decimal(12,2)").alias("driver_pay"),
    )


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, day) for every month that has orders."""
    services = F.explode(F.array(*[F.lit(d) for d in DATASETS])).alias("dataset")
    months = table(spark, sf_dir, "orders").select(
        F.to_date(F.trunc("o_orderdate", "MM")).alias("day")
    )
    return months.distinct().select(services, "day")


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing and silver events of the order months.

    Months up to 1998-05 have landed. Earlier ones are done, green failed in
    1998-05, and yellow landed once more in 1998-04 before its last silver run.
    """
    period, dataset = F.date_format("day", "yyyy-MM"), F.col("dataset")
    cut = F.lit("1998-05")
    again = (period == "1998-04") & (dataset == "yellow")

    def event(when: Column, stage: str, status: str, detail: str | None, days: int) -> Column:
        at = F.timestamp_add("DAY", F.lit(days), F.col("day").cast("timestamp"))
        return F.when(
            when,
            F.struct(
                F.lit(stage).alias("stage"),
                F.lit(status).alias("status"),
                F.lit(detail).cast("string").alias("detail"),
                at.alias("at"),
            ),
        )

    events = F.array_compact(
        F.array(
            event(period <= cut, "bronze", "DONE", "ingested", 40),
            event(period < cut, "silver", "DONE", None, 41),
            event((period == cut) & (dataset == "green"), "silver", "FAILED", None, 41),
            event(again, "bronze", "DONE", "skipped", 42),
            event(again, "silver", "DONE", None, 43),
        )
    )
    return (
        order_months(spark, sf_dir)
        .select("dataset", period.alias("period"), F.explode(events).alias("event"))
        .select("dataset", "period", "event.*")
    )
