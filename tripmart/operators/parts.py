"""Datamarts from monthly partial aggregates.

Rebuilding a datamart reads all history. These operators reduce each silver
month once to small sums per location id; the marts are then put together from
the sums of all months. A monthly run reads one month of trips, however long
the history is. The results equal the direct ones: counts, sums and the ratios
taken from them at the end; the median comes from the trips per distinct price.

Sums are kept per location id, not per borough, so a corrected zone lookup
needs no new reading of trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.measures import TRIPS, exact_sum, iso_weekday
from tripmart.functions.privacy import MIN_CELL
from tripmart.operators import marts
from tripmart.schema import PARTITIONS
from tripmart.sources.zones import Zones


def _sums(trips: DataFrame, names: tuple[str, ...]) -> list[Column]:
    return [exact_sum(trips, n).alias(n) for n in names]


def hourly_part(trips: DataFrame) -> DataFrame:
    """Per pickup zone, date and hour, paid trips apart from the others.

    The revenue mart counts paid trips, the demand mart all of them.
    """
    paid = F.coalesce(F.col("total_amount") > 0, F.lit(False)).alias("paid")
    return (
        trips.filter(F.col("trip_duration_sec") > 0)
        .groupBy(
            *PARTITIONS,
            "pu_location_id",
            F.to_date("pickup_datetime").alias("date_course"),
            F.hour("pickup_datetime").alias("heure"),
            paid,
        )
        .agg(F.count(F.lit(1)).alias(TRIPS), *_sums(trips, marts.REVENUE_SUMS))
    )


def route_part(trips: DataFrame) -> DataFrame:
    """Per pickup and dropoff zone, paid trips only."""
    names = tuple(dict.fromkeys((*marts.OD_SUMS, *marts.SERVICE_SUMS)))
    return (
        trips.filter(F.col("total_amount") > 0)
        .groupBy(*PARTITIONS, "pu_location_id", "do_location_id")
        .agg(F.count(F.lit(1)).alias(TRIPS), *_sums(trips, names))
    )


def price_part(trips: DataFrame) -> DataFrame:
    """Trips per distinct price paid in a pickup zone."""
    return (
        trips.filter(F.col("total_amount") > 0)
        .groupBy(*PARTITIONS, "pu_location_id", "total_amount")
        .agg(F.count(F.lit(1)).alias(TRIPS))
    )


PARTS = {"hourly": hourly_part, "route": route_part, "price": price_part}


def revenue_from_parts(parts: dict[str, DataFrame], zones: Zones, k: int = MIN_CELL) -> DataFrame:
    rows = parts["hourly"].filter("paid")
    weekday = iso_weekday(F.col("date_course"))
    return marts.revenue_mart(rows, zones, weekday, F.col("heure"), k, carried=True)


def demand_from_parts(
    parts: dict[str, DataFrame], zones: Zones | None = None, k: int = MIN_CELL
) -> DataFrame:
    day, hour = F.col("date_course"), F.col("heure")
    return marts.demand_mart(parts["hourly"], day, hour, k, carried=True)


def od_from_parts(parts: dict[str, DataFrame], zones: Zones, k: int = MIN_CELL) -> DataFrame:
    return marts.od_mart(parts["route"], zones, k, carried=True)


def services_from_parts(
    parts: dict[str, DataFrame], zones: Zones, k: int = MIN_CELL
) -> DataFrame:
    place = {"pu_location_id": {"borough": "borough"}}
    service = {"service_type": F.col("service_type")}
    sums = marts.sums_by_place(
        parts["route"], zones, place, service, marts.SERVICE_SUMS, carried=True
    )
    return marts.service_mart(marts.with_median(sums, parts["price"], zones), k)


MARTS_FROM_PARTS = {
    "revenue_by_zone_hour": revenue_from_parts,
    "service_comparison": services_from_parts,
    "demand_timeseries": demand_from_parts,
    "od_matrix": od_from_parts,
}
