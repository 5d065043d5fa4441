"""The four datamarts.

Every builder takes the unified trips and the checked zone lookup and returns
a small aggregate. Hot keys need no care here: all measures are combined
inside the map tasks, so a zone holding a third of the trips still reaches the
reducers as one line per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.measures import (
    TRIPS,
    exact_sum,
    iso_weekday,
    lower_median,
    ratio,
    share_of,
    total,
)
from tripmart.functions.privacy import MIN_CELL, suppress_small_cells
from tripmart.sources.zones import Zones


def locate(trips: DataFrame, zones: Zones, id_column: str, **names: str) -> DataFrame:
    """Add zone columns under the given names; unknown ids keep NULL.

    Beyond the broadcast bound this is a shuffle join, whose hot ids AQE splits.
    """
    side = zones.side.select(
        F.col("locationid").alias("_id"),
        *[F.col(source).alias(name) for name, source in names.items()],
    )
    return trips.join(side, F.col(id_column).cast("long") == F.col("_id"), "left").drop("_id")


def _count(carried: bool) -> Column:
    """Number of trips: one a row, or carried along by rows that are sums."""
    return (F.sum(TRIPS) if carried else F.count(F.lit(1))).alias(TRIPS)


def _added(frame: DataFrame, names: tuple[str, ...]) -> list[Column]:
    return [exact_sum(frame, name).alias(name) for name in names]


def sums_by_place(
    trips: DataFrame,
    zones: Zones,
    places: dict[str, dict[str, str]],
    keys: dict[str, Column],
    sums: tuple[str, ...],
    carried: bool = False,
) -> DataFrame:
    """Trip count and sums per place and key.

    With a broadcast lookup the ids become names before grouping, which makes
    fewer groups. Without one, trips are first summed per location id, so that
    the shuffle join only sees that small result.
    """
    names = [name for cols in places.values() for name in cols]
    keyed = [column.alias(name) for name, column in keys.items()]
    if zones.small:
        grouped = trips
        for id_column, cols in places.items():
            grouped = locate(grouped, zones, id_column, **cols)
        return grouped.groupBy(*keyed, *names).agg(_count(carried), *_added(trips, sums))
    grouped = trips.groupBy(*keyed, *places).agg(_count(carried), *_added(trips, sums))
    for id_column, cols in places.items():
        grouped = locate(grouped, zones, id_column, **cols)
    return grouped.groupBy(*keys, *names).agg(_count(True), *_added(grouped, sums))


def _of(name: str) -> Column:
    """A sum already taken, as double."""
    return F.col(name).cast("double")


REVENUE_SUMS = (
    "total_amount",
    "tip_amount",
    "fare_amount",
    "trip_distance",
    "trip_duration_sec",
)


def revenue_by_zone_hour(trips: DataFrame, zones: Zones, k: int = MIN_CELL) -> DataFrame:
    """Revenue per service, pickup zone, ISO weekday and hour."""
    rows = trips.filter((F.col("total_amount") > 0) & (F.col("trip_duration_sec") > 0))
    return revenue_mart(
        rows, zones, iso_weekday(F.col("pickup_datetime")), F.hour("pickup_datetime"), k
    )


def revenue_mart(
    rows: DataFrame,
    zones: Zones,
    weekday: Column,
    hour: Column,
    k: int = MIN_CELL,
    carried: bool = False,
) -> DataFrame:
    keys = {"service_type": F.col("service_type"), "jour_semaine": weekday, "heure": hour}
    place = {"pu_location_id": {"borough": "borough", "zone": "zone"}}
    cells = sums_by_place(rows, zones, place, keys, REVENUE_SUMS, carried)
    n = F.col(TRIPS)
    return suppress_small_cells(cells, k=k).select(
        "service_type",
        "borough",
        "zone",
        "jour_semaine",
        "heure",
        TRIPS,
        _of("total_amount").alias("revenu_total"),
        _of("tip_amount").alias("tip_total"),
        _of("trip_distance").alias("distance_total"),
        _of("trip_duration_sec").alias("duree_total_sec"),
        (_of("total_amount") / n).alias("revenu_moyen"),
        ratio(_of("total_amount"), _of("trip_duration_sec") / 60.0).alias("revenu_par_min"),
        ratio(_of("tip_amount"), _of("fare_amount"), 100.0).alias("tip_pct"),
        (_of("trip_distance") / n).alias("distance_moyenne"),
    )


SERVICE_SUMS = ("total_amount", "tip_amount", "fare_amount", "driver_pay")


def service_comparison(trips: DataFrame, zones: Zones, k: int = MIN_CELL) -> DataFrame:
    """Services side by side in each borough, with their market share.

    Trips are first combined, inside map tasks, per service, pickup zone and
    price; only these lines meet the zones and give sums and median.
    """
    lines = (
        trips.filter(F.col("total_amount") > 0)
        .groupBy("service_type", "pu_location_id", F.col("total_amount").alias("price"))
        .agg(_count(False), *_added(trips, SERVICE_SUMS))
    )
    located = locate(lines, zones, "pu_location_id", borough="borough")
    cells = lower_median(located, ("service_type", "borough"), "price", TRIPS, SERVICE_SUMS)
    return service_mart(cells.withColumnRenamed("median", "panier_median"), k)


def with_median(cells: DataFrame, prices: DataFrame, zones: Zones) -> DataFrame:
    """Service and borough cells with the median of (service, zone, price, trips) lines."""
    located = locate(prices, zones, "pu_location_id", borough="borough")
    median = lower_median(located, ("service_type", "borough"), "total_amount", TRIPS).select(
        F.col("service_type").alias("_service"),
        F.col("borough").alias("_borough"),
        F.col("median").alias("panier_median"),
    )
    same = F.col("service_type").eqNullSafe(F.col("_service")) & F.col("borough").eqNullSafe(
        F.col("_borough")
    )
    return cells.join(median, same).drop("_service", "_borough")


def service_mart(cells: DataFrame, k: int = MIN_CELL) -> DataFrame:
    """Ratios of the cells; shares are taken over the published cells only."""
    driver_share = ratio(_of("driver_pay"), _of("total_amount"), 100.0)
    return suppress_small_cells(cells, k=k).select(
        "service_type",
        "borough",
        TRIPS,
        share_of(TRIPS, "borough").alias("part_marche_pct"),
        "panier_median",
        ratio(_of("tip_amount"), _of("fare_amount"), 100.0).alias("tip_pct"),
        F.when(F.col("service_type") == "fhvhv", driver_share).alias("driver_share_pct"),
    )


def demand_timeseries(
    trips: DataFrame, zones: Zones | None = None, k: int = MIN_CELL
) -> DataFrame:
    """Demand per date, hour and service. Needs no zones."""
    pickup = F.col("pickup_datetime")
    rows = trips.filter(F.col("trip_duration_sec") > 0)
    return demand_mart(rows, F.to_date(pickup), F.hour(pickup), k)


def demand_mart(
    rows: DataFrame, day: Column, hour: Column, k: int = MIN_CELL, carried: bool = False
) -> DataFrame:
    cells = rows.groupBy(day.alias("date_course"), hour.alias("heure"), "service_type").agg(
        _count(carried), *_added(rows, ("trip_distance", "trip_duration_sec"))
    )
    distance, seconds, n = _of("trip_distance"), _of("trip_duration_sec"), F.col(TRIPS)
    return suppress_small_cells(cells, k=k).select(
        "date_course",
        "heure",
        # The weekday follows from the date, so it need not be a grouping key.
        iso_weekday(F.col("date_course")).alias("jour_semaine"),
        "service_type",
        TRIPS,
        (distance / n).alias("distance_moy"),
        (seconds / n).alias("duree_moy_sec"),
        ratio(distance, seconds / 3600.0).alias("vitesse_moy_mph"),
    )


OD_SUMS = ("trip_distance", "total_amount")


def od_matrix(trips: DataFrame, zones: Zones, k: int = MIN_CELL) -> DataFrame:
    """Trips between boroughs."""
    return od_mart(trips.filter(F.col("total_amount") > 0), zones, k)


def od_mart(
    rows: DataFrame, zones: Zones, k: int = MIN_CELL, carried: bool = False
) -> DataFrame:
    places = {
        "pu_location_id": {"pu_borough": "borough"},
        "do_location_id": {"do_borough": "borough"},
    }
    service = {"service_type": F.col("service_type")}
    cells = sums_by_place(rows, zones, places, service, OD_SUMS, carried)
    n = F.col(TRIPS)
    return suppress_small_cells(cells, k=k).select(
        "pu_borough",
        "do_borough",
        "service_type",
        TRIPS,
        (_of("trip_distance") / n).alias("distance_moy"),
        (_of("total_amount") / n).alias("revenu_moy"),
    )


# Adding a datamart means adding a line here.
MARTS: dict[str, Callable[..., DataFrame]] = {
    "revenue_by_zone_hour": revenue_by_zone_hour,
    "service_comparison": service_comparison,
    "demand_timeseries": demand_timeseries,
    "od_matrix": od_matrix,
}


def roll_up_revenue(mart: DataFrame, *keys: str) -> DataFrame:
    """Coarser grain of the revenue mart: sums are added, ratios taken anew."""
    n, revenue, seconds = F.sum(TRIPS), total(mart, "revenu_total"), total(mart, "duree_total_sec")
    distance = total(mart, "distance_total")
    return mart.groupBy(*keys).agg(
        n.alias(TRIPS),
        revenue.alias("revenu_total"),
        total(mart, "tip_total").alias("tip_total"),
        distance.alias("distance_total"),
        seconds.alias("duree_total_sec"),
        (revenue / n).alias("revenu_moyen"),
        ratio(revenue, seconds / 60.0).alias("revenu_par_min"),
        (distance / n).alias("distance_moyenne"),
    )
