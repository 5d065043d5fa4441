"""Parametrised queries over the datamarts.

Parameters become literals of typed comparisons, never parts of a query text.
Sort orders end in the grouping keys, so that a limit always cuts at the same
row.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.measures import TRIPS, total


def _equal_text(mart: DataFrame, filters: dict[str, str | None]) -> DataFrame:
    """Apply the filters that were given; an empty text counts as not given."""
    for column, value in filters.items():
        if value:
            mart = mart.filter(F.col(column) == F.lit(str(value)))
    return mart


def _ties(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def revenue_top(
    mart: DataFrame,
    heure: int | str | None = None,
    service: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Cells with the highest revenue."""
    if heure is not None:
        mart = mart.filter(F.col("heure") == F.lit(int(heure)))
    mart = _equal_text(mart, {"service_type": service})
    return (
        mart.select(
            "service_type",
            "borough",
            "zone",
            "jour_semaine",
            "heure",
            TRIPS,
            "revenu_total",
            "revenu_moyen",
            "revenu_par_min",
            "tip_pct",
            "distance_moyenne",
        )
        .orderBy(
            F.desc_nulls_last("revenu_total"),
            *_ties("service_type", "borough", "zone", "jour_semaine", "heure"),
        )
        .limit(limit)
    )


def demand_series(
    mart: DataFrame,
    service: str | None = None,
    date: str | None = None,
    limit: int = 500,
) -> DataFrame:
    """Demand in order of time."""
    mart = _equal_text(mart, {"service_type": service})
    if date:
        mart = mart.filter(F.col("date_course") == F.lit(Date.fromisoformat(date)))
    return (
        mart.select(
            "date_course",
            "heure",
            "jour_semaine",
            "service_type",
            TRIPS,
            "distance_moy",
            "duree_moy_sec",
            "vitesse_moy_mph",
        )
        .orderBy(*_ties("date_course", "heure", "service_type"))
        .limit(limit)
    )


def services(mart: DataFrame, borough: str | None = None) -> DataFrame:
    """Services by number of trips."""
    return (
        _equal_text(mart, {"borough": borough})
        .select(
            "service_type",
            "borough",
            TRIPS,
            "part_marche_pct",
            "panier_median",
            "tip_pct",
            "driver_share_pct",
        )
        .orderBy(F.desc_nulls_last(TRIPS), *_ties("service_type", "borough"))
    )


def od_top(
    mart: DataFrame,
    origin: str | None = None,
    service: str | None = None,
    limit: int = 200,
) -> DataFrame:
    """Busiest connections between boroughs."""
    return (
        _equal_text(mart, {"pu_borough": origin, "service_type": service})
        .select(
            "pu_borough", "do_borough", "service_type", TRIPS, "distance_moy", "revenu_moy"
        )
        .orderBy(
            F.desc_nulls_last(TRIPS), *_ties("pu_borough", "do_borough", "service_type")
        )
        .limit(limit)
    )


# Question -> (datamart it reads, query).
QUESTIONS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "revenue-by-zone-hour": ("revenue_by_zone_hour", revenue_top),
    "demand-timeseries": ("demand_timeseries", demand_series),
    "service-comparison": ("service_comparison", services),
    "od-matrix": ("od_matrix", od_top),
}


def zone_revenue(mart: DataFrame, zone: str) -> DataFrame:
    """Check: revenue of one zone by service."""
    return (
        mart.filter(F.col("zone") == F.lit(zone))
        .groupBy("zone", "service_type")
        .agg(total(mart, "revenu_total").alias("revenu"))
        .orderBy(F.desc_nulls_last("revenu"), *_ties("service_type"))
    )


def zone_hours(mart: DataFrame, *zones: str) -> DataFrame:
    """Check: lines and trips by hour for some zones."""
    return (
        mart.filter(F.col("zone").isin(*zones))
        .groupBy("heure")
        .agg(F.count(F.lit(1)).alias("nb_lignes"), F.sum(TRIPS).alias("courses"))
        .orderBy("heure")
    )


def zone_preview(zones: DataFrame, limit: int = 10) -> DataFrame:
    """Check: first lines of the zone lookup."""
    return zones.orderBy(F.col("locationid").asc_nulls_last()).limit(limit)


def as_text(result: DataFrame) -> DataFrame:
    """Every value as text or NULL, the form in which clients receive it."""
    return result.select(*[F.col(c).cast("string").alias(c) for c in result.columns])
