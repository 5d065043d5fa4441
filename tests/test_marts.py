from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.functions.measures import iso_weekday
from tripmart.operators import marts
from tripmart.schema import ZONE
from tripmart.sources import derived, zones as zone_source
from tripmart.sources.zones import checked


def cells(frame, *keys):
    return {tuple(r[k] for k in keys): r for r in frame.collect()}


def test_sunday_is_seven(spark):
    days = spark.sql("SELECT DATE '2024-01-07' AS d UNION ALL SELECT DATE '2024-01-08'")
    assert [r[0] for r in days.select(iso_weekday(F.col("d"))).collect()] == [7, 1]


def test_means_count_missing_values(trips, zones):
    rows = [{"trip_distance": None}] + [{"trip_distance": 5.0}] * 4
    only = marts.od_matrix(trips(*rows), zones).first()
    assert only.nb_courses == 5 and only.distance_moy == 4.0


def test_zero_denominators_give_null(trips, zones):
    rows = [{"fare_amount": 0.0, "service_type": "fhvhv"}] * 5
    only = marts.revenue_by_zone_hour(trips(*rows), zones).first()
    assert only.tip_pct is None and only.revenu_par_min == 12.0 * 5 / 50.0
    cell = marts.service_comparison(trips(*rows), zones).first()
    assert cell.tip_pct is None and cell.driver_share_pct is None


def test_row_filters(trips, zones):
    rows = [{}] * 5 + [{"total_amount": 0.0}] * 5 + [{"trip_duration_sec": 0.0}] * 5
    assert marts.revenue_by_zone_hour(trips(*rows), zones).first().nb_courses == 5
    assert marts.demand_timeseries(trips(*rows)).first().nb_courses == 10
    assert marts.od_matrix(trips(*rows), zones).first().nb_courses == 10


def test_cells_below_five_are_withheld(trips, zones):
    rows = [{"pu_location_id": 1}] * 4 + [{"pu_location_id": 3}] * 5
    got = marts.revenue_by_zone_hour(trips(*rows), zones).collect()
    assert [r.zone for r in got] == ["Belmont"]
    assert marts.revenue_by_zone_hour(trips(*rows), zones, k=1).count() == 2


def test_unmapped_zones_are_a_group_of_their_own(trips, zones):
    rows = [{"pu_location_id": 99}] * 5 + [{"pu_location_id": 98}] * 5 + [{}] * 6
    got = cells(marts.service_comparison(trips(*rows), zones), "borough")
    assert got[(None,)].nb_courses == 10 and got[("Queens",)].nb_courses == 6
    assert got[(None,)].part_marche_pct == 100.0


def test_share_is_over_published_cells(trips, zones):
    rows = (
        [{"service_type": "yellow"}] * 6
        + [{"service_type": "green"}] * 4
        + [{"service_type": "fhvhv", "driver_pay": 6.0}] * 18
    )
    got = cells(marts.service_comparison(trips(*rows), zones), "service_type")
    assert set(got) == {("yellow",), ("fhvhv",)}
    assert got[("yellow",)].part_marche_pct == 25.0
    assert got[("fhvhv",)].driver_share_pct == 50.0
    assert got[("yellow",)].driver_share_pct is None


def test_median(trips, zones):
    rows = [{"total_amount": float(x)} for x in (1, 2, 3, 50, 1000)]
    assert marts.service_comparison(trips(*rows), zones).first().panier_median == 3.0


def test_speed_is_a_ratio_of_sums(trips):
    rows = [{"trip_distance": 1.0, "trip_duration_sec": 3600.0}] * 5
    rows += [{"trip_distance": 30.0, "trip_duration_sec": 1800.0}] * 5
    only = marts.demand_timeseries(trips(*rows)).first()
    assert only.vitesse_moy_mph == 155.0 / 7.5
    assert str(only.date_course) == "2024-03-10" and only.jour_semaine == 7 and only.heure == 8


@pytest.mark.parametrize("name", ["revenue_by_zone_hour", "service_comparison", "od_matrix"])
def test_large_lookup_takes_the_shuffle_way_to_the_same_result(spark, name):
    lookup = checked(derived.zones(spark, SMALL))
    large = replace(lookup, rows=zone_source.BROADCAST_ROWS + 1)
    assert lookup.small and not large.small
    trips = derived.line_trips(spark, SMALL)
    build = marts.MARTS[name]
    near, far = build(trips, lookup), build(trips, large)
    key = near.columns
    assert sorted(map(str, near.select(key).collect())) == sorted(
        map(str, far.select(key).collect())
    )


def test_repeated_zone_id_is_refused(spark):
    twice = spark.createDataFrame([(1, "a", "b"), (1, "a", "c")], ZONE)
    with pytest.raises(ValueError, match="repeated"):
        checked(twice)


def test_one_name_for_two_ids_is_one_cell(spark, trips):
    same = checked(spark.createDataFrame([(1, "Q", "Corona"), (2, "Q", "Corona")], ZONE))
    rows = [{"pu_location_id": 1}] * 3 + [{"pu_location_id": 2}] * 3
    for lookup in (same, replace(same, rows=10**9)):
        assert marts.revenue_by_zone_hour(trips(*rows), lookup).first().nb_courses == 6


def test_shares_of_a_borough_add_up(spark):
    lookup = checked(derived.zones(spark, SMALL))
    mart = marts.service_comparison(derived.line_trips(spark, SMALL), lookup)
    for row in mart.groupBy("borough").agg(F.sum("part_marche_pct").alias("s")).collect():
        assert abs(row.s - 100.0) < 1e-9


def test_od_total_is_complete_without_suppression(spark):
    lookup = checked(derived.zones(spark, SMALL))
    trips = derived.line_trips(spark, SMALL)
    n = trips.filter("total_amount > 0").count()
    assert n == 2866
    every = marts.od_matrix(trips, lookup, k=1).agg(F.sum("nb_courses")).first()[0]
    shown = marts.od_matrix(trips, lookup).agg(F.sum("nb_courses")).first()[0]
    assert every == n >= shown


def test_roll_up_equals_direct_aggregation(spark):
    lookup = checked(derived.zones(spark, SMALL))
    trips = derived.event_trips(spark, SMALL)
    mart = marts.revenue_by_zone_hour(trips, lookup, k=1)
    rolled = cells(marts.roll_up_revenue(mart, "service_type"), "service_type")
    direct = (
        trips.filter("total_amount > 0 AND trip_duration_sec > 0")
        .groupBy("service_type")
        .agg(F.count("*").alias("n"), F.sum("total_amount").cast("double").alias("s"))
        .collect()
    )
    for row in direct:
        got = rolled[(row.service_type,)]
        assert got.nb_courses == row.n
        assert abs(got.revenu_total - row.s) < 1e-6
        assert abs(got.revenu_moyen - row.s / row.n) < 1e-9


def test_mart_plan_has_one_shuffle_and_broadcast_lookup(trips, zones):
    plan = marts.od_matrix(trips({}), zones)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "Python" not in plan
