import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tripmart.operators import marts, serve
from tripmart.sources import derived
from tripmart.sources.zones import checked


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    """All four marts, without suppression so that small data fills them."""
    root = str(tmp_path_factory.mktemp("gold"))
    zones = checked(derived.zones(spark, SMALL))
    events, lines = derived.event_trips(spark, SMALL), derived.line_trips(spark, SMALL)
    for name, build in marts.MARTS.items():
        source = events if name in ("revenue_by_zone_hour", "demand_timeseries") else lines
        build(source, zones, k=1).write.parquet(f"{root}/{name}")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def ask(gold, question, **filters):
    mart, query = serve.QUESTIONS[question]
    return query(gold(mart), **filters)


def test_limits_and_columns(gold):
    expected = {
        "revenue-by-zone-hour": (11, 100),
        "demand-timeseries": (8, 500),
        "service-comparison": (7, 18),
        "od-matrix": (6, 107),
    }
    for question, (columns, count) in expected.items():
        out = ask(gold, question)
        assert len(out.columns) == columns and out.count() == count


def test_absent_and_empty_filters_do_nothing(gold):
    everything = ask(gold, "od-matrix").collect()
    assert ask(gold, "od-matrix", origin="", service=None).collect() == everything
    some = ask(gold, "od-matrix", origin="ASIA", service="green").collect()
    assert some and all(r.pu_borough == "ASIA" and r.service_type == "green" for r in some)


def test_hour_zero_is_a_filter_and_a_bad_hour_an_error(gold):
    for given in (0, "0"):
        assert {r.heure for r in ask(gold, "revenue-by-zone-hour", heure=given).collect()} == {0}
    with pytest.raises(ValueError):
        ask(gold, "revenue-by-zone-hour", heure="noon")


def test_date_filter(gold):
    out = ask(gold, "demand-timeseries", date="2024-01-03", service="yellow").collect()
    assert {(str(r.date_course), r.service_type) for r in out} == {("2024-01-03", "yellow")}
    with pytest.raises(ValueError):
        ask(gold, "demand-timeseries", date="03/01/2024")


def test_parameters_are_data(gold):
    attack = "' OR '1'='1"
    assert ask(gold, "od-matrix", origin=attack).count() == 0
    assert ask(gold, "service-comparison", borough=attack).count() == 0


def test_order(gold):
    revenue = [r.revenu_total for r in ask(gold, "revenue-by-zone-hour").collect()]
    assert revenue == sorted(revenue, reverse=True)
    times = [(r.date_course, r.heure) for r in ask(gold, "demand-timeseries").collect()]
    assert times == sorted(times)
    counts = [r.nb_courses for r in ask(gold, "service-comparison").collect()]
    assert counts == sorted(counts, reverse=True)


def test_limit_cuts_ties_the_same_way(spark):
    rows = [(f"z{i}", "b", "yellow", 7, 1.0, 1.0) for i in range(20)]
    schema = (
        "pu_borough string, do_borough string, service_type string, nb_courses long, "
        "distance_moy double, revenu_moy double"
    )
    one = spark.createDataFrame(rows, schema)
    other = spark.createDataFrame(rows[::-1], schema).repartition(7)
    assert serve.od_top(one, limit=5).collect() == serve.od_top(other, limit=5).collect()


def test_top_k_is_not_a_full_sort(gold):
    plan = ask(gold, "od-matrix")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(pu_borough), EqualTo(pu_borough,ASIA)]" in (
        ask(gold, "od-matrix", origin="ASIA")._jdf.queryExecution().executedPlan().toString()
    )


def test_checks(gold, spark):
    mart = gold("revenue_by_zone_hour")
    revenue = serve.zone_revenue(mart, "NATION_6").collect()
    assert {r.zone for r in revenue} == {"NATION_6"} and len(revenue) == 3
    hours = serve.zone_hours(mart, "NATION_6", "NATION_12").collect()
    assert [r.heure for r in hours] == list(range(24))
    assert sum(r.courses for r in hours) == mart.filter(
        F.col("zone").isin("NATION_6", "NATION_12")
    ).agg(F.sum("nb_courses")).first()[0]
    assert [r.locationid for r in serve.zone_preview(derived.zones(spark, SMALL)).collect()] == list(
        range(1, 11)
    )


def test_text_form_for_clients(gold):
    text = serve.as_text(ask(gold, "service-comparison"))
    assert set(dict(text.dtypes).values()) == {"string"}
    assert text.filter("driver_share_pct IS NULL").count() == 12
