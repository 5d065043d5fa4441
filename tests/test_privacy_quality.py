import hashlib

import pytest

from tripmart.functions.privacy import (
    PEPPER_SETTING,
    configured_pepper,
    pseudonymise,
    suppress_small_cells,
)
from tripmart.operators.quality import (
    SILVER_RULES,
    Between,
    Compare,
    Completeness,
    IsComplete,
    QualityGateError,
    RowCount,
    evaluate,
    failed_rules,
    require_passed,
)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_pseudonym_is_deterministic_and_keeps_null(spark):
    rows = [("B1", "B1"), (None, "B1"), ("", "a§b")]
    out = pseudonymise(
        spark.createDataFrame(rows, "a string, b string"), ("a", "b"), "pep"
    ).collect()
    assert out[0].a == out[0].b == out[1].b == digest("pep§B1")
    assert out[1].a is None
    assert out[2].a == digest("pep§") and out[2].b == digest("pep§a§b")


def test_pepper_comes_from_configuration(spark):
    with pytest.raises(ValueError):
        configured_pepper(spark)
    spark.conf.set(PEPPER_SETTING, "x")
    assert configured_pepper(spark) == "x"
    spark.conf.unset(PEPPER_SETTING)


def test_small_cells(spark):
    cells = spark.createDataFrame([(4,), (5,), (6,)], "nb_courses long")
    assert suppress_small_cells(cells).count() == 2
    assert suppress_small_cells(cells, k=1).count() == 3


def outcome(frame, *rules):
    return {r.rule: (r.actual, r.outcome) for r in evaluate(frame, rules).collect()}


def test_clean_trips_pass_every_silver_rule(trips):
    report = evaluate(trips({}, {"fare_amount": 0.0}))
    assert report.filter("outcome = 'Failed'").count() == 0
    assert report.count() == len(SILVER_RULES) == 9
    require_passed(report)


def test_rule_labels():
    assert [r.label for r in SILVER_RULES] == [
        "RowCount > 0",
        'IsComplete "service_type"',
        'IsComplete "pickup_datetime"',
        'IsComplete "pu_location_id"',
        'ColumnValues "trip_distance" > 0',
        'ColumnValues "trip_duration_sec" between 0 and 86401',
        'ColumnValues "total_amount" >= 0',
        'ColumnValues "pu_location_id" between 0 and 266',
        'Completeness "fare_amount" > 0.95',
    ]


def test_each_kind_of_violation(trips):
    frame = trips({}, {"trip_distance": None}, {"pu_location_id": 266, "service_type": None})
    got = outcome(
        frame,
        RowCount(3),
        IsComplete("service_type"),
        Compare("trip_distance", ">", 0),
        Between("pu_location_id", 0, 266),
        Completeness("trip_distance", 0.5),
    )
    assert [v for v in got.values()] == [
        (3.0, "Failed"),
        (1.0, "Failed"),
        (1.0, "Failed"),
        (1.0, "Failed"),
        (2 / 3, "Passed"),
    ]


def test_completeness_at_the_threshold_fails(spark):
    frame = spark.range(20).selectExpr("if(id = 0, null, id) AS fare_amount")
    assert outcome(frame, Completeness("fare_amount", 0.95)) == {
        'Completeness "fare_amount" > 0.95': (0.95, "Failed")
    }


def test_empty_input_fails_on_row_count_and_completeness(trips):
    report = evaluate(trips({}).filter("fare_amount < 0"))
    assert failed_rules(report).first().nb_failed == 2
    with pytest.raises(QualityGateError) as error:
        require_passed(report)
    assert error.value.failed == ["RowCount > 0", 'Completeness "fare_amount" > 0.95']
