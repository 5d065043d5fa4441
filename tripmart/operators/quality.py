"""Declarative data-quality rules, evaluated together in one aggregation."""

from __future__ import annotations

import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}


def _number(value: float) -> str:
    return str(int(value)) if value == int(value) else str(value)


@dataclass(frozen=True)
class RowCount:
    """More than ``above`` rows."""

    above: int = 0

    @property
    def label(self) -> str:
        return f"RowCount > {self.above}"

    def measure(self) -> Column:
        return F.count(F.lit(1)).cast("double")

    def holds(self, actual: Column) -> Column:
        return actual > self.above


@dataclass(frozen=True)
class Completeness:
    """Share of non-NULL values above a threshold; NULL on an empty table."""

    column: str
    above: float

    @property
    def label(self) -> str:
        return f'Completeness "{self.column}" > {self.above}'

    def measure(self) -> Column:
        return F.try_divide(
            F.count(self.column).cast("double"), F.count(F.lit(1)).cast("double")
        )

    def holds(self, actual: Column) -> Column:
        return actual > self.above


class _NoViolation:
    """Rules that hold when no row breaks them; the measure counts those rows."""

    def row_ok(self) -> Column:
        raise NotImplementedError

    def measure(self) -> Column:
        return F.count_if(~F.coalesce(self.row_ok(), F.lit(False))).cast("double")

    def holds(self, actual: Column) -> Column:
        return actual == 0


@dataclass(frozen=True)
class IsComplete(_NoViolation):
    column: str

    @property
    def label(self) -> str:
        return f'IsComplete "{self.column}"'

    def row_ok(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True)
class Compare(_NoViolation):
    column: str
    op: str
    value: float

    @property
    def label(self) -> str:
        return f'ColumnValues "{self.column}" {self.op} {_number(self.value)}'

    def row_ok(self) -> Column:
        return _COMPARE[self.op](F.col(self.column), F.lit(self.value))


@dataclass(frozen=True)
class Between(_NoViolation):
    """Strictly between two values."""

    column: str
    low: float
    high: float

    @property
    def label(self) -> str:
        return f'ColumnValues "{self.column}" between {_number(self.low)} and {_number(self.high)}'

    def row_ok(self) -> Column:
        return (F.col(self.column) > self.low) & (F.col(self.column) < self.high)


Rule = RowCount | Completeness | IsComplete | Compare | Between

# The gate a silver month has to pass.
SILVER_RULES: tuple[Rule, ...] = (
    RowCount(0),
    IsComplete("service_type"),
    IsComplete("pickup_datetime"),
    IsComplete("pu_location_id"),
    Compare("trip_distance", ">", 0),
    Between("trip_duration_sec", 0, 86401),
    Compare("total_amount", ">=", 0),
    Between("pu_location_id", 0, 266),
    Completeness("fare_amount", 0.95),
)


class QualityGateError(Exception):
    """A gate failed; nothing was published."""

    def __init__(self, failed: list[str], report: DataFrame | None = None):
        super().__init__(f"{len(failed)} quality rule(s) failed: {', '.join(failed)}")
        self.failed = failed
        self.report = report


def measures(rules: tuple[Rule, ...]) -> list[Column]:
    return [rule.measure().alias(f"m{i}") for i, rule in enumerate(rules)]


def rule_table(measured: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(rule, actual, outcome) rows from the one row of measures."""
    lines = [
        F.struct(
            F.lit(rule.label).alias("rule"),
            F.col(f"m{i}").alias("actual"),
            F.when(rule.holds(F.col(f"m{i}")), "Passed").otherwise("Failed").alias("outcome"),
        )
        for i, rule in enumerate(rules)
    ]
    return measured.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def evaluate(df: DataFrame, rules: tuple[Rule, ...] = SILVER_RULES) -> DataFrame:
    return rule_table(df.agg(*measures(rules)), rules)


def rule_table_from_observed(
    spark: SparkSession, observed: dict, rules: tuple[Rule, ...]
) -> DataFrame:
    """Same table from measures collected while another job was writing."""
    names = [f"m{i}" for i in range(len(rules))]
    shape = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    row = tuple(observed.get(n) for n in names)
    return rule_table(spark.createDataFrame([row], shape), rules)


def failed_rules(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if(F.col("outcome") == "Failed").alias("nb_failed"))


def require_passed(report: DataFrame) -> None:
    """Raise when a rule failed. The report has one row per rule."""
    failed = [r["rule"] for r in report.filter("outcome = 'Failed'").collect()]
    if failed:
        raise QualityGateError(failed, report)


def rejects_by_month(aligned: DataFrame, predicates: dict[str, Column], pickup: str = "pickup_datetime") -> DataFrame:
    """(year, month, predicate, nb_rows): rows read and kept, and rows breaking each predicate.

    Rows belong to the month of their pickup; those without one have none. All
    counts come from one pass; a row may break several predicates.
    """
    checks = {name: F.coalesce(good, F.lit(False)) for name, good in predicates.items()}
    kept = F.lit(True)
    for good in checks.values():
        kept = kept & good
    counts = {"rows_read": F.count(F.lit(1)), "rows_kept": F.count_if(kept)}
    counts |= {name: F.count_if(~good) for name, good in checks.items()}
    names = list(counts)
    counted = aligned.groupBy(F.year(pickup).alias("year"), F.month(pickup).alias("month")).agg(
        *[counts[name].alias(f"m{i}") for i, name in enumerate(names)]
    )
    lines = [F.struct(F.lit(name).alias("predicate"), F.col(f"m{i}").alias("nb_rows")) for i, name in enumerate(names)]
    return counted.select("year", "month", F.explode(F.array(*lines)).alias("r")).select("year", "month", "r.*")


def against_history(
    history: DataFrame, keys: tuple[str, ...], period: str, value: str, least: float = 0.5, months: int = 6
) -> DataFrame:
    """The history with ``usual``, the median of the months before, and the outcome.

    A month fails whose value is below ``least`` times that median. The first
    month of its keys has nothing to be compared with and passes.
    """
    before = Window.partitionBy(*keys).orderBy(period).rowsBetween(-months, -1)
    usual = F.percentile(F.col(value).cast("double"), F.lit(0.5)).over(before)
    holds = F.col(value) >= F.col("usual") * least
    return history.withColumn("usual", usual).withColumn(
        "outcome", F.when(F.coalesce(holds, F.lit(True)), "Passed").otherwise("Failed")
    )


def evaluate_months(
    staged: DataFrame, months: DataFrame, rules: tuple[Rule, ...] = SILVER_RULES
) -> DataFrame:
    """(year, month, rule, actual, outcome) of every planned month.

    ``months`` has (year, month). A month without rows has zero of them and no
    measure that needs rows, so it fails its row count.
    """
    names = [f"m{i}" for i in range(len(rules))]
    measured = staged.groupBy("year", "month").agg(*measures(rules))
    # Counting rules measure 0 over no row; shares have no value there.
    empty = staged.sparkSession.createDataFrame([(1,)], "one int").where("one = 0")
    columns = {c: F.lit(None).cast(t.dataType) for c, t in ((f.name, f) for f in staged.schema.fields)}
    nothing = empty.select(*[column.alias(name) for name, column in columns.items()]).agg(*measures(rules)).first()
    filled = months.join(measured, ["year", "month"], "left").select(
        "year",
        "month",
        *[F.coalesce(F.col(n), F.lit(nothing[n]).cast("double")).alias(n) for n in names],
    )
    lines = [
        F.struct(
            F.lit(rule.label).alias("rule"),
            F.col(f"m{i}").alias("actual"),
            F.when(rule.holds(F.col(f"m{i}")), "Passed").otherwise("Failed").alias("outcome"),
        )
        for i, rule in enumerate(rules)
    ]
    return filled.select("year", "month", F.explode(F.array(*lines)).alias("r")).select("year", "month", "r.*")
