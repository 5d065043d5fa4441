"""Which months are still to be processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.periods import period_start, period_text, publishable_until

# First month of the history and months until publication.
FIRST_PERIOD = "2024-01"
LAG_MONTHS = 2


def registry_state(events: DataFrame) -> DataFrame:
    """Latest status per (dataset, period).

    A landing resets the month: silver results older than the latest landing
    no longer count and the month is PENDING again.
    """

    def latest(stage: str, value: Column) -> Column:
        # Equal moments are decided as in latest_events.
        order = F.struct("at", "status", "detail")
        return F.max_by(value, F.when((F.col("stage") == stage) & F.col("at").isNotNull(), order))

    def moment(stage: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col("at")))

    latest_events = events.groupBy("dataset", "period").agg(
        latest("bronze", F.col("status")).alias("bronze_status"),
        latest("bronze", F.col("detail")).alias("bronze_detail"),
        moment("bronze").alias("bronze_done_at"),
        latest("silver", F.col("status")).alias("silver_last"),
        moment("silver").alias("silver_last_at"),
    )
    void = F.coalesce(F.col("silver_last_at") < F.col("bronze_done_at"), F.lit(False))
    missing = F.col("silver_last_at").isNull()
    return latest_events.select(
        "dataset",
        "period",
        "bronze_status",
        "bronze_detail",
        F.when(void | missing, "PENDING").otherwise(F.col("silver_last")).alias("silver_status"),
        "bronze_done_at",
        F.when(~void, F.col("silver_last_at")).alias("silver_done_at"),
    )


def last_done(state: DataFrame) -> DataFrame:
    """Greatest finished period per dataset; a failed month does not count, so
    it comes up again."""
    return state.groupBy("dataset").agg(
        F.max(F.when(F.col("silver_status") == "DONE", F.col("period"))).alias("last_done")
    )


def backlog(
    datasets: DataFrame,
    state: DataFrame,
    as_of: Column,
    start: str = FIRST_PERIOD,
    lag_months: int = LAG_MONTHS,
) -> DataFrame:
    """Every published month of every dataset that is not done yet."""
    first, last = period_start(F.lit(start)), publishable_until(as_of, lag_months)
    months = F.when(
        first <= last, F.sequence(first, last, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))
    done = state.filter("silver_status = 'DONE'").select("dataset", "period")
    return (
        datasets.select("dataset", F.explode(months).alias("day"))
        .select(
            "dataset",
            period_text(F.col("day")).alias("period"),
            F.year("day").alias("year"),
            F.month("day").alias("month"),
        )
        .join(done, ["dataset", "period"], "left_anti")
    )


def next_periods(
    datasets: DataFrame,
    state: DataFrame,
    as_of: Column,
    start: str = FIRST_PERIOD,
    lag_months: int = LAG_MONTHS,
) -> DataFrame:
    """One planned month per dataset, or none when it is not published yet.

    This is the month after the last one done. A month before it that was tried
    and is not done, left behind by a bulk run, comes first.
    """
    follow = F.add_months(period_start(F.col("last_done")), 1)
    candidate = F.coalesce(follow, period_start(F.lit(start)))
    left = (
        state.where("silver_status <> 'DONE'")
        .join(last_done(state), "dataset")
        .where((F.col("period") < F.col("last_done")) & (F.col("period") >= start))
        .groupBy("dataset")
        .agg(F.min("period").alias("gap"))
    )
    first = F.coalesce(period_start(F.col("gap")), candidate)
    planned = F.when(first <= publishable_until(as_of, lag_months), first)
    return (
        datasets.select("dataset")
        .join(last_done(state), "dataset", "left")
        .join(left, "dataset", "left")
        .select("dataset", planned.alias("day"))
        .select(
            "dataset",
            period_text(F.col("day")).alias("period"),
            F.year("day").alias("year"),
            F.month("day").alias("month"),
            F.col("day").isNotNull().alias("hasWork"),
        )
    )


def next_missing(
    datasets: DataFrame,
    state: DataFrame,
    as_of: Column,
    start: str = FIRST_PERIOD,
    lag_months: int = LAG_MONTHS,
) -> DataFrame:
    """One planned month per dataset: the first published one that is not done.

    Unlike the month after the last one done this closes every gap, also one
    that nobody tried yet, as months built by name leave behind.
    """
    due = backlog(datasets, state, as_of, start, lag_months)
    first = due.groupBy("dataset").agg(F.min(F.struct("period", "year", "month")).alias("first"))
    return datasets.select("dataset").join(first, "dataset", "left").select(
        "dataset", "first.period", "first.year", "first.month", F.col("first").isNotNull().alias("hasWork")
    )


def latest_events(events: DataFrame) -> DataFrame:
    """The events that decide the state: the newest per dataset, period and stage.

    Equal moments are decided by status and detail, so any copy of the events
    in any order gives the same ones.
    """
    newest = F.max(F.struct("at", "status", "detail")).alias("e")
    return events.groupBy("dataset", "period", "stage").agg(newest).select(
        "dataset", "period", "stage", "e.status", "e.detail", "e.at"
    )


def not_landed(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned months of which nothing has landed yet."""
    return plan.join(landed, ["dataset", "period"], "left_anti")
