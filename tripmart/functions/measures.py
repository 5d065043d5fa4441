"""Aggregate measures of the datamarts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

TRIPS = "nb_courses"


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + 1


# Doubles are added as whole millionths, in two longs of 20 low and 44 high bits.
_UNIT, _LOW_BITS = 1_000_000, 20
#: Beyond this a double's millionths do not fit into a long.
_WIDE = 9e12


def exact_sum(frame: DataFrame, column: str) -> Column:
    """Sum of a column that does not depend on the order or partitioning of rows.

    Decimals and whole numbers are added as they are. A double counts as the
    nearest millionth: longs are added, in pieces too small to overflow, and
    make a DECIMAL(38,6) at the end, so sums of sums stay exact as well. What
    is no number or beyond 32 digits is left out.
    """
    kind = frame.schema[column].dataType
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.sum(column)
    value = F.col(column).cast("double")
    fits = F.abs(value) < _WIDE
    units = F.when(fits, F.rint(value * _UNIT).try_cast("bigint"))
    high = F.sum(F.shiftright(units, _LOW_BITS))
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    wide = F.sum(F.when(~fits, value.try_cast("decimal(32,6)")))
    whole = high.cast("decimal(31,0)") * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low.cast("decimal(19,0)")
    small = (whole * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(38,6)")
    none = F.lit(0).cast("decimal(38,6)")
    both = F.coalesce(small, none) + F.coalesce(wide.cast("decimal(38,6)"), none)
    return F.when(high.isNotNull() | wide.isNotNull(), both.cast("decimal(38,6)"))


def total(frame: DataFrame, column: str) -> Column:
    """Exact sum as double."""
    return exact_sum(frame, column).cast("double")


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """Ratio of two group sums, NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator) * F.lit(scale)


# Buckets of a value's size: 64 to a doubling, so each spans about one per cent.
_PER_DOUBLING, _OFFSET = 64, 100_000


def size_bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows, whatever its sign and scale."""
    size = F.floor(F.log2(F.abs(value)) * _PER_DOUBLING) + _OFFSET
    return F.when(value > 0, size).when(value < 0, -size).when(value == 0, 0).cast("int")


def lower_median(
    counted: DataFrame, keys: tuple[str, ...], value: str, n: str, sums: tuple[str, ...] = ()
) -> DataFrame:
    """``keys``, ``median``, ``n`` and ``sums`` from (keys, value, n, sums) lines, n times a value each.

    The value at rank ceil(total / 2): exact, and the same for any split of the
    lines, so monthly counts can be added. One aggregation by size of the value
    gives the totals of each group and the bucket that holds the middle rank;
    only the values of that bucket, about one per cent wide, are then ranked.
    """
    # The join below needs a bucket; asking for it here gives both branches one plan.
    lines = counted.withColumn("_bucket", size_bucket(F.col(value).cast("double"))).where("_bucket is not null")
    group = Window.partitionBy(*keys)
    added = [F.sum(c).alias(c) for c in (n, *sums)]
    up_to = F.sum(n).over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    half = F.ceil(F.sum(n).over(group) / 2)
    chosen = (
        lines.groupBy(*keys, "_bucket")
        .agg(*added)
        .withColumns({"_up_to": up_to, "_rank": half, f"_{n}": F.sum(n).over(group)})
        # Sums of all other buckets; those of the chosen one are added from its lines.
        .withColumns({f"_{c}": F.sum(c).over(group) - F.coalesce(c, F.lit(0)) for c in sums})
        .where((F.col("_up_to") >= F.col("_rank")) & (F.col("_up_to") - F.col(n) < F.col("_rank")))
        .select(
            *[F.col(k).alias(f"_key_{k}") for k in keys],
            F.col("_bucket").alias("_chosen"),
            (F.col("_rank") - F.col("_up_to") + F.col(n)).alias("_left"),
            *[F.col(f"_{c}") for c in (n, *sums)],
        )
    )
    same = F.col("_bucket") == F.col("_chosen")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    # One bucket per group is left: a small table, joined to the lines.
    carried = ["_left", *[f"_{c}" for c in (n, *sums)]]
    # Both branches need the same columns of the lines, so that these are made once.
    ranked = lines.join(chosen, same).groupBy(*keys, value, *carried).agg(*added)
    reached = F.sum(n).over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    whole = {c: F.coalesce(F.sum(c).over(group) + F.col(f"_{c}"), F.col(f"_{c}")) for c in sums}
    return (
        ranked.withColumns({"_up_to": reached, **{f"_all_{c}": column for c, column in whole.items()}})
        .where((F.col("_up_to") >= F.col("_left")) & (F.col("_up_to") - F.col(n) < F.col("_left")))
        .select(
            *keys,
            F.col(value).cast("double").alias("median"),
            F.col(f"_{n}").alias(n),
            *[F.col(f"_all_{c}").alias(c) for c in sums],
        )
    )


def share_of(column: str, *partition: str) -> Column:
    """Per cent of the partition total."""
    whole = F.sum(column).over(Window.partitionBy(*partition))
    return F.col(column).cast("double") * 100.0 / whole.cast("double")
