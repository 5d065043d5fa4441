"""Pseudonyms for identifiers and suppression of small cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.measures import TRIPS

# What stands between pepper and value, and the smallest published cell.
SEPARATOR = "§"
MIN_CELL = 5
# The name contains "secret" so that Spark redacts the value in its own pages.
PEPPER_SETTING = "spark.tripmart.secret.pepper"


def configured_pepper(spark: SparkSession) -> str:
    pepper = spark.conf.get(PEPPER_SETTING, None)
    if not pepper:
        raise ValueError(f"set {PEPPER_SETTING} before pseudonymising")
    return pepper


def pseudonym(column: str | Column, pepper: str) -> Column:
    """Peppered SHA-256, equal for equal inputs; NULL stays NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(
        value.isNotNull(), F.sha2(F.concat_ws(SEPARATOR, F.lit(pepper), value), 256)
    )


def pseudonymise(df: DataFrame, columns: tuple[str, ...], pepper: str) -> DataFrame:
    return df.withColumns({c: pseudonym(c, pepper) for c in columns})


def suppress_small_cells(
    cells: DataFrame, count: str = TRIPS, k: int = MIN_CELL
) -> DataFrame:
    """Keep only aggregate rows that stand for at least ``k`` records."""
    return cells.filter(F.col(count) >= k)
