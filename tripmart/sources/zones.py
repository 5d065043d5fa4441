"""Zone lookup: location id to borough and zone name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schema import ZONE

# About 100 bytes a row, so at most some 10 MB go to each executor.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Zones:
    """A lookup whose ids were checked to be unique and whose size is known."""

    frame: DataFrame
    rows: int

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS

    @property
    def side(self) -> DataFrame:
        """Join side: broadcast only within the checked bound."""
        return F.broadcast(self.frame) if self.small else self.frame


def checked(zones: DataFrame) -> Zones:
    """Count the lookup once; a repeated id would multiply trips in the join."""
    sizes = zones.agg(
        F.count("locationid").alias("ids"),
        F.count_distinct("locationid").alias("different"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    if sizes["ids"] != sizes["different"]:
        raise ValueError("zone lookup has repeated location ids")
    return Zones(zones, sizes["rows"])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Read the CSV by header name; columns of any order, case and quoting."""
    text = spark.read.option("header", True).csv(path)
    text = text.toDF(*[c.strip().lower() for c in text.columns])
    return text.select(
        F.col("locationid").try_cast("long").alias("locationid"),
        *[F.expr(f"trim(BOTH '\"' FROM trim({c}))").alias(c) for c in ("borough", "zone")],
    ).to(ZONE)
