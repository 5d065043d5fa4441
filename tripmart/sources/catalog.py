"""Catalog entries for folders written by the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmart.schema import DATASETS, PARTITIONS, SILVER, UNIFIED
from tripmart.sources.versions import WHOLE, VersionedTable


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType | None = None,
    partitions: tuple[str, ...] = (),
) -> DataFrame:
    """(Re)create an external table and take up the partitions found on disk.

    Dropping an external table keeps its files. Without a schema it is inferred.
    """
    location = path.replace("'", "\\'")
    columns = f"({_columns(schema)})" if schema else ""
    keys = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} {columns} USING parquet {keys} LOCATION '{location}'")
    if partitions:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _literal(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _same_columns(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    have = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    return have == [(f.name, f.dataType) for f in schema.fields]


def point_table(
    spark: SparkSession, name: str, table: VersionedTable, schema: T.StructType | None = None
) -> DataFrame:
    """An external table over the current versions of a versioned table.

    An existing entry is kept and its locations are switched, so a reader finds
    the table at any time; one whose columns have changed is created anew.
    """
    own = {part: version for part, (version, _) in table.current().items()}
    if not table.partitions:
        location = table.folder(own[WHOLE])
        now = spark.read.parquet(location).schema
        if not spark.catalog.tableExists(name):
            return register_table(spark, name, location, now)
        if not _same_columns(spark, name, now):
            return register_table(spark, name, location, now)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_literal(location)}'")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    if not spark.catalog.tableExists(name) or not _same_columns(spark, name, schema):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        # Its own location holds no partition folder; every partition has a location.
        spark.sql(
            f"CREATE TABLE {name} ({_columns(schema)}) USING parquet "
            f"PARTITIONED BY ({', '.join(table.partitions)}) LOCATION '{_literal(table.root)}/_catalog'"
        )
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for part in sorted(known - set(own)):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(part)})")
    for part, version in sorted(own.items()):
        location = _literal(table.folder(version, part))
        if part in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(part)}) SET LOCATION '{location}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({_spec(part)}) LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _spec(part: str) -> str:
    """``a=x/b=1`` as a partition clause."""
    pieces = [piece.split("=", 1) for piece in part.split("/")]
    return ", ".join(f"{key}='{_literal(value)}'" for key, value in pieces)


def register_silver(spark: SparkSession, path: str, name: str = "silver_trips") -> DataFrame:
    return register_table(spark, name, path, SILVER, PARTITIONS)


def replace_unified_view(
    spark: SparkSession, table: str = "silver_trips", view: str = "gold_trips_unified"
) -> None:
    """Permanent view of the published columns: one tagged branch per service,
    so that a filter on the service leaves one branch to read."""
    rest = ", ".join(c for c in UNIFIED if c != "service_type")
    branches = [
        f"SELECT '{service}' AS service_type, {rest} FROM {table} "
        f"WHERE service_type = '{service}'"
        for service in DATASETS
    ]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + " UNION ALL ".join(branches))
