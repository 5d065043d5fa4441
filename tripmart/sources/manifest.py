"""What has landed, file by file, and which source file it came from.

The manifest has one row per landed file: its columns, rows and the range of
its pickup times, measured by executors. A build asks it which files can hold
trips of its months, wherever they were delivered, and reads just those with
the columns written down: no footer is opened to plan a scan. Files that were
put into the folders by others are measured once, when they are first seen.

The ledger has one row per landing: length and time of the source, and a digest
of its rows, so a source file that was delivered again with other content is
noticed although its month has landed.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.align import SHAPES, lower_names
from tripmart.operators.clean import Span
from tripmart.schema import DATASETS, check_dataset
from tripmart.session import in_parallel
from tripmart.sources.files import Folder
from tripmart.sources.lake import append_rows

ENTRY = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("shape", T.StringType()),
        T.StructField("nb_rows", T.LongType()),
        T.StructField("first_pickup", T.TimestampType()),
        T.StructField("last_pickup", T.TimestampType()),
        T.StructField("at", T.TimestampType()),
    ]
)
LEDGER = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.LongType()),
        T.StructField("nb_rows", T.LongType()),
        T.StructField("digest", T.DecimalType(38, 0)),
        T.StructField("at", T.TimestampType()),
    ]
)
_DATA_FILES = "year=*/month=*/*"
_FILE = r"(year=[^/]+/month=[^/]+/[^/]+)$"


def _now() -> Column:
    text = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def shape_of(schema: T.StructType) -> str:
    """Column names, in lower case, and types as text."""
    return T.StructType([T.StructField(f.name.lower(), f.dataType) for f in schema.fields]).json()


def content_digest(frame: DataFrame) -> Column:
    """A number that depends on the rows of a frame, not on their order or files."""
    return F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]).cast("decimal(38,0)"))


# -- files --------------------------------------------------------------------


def listed(spark: SparkSession, raw_root: str, dataset: str) -> DataFrame:
    """(file, bytes) of the landed files of a dataset, from a listing alone."""
    found = Folder(spark, f"{raw_root.rstrip('/')}/{check_dataset(dataset)}").sizes(_DATA_FILES)
    rows = [(f, n) for f, n in found if not f.rsplit("/", 1)[1].startswith(("_", "."))]
    return spark.createDataFrame(rows, "file string, bytes bigint")


def measure(
    spark: SparkSession, folder: str, dataset: str, files: DataFrame, schema: T.StructType
) -> DataFrame:
    """Manifest rows of ``files`` (file, bytes) below ``folder``, all of one shape.

    A file without rows has no range; one whose pickup column is missing has
    rows but no range, and is never left out of a scan.
    """
    paths = [f"{folder}/{r['file']}" for r in files.select("file").collect()]
    raw = lower_names(spark.read.schema(schema).parquet(*paths))
    name = F.regexp_extract(F.col("_metadata.file_path"), _FILE, 1)
    pickup = _pickup_column(raw, dataset)
    seen = raw.select(name.alias("file"), pickup.alias("pickup")).groupBy("file").agg(
        F.count(F.lit(1)).alias("nb_rows"),
        F.min("pickup").alias("first_pickup"),
        F.max("pickup").alias("last_pickup"),
    )
    return files.join(seen, "file", "left").select(
        F.lit(dataset).alias("dataset"),
        "file",
        "bytes",
        F.lit(shape_of(schema)).alias("shape"),
        F.coalesce("nb_rows", F.lit(0)).cast("bigint").alias("nb_rows"),
        "first_pickup",
        "last_pickup",
        _now().alias("at"),
    )


def _pickup_column(raw: DataFrame, dataset: str) -> Column:
    name = SHAPES[dataset].raw_name("pickup_datetime")
    if name not in raw.columns:
        return F.lit(None).cast("timestamp")
    return F.col(name).try_cast("timestamp")


def write_down(
    spark: SparkSession, raw_root: str, manifest: str, dataset: str, landed: str, schema: T.StructType
) -> None:
    """Add the files of one landed folder, which were written with one schema."""
    root = f"{raw_root.rstrip('/')}/{check_dataset(dataset)}"
    below = landed.split("/", 1)[1]
    found = [(f, n) for f, n in Folder(spark, root).sizes(f"{below}/*.parquet")]
    files = spark.createDataFrame(found, "file string, bytes bigint")
    append_rows(measure(spark, root, dataset, files, schema), manifest)


def adopt(spark: SparkSession, raw_root: str, manifest: str, dataset: str) -> int:
    """Measure landed files that the manifest does not have; returns their number.

    Their columns are read from their footers here, once in a file's life.
    """
    folder = f"{raw_root.rstrip('/')}/{check_dataset(dataset)}"
    there = listed(spark, raw_root, dataset)
    known = _read(spark, manifest, ENTRY).where(F.col("dataset") == dataset)
    missing = there.join(known, ["file", "bytes"], "left_anti").orderBy("file").collect()
    if not missing:
        return 0

    def shape(row) -> str:
        return spark.read.parquet(f"{folder}/{row['file']}").schema.json()

    groups: dict[str, list] = {}
    for row, key in zip(missing, in_parallel(spark, shape, missing, 8)):
        groups.setdefault(key, []).append(tuple(row))
    for key, rows in groups.items():
        files = spark.createDataFrame(rows, "file string, bytes bigint")
        schema = T.StructType.fromJson(json.loads(key))
        append_rows(measure(spark, folder, dataset, files, schema), manifest)
    return len(missing)


def entries(spark: SparkSession, raw_root: str, manifest: str, dataset: str) -> DataFrame:
    """The newest manifest row of every file that is there."""
    newest = Window.partitionBy("file").orderBy(F.col("at").desc())
    rows = _read(spark, manifest, ENTRY).where(F.col("dataset") == dataset)
    return (
        rows.join(listed(spark, raw_root, dataset), ["file", "bytes"])
        .withColumn("_n", F.row_number().over(newest))
        .where("_n = 1")
        .select(*ENTRY.names)
    )


def may_hold(span: Span) -> Column:
    """Whether a file can hold trips of the months of a span."""
    start, end = (F.lit(day.isoformat()).cast("timestamp") for day in (span.start, span.end))
    unknown = F.col("first_pickup").isNull() & (F.col("nb_rows") > 0)
    return unknown | ((F.col("last_pickup") >= start) & (F.col("first_pickup") < end))


def scan_landed(
    spark: SparkSession, raw_root: str, manifest: str, dataset: str, span: Span | None = None
) -> list[DataFrame]:
    """Scans that together cover all landed trips of a dataset, or those of a span.

    One scan per shape. The driver gets the names of the files to be read.
    Files without rows are left out.
    """
    adopt(spark, raw_root, manifest, dataset)
    rows = entries(spark, raw_root, manifest, dataset).where("nb_rows > 0")
    chosen = rows.where(may_hold(span)) if span is not None else rows
    groups: dict[str, list[str]] = {}
    root = f"{raw_root.rstrip('/')}/{dataset}"
    for row in chosen.select("shape", "file").orderBy("file").collect():
        groups.setdefault(row["shape"], []).append(f"{root}/{row['file']}")
    if not groups:
        # Nothing can hold such trips: any known shape, without a row.
        any_shape = rows.select("shape").first()
        if any_shape is None:
            return []
        return [spark.createDataFrame([], T.StructType.fromJson(json.loads(any_shape["shape"])))]
    return [
        spark.read.schema(T.StructType.fromJson(json.loads(shape))).parquet(*files)
        for shape, files in groups.items()
    ]


# -- sources ------------------------------------------------------------------


def source_state(spark: SparkSession, source: str) -> tuple[int, int]:
    """Bytes and time of last change of a source file (or folder of files)."""
    sizes = Folder(spark, source).status()
    return sum(n for n, _ in sizes), max((t for _, t in sizes), default=0)


def record_landing(
    spark: SparkSession,
    ledger: str,
    dataset: str,
    period: str,
    source: str,
    state: tuple[int, int],
    nb_rows: int,
    digest: object,
) -> None:
    row = [(dataset, period, source, state[0], state[1], nb_rows, digest)]
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields[:-1])
    append_rows(spark.createDataFrame(row, names).withColumn("at", _now()), ledger)


def last_landings(spark: SparkSession, ledger: str) -> DataFrame:
    """The newest ledger row per dataset and period."""
    newest = Window.partitionBy("dataset", "period").orderBy(F.col("at").desc())
    return (
        _read(spark, ledger, LEDGER)
        .where(F.col("dataset").isin(*DATASETS))
        .withColumn("_n", F.row_number().over(newest))
        .where("_n = 1")
        .drop("_n")
    )


def source_changed(spark: SparkSession, before, source: str) -> bool:
    """Whether a source holds other rows than at its last landing (a ledger row).

    Length and time are compared first; only where they differ are rows read.
    A source that is gone has not changed.
    """
    if not Folder(spark, source).exists():
        return False
    if source_state(spark, source) == (before["bytes"], before["modified"]):
        return False
    frame = spark.read.parquet(source)
    now = frame.agg(F.count(F.lit(1)).alias("n"), content_digest(frame).alias("digest")).first()
    return (now["n"], now["digest"]) != (before["nb_rows"], before["digest"])
