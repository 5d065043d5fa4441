"""Months as ``YYYY-MM`` text at the edge and first-of-month dates inside."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.schema import DATASETS

# File name prefix per dataset.
FILE_PREFIX = {
    "yellow": "yellow_tripdata",
    "green": "green_tripdata",
    "fhvhv": "fhvhv_tripdata",
}


def parse_period(period: str) -> date:
    """First day of a ``YYYY-MM`` month, for driver-side arguments."""
    return date.fromisoformat(f"{period}-01")


def next_month(day: date, step: int = 1) -> date:
    years, month0 = divmod(day.month - 1 + step, 12)
    return date(day.year + years, month0 + 1, 1)


def period_start(period: Column) -> Column:
    return F.to_date(F.concat(period, F.lit("-01")))


def period_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def period_from_parts(period: Column, year: Column, month: Column) -> Column:
    """The period when given, otherwise built from separate year and month."""
    given = F.when(period != "", period)
    return F.coalesce(
        given, F.format_string("%04d-%02d", year.cast("int"), month.cast("int"))
    )


def file_prefix(dataset: Column) -> Column:
    """Prefix of a known dataset; any other name fails the query."""
    known = F.create_map(*[F.lit(x) for kv in FILE_PREFIX.items() for x in kv])
    return F.when(dataset.isin(*DATASETS), known[dataset]).otherwise(
        F.raise_error(F.concat(F.lit("unknown dataset: "), F.coalesce(dataset, F.lit("NULL"))))
    )


def source_file(dataset: Column, day: Column, root: str) -> Column:
    return F.format_string(
        f"{root.rstrip('/').replace('%', '%%')}/%s_%04d-%02d.parquet",
        file_prefix(dataset),
        F.year(day),
        F.month(day),
    )


def landing_folder(dataset: Column, day: Column) -> Column:
    """Landing partition below the raw root, month zero-padded."""
    return F.format_string(
        "%s/year=%04d/month=%02d", dataset, F.year(day), F.month(day)
    )


def publishable_until(as_of: Column, lag_months: int) -> Column:
    """Last month already published on ``as_of``."""
    return F.add_months(F.trunc(as_of, "MM"), -lag_months)
