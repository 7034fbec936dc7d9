"""Bronze load: monthly files -> all-text table partitioned by month, untouched."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ledgerlake.contract import TECHNICAL_COLUMNS
from ledgerlake.sinks.partitions import overwrite_months
from ledgerlake.sources import monthly_files
from ledgerlake.sources.tables import TableRef


def ingest_months(
    spark: SparkSession,
    raw_dir: str,
    bronze: TableRef,
    months: list[str],
    ingested_at: datetime | None = None,
    template: str = monthly_files.DEFAULT_TEMPLATE,
    layout: str = "{name}",
    spread: int | None = None,
) -> dict[str, int]:
    """Load several months in ONE write; return the rows written per month, counted while written.

    Months are checked and taken once each; every file must exist, and every header must have the
    table's columns, before anything is written. Each month replaces its own partition. Lines of
    compressed files are parsed by ``spread`` tasks (see ``monthly_files.read_months``).
    """
    months = monthly_files.checked_months(months)
    columns = None
    if bronze.schema is not None:
        columns = [f.name for f in bronze.schema if f.name not in TECHNICAL_COLUMNS]
    loaded_at = ingested_at or datetime.now(timezone.utc)
    rows = monthly_files.read_months(spark, raw_dir, months, loaded_at, template, layout, columns, spread)
    return overwrite_months(rows, bronze, months).by_month


def ingest_month(spark: SparkSession, raw_dir: str, bronze: TableRef, year: int, month: int, **options) -> int:
    """Load one month; returns the rows written. ``options`` as for ``ingest_months``."""
    return next(iter(ingest_months(spark, raw_dir, bronze, [f"{year:04d}{month:02d}"], **options).values()))
