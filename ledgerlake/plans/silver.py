"""Silver build: bronze months -> typed silver + quarantine, then reconciliation on disk.

Jobs, for any number of months at once:
1. bronze totals per month: rows and converted amount, reading ONE column of the months;
   a requested month without bronze rows is refused before anything is written;
2. valid rows typed and written (dynamic partition overwrite, rows observed during the write);
3. rejected rows (original text + reasons) written: only the months the silver pass saw rejects
   in are scanned again; the other requested months are emptied without reading bronze;
4. silver and quarantine re-read from disk and reconciled with bronze per month, to the cent;
5. reasons histogram of the quarantine (only if something was rejected);
6. rows by code of each month, kept beside silver for the label audit (only where asked for).

Silver's pointer keeps, for each month, whether rows without a processing month are in it.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN, Contract
from ledgerlake.operators import layout, quality, reconcile
from ledgerlake.operators.silver import raw_amount, rejected_rows, silver_projection, valid_rows, with_reasons
from ledgerlake.sinks.partitions import overwrite_months
from ledgerlake.sources.monthly_files import checked_months
from ledgerlake.sources.tables import TableRef, read_months


NO_MONTH = "null_months"  # a month's fact: it holds rows without a processing month


@dataclass(frozen=True)
class SilverResult:
    """Rows and amounts by layer (``reconcile.LAYERS``), and rows by rejection reason."""

    months: tuple[str, ...]
    rows: dict[str, int]
    amounts: dict[str, Decimal]
    reasons: tuple[tuple[str, int], ...]


def _month_totals(df: DataFrame, layer: str, amount) -> DataFrame:
    return reconcile.monthly_totals(df, amount).withColumn("layer", F.lit(layer))


def build_silver(
    spark: SparkSession,
    bronze: TableRef,
    silver: TableRef,
    quarantine: TableRef,
    months: list[str],
    contract: Contract,
    sort_within: tuple[str, ...] | None = None,
    codes: TableRef | None = None,
    cluster_by: tuple[str, ...] | None = None,
    file_rows: int = layout.FILE_ROWS,
) -> SilverResult:
    """Build silver and quarantine for ``months`` (see module docstring).

    ``codes``: where the rows by code of every month are kept (``Lakehouse.codes``).

    ``sort_within``: silver columns to sort each write task by (no shuffle) so that Parquet
    row-group min/max statistics become selective for them, e.g. (service, region) for readers
    filtering on a service or a region. Costs a per-task sort; off by default.

    ``cluster_by``: silver columns by which the rows of a month are placed together, all at once
    (``operators.layout``), in files of about ``file_rows`` rows, with Bloom filters for its codes. A
    filter on any of them then reads part of the month. Costs a pass over these columns, one that
    samples the range bounds, and a shuffle of the valid rows; off by default.
    """
    if sort_within and cluster_by:
        raise ValueError("sort_within and cluster_by exclude each other")
    months = checked_months(months)
    source = read_months(spark, bronze, months)
    raw = raw_amount(contract)

    # one row for each month and layer, here and below
    loaded = _month_totals(source.select(PARTITION_COLUMN, contract.amount_source), "bronze", raw)
    totals = loaded.collect()
    absent = sorted(set(months) - {r[PARTITION_COLUMN] for r in totals})
    if absent:
        raise ValueError(f"months absent from bronze (load them first): {', '.join(absent)}")

    checked_obs = Observation()
    checked = with_reasons(source, contract, checked_obs)
    valid = valid_rows(checked, contract)
    if sort_within:
        valid = valid.sortWithinPartitions(PARTITION_COLUMN, *sort_within)
    options: dict[str, str] = {}
    if cluster_by:
        points = layout.split_points(silver_projection(source, contract), list(cluster_by))
        files = sum(-(-r["rows"] // file_rows) for r in totals)
        valid = layout.clustered(valid, list(cluster_by), points, files)
        options = layout.bloom_options([c for c in cluster_by if contract.spec(c).is_code])
    facts = {NO_MONTH: F.col(contract.processing_month).isNull()}
    overwrite_months(valid, silver, months, facts=facts, options=options)
    # the silver pass observed which months hold rejects: only those are scanned again for the
    # quarantine; the others are emptied without reading bronze (no reject at all: no scan)
    with_rejects = sorted(checked_obs.get["months_rejected"] or [])
    if with_rejects:
        again = read_months(spark, bronze, with_rejects)
        rejected = rejected_rows(with_reasons(again, contract))
    else:
        rejected = rejected_rows(checked).limit(0)
    overwrite_months(rejected, quarantine, months)

    # what was written, re-read from disk: both layers' monthly totals in one job
    kept = read_months(spark, silver, months).select(PARTITION_COLUMN, contract.amount)
    refused = read_months(spark, quarantine, months)
    written = _month_totals(kept, "silver", F.col(contract.amount)).unionByName(
        _month_totals(refused.select(PARTITION_COLUMN, contract.amount_source), "quarantine", raw)
    )
    totals += written.collect()
    layers = spark.createDataFrame(totals, written.schema)
    reconcile.require_reconciled(layers, [PARTITION_COLUMN])

    def total(layer: str, measure: str, zero):
        return sum((r[measure] for r in totals if r["layer"] == layer), zero)

    rows = {layer: int(total(layer, "rows", 0)) for layer in reconcile.LAYERS}
    amounts = {layer: total(layer, "amount", Decimal("0.00")) for layer in reconcile.LAYERS}
    reasons: tuple[tuple[str, int], ...] = ()
    if rows["quarantine"]:
        counted = reconcile.reason_counts(refused).collect()
        reasons = tuple((r["motif"], int(r["lignes"])) for r in counted)
    if codes is not None:
        keep_code_counts(spark, silver, codes, months, contract)
    return SilverResult(tuple(months), rows, amounts, reasons)


def keep_code_counts(
    spark: SparkSession, silver: TableRef, codes: TableRef, months: list[str], contract: Contract
) -> None:
    """Store the rows by code of these months, each marked with the version of the month it counts."""
    shown = silver.months(spark) or {}
    counts = quality.monthly_code_counts(read_months(spark, silver, months), contract)
    made_from = {m: shown[m]["version"] for m in months if m in shown}
    # few rows for each month
    overwrite_months(counts.repartition(PARTITION_COLUMN), codes, months, made_from=made_from)


def build_silver_month(
    spark: SparkSession,
    bronze: TableRef,
    silver: TableRef,
    quarantine: TableRef,
    year_month: str,
    contract: Contract,
    sort_within: tuple[str, ...] | None = None,
) -> SilverResult:
    return build_silver(spark, bronze, silver, quarantine, [year_month], contract, sort_within)
