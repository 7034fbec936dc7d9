"""Gold marts: monthly spending per service and per region.

Order of work, chosen for scale: project silver to the gold columns (the Parquet scan reads only
those), aggregate (partial aggregation map-side, so a hot service or region is combined before
the shuffle), THEN attach labels to the few aggregated rows. The national share is a window over
the aggregated rows of one month (a few hundred rows), never over silver rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerlake.contract import PARTITION_COLUMN, Contract
from ledgerlake.functions.ratio import ratio

SUM_TYPE = DecimalType(28, 2)

# --- Fixed values: gold column names (published marts) --------------------------------------
ROWS = "nombre_lignes"
NOT_REIMBURSED = "montant_non_rembourse"
EFFECTIVE_RATE = "taux_remboursement_effectif"
OVERRUN_SHARE = "part_depassement"
NATIONAL_SHARE = "part_depense_nationale"
LABEL_PREFIX = "libelle_"
# --- end of fixed values -------------------------------------------------------------------
UNKNOWN_MONTH = "inconnu"  # partition of the mart rows without a processing month


def measures(contract: Contract) -> list[str]:
    return [contract.amount, contract.base, contract.reimbursed, contract.overrun]


def staging_spend(silver: DataFrame, contract: Contract) -> DataFrame:
    """The seven silver columns the marts use (column pruning reaches the scan)."""
    return silver.select(
        contract.processing_month, contract.service, contract.region, *measures(contract)
    )


def mart_month(contract: Contract) -> Column:
    """Partition of a stored mart row: its processing month, or ``UNKNOWN_MONTH``."""
    written = F.date_format(contract.processing_month, "yyyyMM")
    return F.coalesce(written, F.lit(UNKNOWN_MONTH)).alias(PARTITION_COLUMN)


def labels_for(labels: DataFrame, code_column: str) -> DataFrame:
    """(code, libelle) of one code column of the label dimension."""
    return labels.where(F.col("code_column") == F.lit(code_column)).select("code", "libelle")


def _sums(contract: Contract) -> list[Column]:
    return [
        F.count(F.lit(1)).cast("bigint").alias(ROWS),
        *[F.sum(m).cast(SUM_TYPE).alias(m) for m in measures(contract)],
    ]


def monthly_spend(staging: DataFrame, contract: Contract, key: str) -> DataFrame:
    return staging.groupBy(contract.processing_month, key).agg(*_sums(contract))


def monthly_spend_by_each(staging: DataFrame, contract: Contract) -> DataFrame:
    """Rows of both marts in one pass over silver; ``axis`` names the mart's key column."""
    month, service, region = contract.processing_month, contract.service, contract.region
    axis = F.when(F.grouping(service) == 0, F.lit(service)).otherwise(F.lit(region)).alias("axis")
    return staging.groupingSets([[month, service], [month, region]], month, service, region).agg(
        axis, *_sums(contract)
    )


def _with_label(agg: DataFrame, labels: DataFrame, key: str, code_column: str) -> DataFrame:
    """LEFT join on the raw code text: a missing label is NULL, no row lost or duplicated
    (the dimension has one row per code, checked before it is written). Both sides are small; the
    optimizer broadcasts the labels when their measured size allows it."""
    lib = labels_for(labels, code_column).withColumnRenamed("libelle", LABEL_PREFIX + key)
    return agg.join(lib, agg[key] == lib["code"], "left").drop("code")


def service_mart(
    spend_rows: DataFrame, labels: DataFrame, contract: Contract, code_column: str | None = None
) -> DataFrame:
    """Mart of ``monthly_spend`` rows by service."""
    key = contract.service
    agg = _with_label(spend_rows, labels, key, code_column or contract.spec(key).source)
    spend, reimbursed, overrun = (
        F.col(contract.amount), F.col(contract.reimbursed), F.col(contract.overrun)
    )
    return agg.select(
        contract.processing_month, key, LABEL_PREFIX + key, ROWS, *measures(contract),
        (spend - reimbursed).cast(SUM_TYPE).alias(NOT_REIMBURSED),
        ratio(reimbursed, spend).alias(EFFECTIVE_RATE),
        ratio(overrun, spend).alias(OVERRUN_SHARE),
    )


def region_mart(
    spend_rows: DataFrame, labels: DataFrame, contract: Contract, code_column: str | None = None
) -> DataFrame:
    """Mart of ``monthly_spend`` rows by region."""
    key = contract.region
    agg = _with_label(spend_rows, labels, key, code_column or contract.spec(key).source)
    spend, reimbursed = F.col(contract.amount), F.col(contract.reimbursed)
    national = F.sum(spend).over(Window.partitionBy(contract.processing_month))
    return agg.select(
        contract.processing_month, key, LABEL_PREFIX + key, ROWS, *measures(contract),
        (spend - reimbursed).cast(SUM_TYPE).alias(NOT_REIMBURSED),
        ratio(reimbursed, spend).alias(EFFECTIVE_RATE),
        ratio(spend, national).alias(NATIONAL_SHARE),
    )


def spend_by_service(
    staging: DataFrame, labels: DataFrame, contract: Contract, code_column: str | None = None
) -> DataFrame:
    rows = monthly_spend(staging, contract, contract.service)
    return service_mart(rows, labels, contract, code_column)


def spend_by_region(
    staging: DataFrame, labels: DataFrame, contract: Contract, code_column: str | None = None
) -> DataFrame:
    rows = monthly_spend(staging, contract, contract.region)
    return region_mart(rows, labels, contract, code_column)


def top_services(mart: DataFrame, contract: Contract, n: int = 5) -> DataFrame:
    """The ``n`` services with the largest spend in each processing month.

    A top-k per month: rank within the month (a window over the mart's few rows per month) with
    the service code as tie-break, so the result is deterministic.
    """
    month, key = contract.processing_month, contract.service
    order = Window.partitionBy(month).orderBy(F.desc_nulls_last(contract.amount), F.asc(key))
    return (
        mart.withColumn("rang", F.row_number().over(order))
        .where(F.col("rang") <= n)
        .select(month, "rang", key, LABEL_PREFIX + key, contract.amount)
    )
