"""Gold build: silver + labels -> two marts, then the data checks with their severities.

A mart has one row for each (processing month, code), months and codes being NULL included, and is
stored by processing month; rows without one are in the partition ``gold.UNKNOWN_MONTH``. Silver rows
of a month are in the silver partition of that month, but rows without a processing month may be in
any: a rebuild of some months therefore rebuilds the unknown partition too, from the months that hold
such rows, so that it gives what a full build gives. Silver's pointer tells which ones do: no file of
another month is opened.

The label audit covers all months in every run: rows by code are counted and kept month by month by the
silver job, and added up here. Silver itself is scanned twice: for both marts at once (grouping sets),
and for the checks' own totals and NULL counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contract import Contract
from ledgerlake.operators import gold, quality
from ledgerlake.operators.quality import ERROR, WARN, NotNull
from ledgerlake.plans.silver import NO_MONTH
from ledgerlake.session import work_path
from ledgerlake.sinks.partitions import overwrite_months, overwrite_partitioned_table
from ledgerlake.sources.monthly_files import checked_months
from ledgerlake.sources.tables import TableRef, read_months

SERVICE_MART = "depenses_par_prestation"
REGION_MART = "depenses_par_region"


class DataTestError(Exception):
    """A data check of severity error returned rows."""


@dataclass(frozen=True)
class CheckResult:
    name: str
    severity: str
    rows: int


def silver_summary(staging: DataFrame, contract: Contract) -> DataFrame:
    """One row for each processing month: measures, rows, and rows with a NULL month or amount."""
    return staging.groupBy(contract.processing_month).agg(
        *[F.sum(m).cast("decimal(38,2)").alias(m) for m in gold.measures(contract)],
        F.count_if(F.col(contract.processing_month).isNull()).alias("null_months"),
        F.count_if(F.col(contract.amount).isNull()).alias("null_amounts"),
    )


def checks(
    summary: DataFrame,
    service: DataFrame,
    region: DataFrame,
    labels: DataFrame,
    code_counts: DataFrame,
    contract: Contract,
) -> dict[str, tuple[str, DataFrame]]:
    """Every data check as (severity, offending rows)."""
    month = contract.processing_month
    label_service = gold.LABEL_PREFIX + contract.service
    label_region = gold.LABEL_PREFIX + contract.region
    nulls = summary.agg(
        F.sum("null_months").alias(month), F.sum("null_amounts").alias(contract.amount)
    ).unpivot([], [month, contract.amount], "column", "null_rows")
    out: dict[str, tuple[str, DataFrame]] = {
        "not_null_staging": (ERROR, nulls.where("null_rows > 0")),
        "not_null_service": (ERROR, quality.not_null_counts(
            service, SERVICE_MART,
            [NotNull(month), NotNull(contract.service), NotNull(contract.amount),
             NotNull(contract.reimbursed)])),
        "not_null_service_label": (WARN, quality.not_null_counts(
            service, SERVICE_MART, [NotNull(label_service, WARN)])),
        "not_null_region": (ERROR, quality.not_null_counts(
            region, REGION_MART,
            [NotNull(month), NotNull(contract.region), NotNull(contract.amount),
             NotNull(contract.reimbursed)])),
        "not_null_region_label": (WARN, quality.not_null_counts(
            region, REGION_MART, [NotNull(label_region, WARN)])),
        "unique_labels": (ERROR, quality.unique_grain(labels, ["code_column", "code"])),
        "unique_service": (ERROR, quality.unique_grain(service, [month, contract.service])),
        "unique_region": (ERROR, quality.unique_grain(region, [month, contract.region])),
        "missing_labels": (WARN, quality.without_label(code_counts, labels)),
    }
    for mart_name, mart in ((SERVICE_MART, service), (REGION_MART, region)):
        out[f"totals_{mart_name}"] = (
            ERROR,
            quality.totals_match(mart, summary, month, [contract.amount, contract.reimbursed]),
        )
    return out


def code_counts(spark: SparkSession, silver: TableRef, codes: TableRef, contract: Contract) -> DataFrame:
    """Rows by code of all of silver, from the counts kept for each month. A month whose counts are
    absent, or were made from another version of it, is counted now."""
    shown, kept = silver.months(spark), codes.months(spark) or {}
    if shown is None:
        return quality.code_counts(silver.read(spark), contract)
    fresh = [m for m in shown if kept.get(m, {}).get("made_from") == shown[m]["version"]]
    stale = [m for m in shown if m not in fresh]
    counts = codes.read(spark, fresh) if fresh else None
    if stale or counts is None:
        now = quality.monthly_code_counts(silver.read(spark, stale), contract)
        counts = now if counts is None else counts.unionByName(now)
    return quality.merged_code_counts(counts)


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A small result kept under the shared folder, so that what follows reads it, not silver."""
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_gold(
    spark: SparkSession,
    silver: TableRef,
    labels: TableRef,
    service_table: TableRef,
    region_table: TableRef,
    contract: Contract,
    fail_on_error: bool = True,
    months: list[str] | None = None,
    codes: TableRef | None = None,
) -> list[CheckResult]:
    """Write both marts, then run every check on what was written.

    Without ``months`` every month is rebuilt; with ``months`` only those silver partitions are read
    (and those that hold rows without a processing month), and only those mart partitions replaced,
    so a monthly run costs one month, not the whole history. Checks then cover the rebuilt months.
    ``codes``: the rows by code kept by the silver job; with it the label audit covers every month in
    any run, without it the months that are read.

    Errors raise DataTestError after all checks ran (unless ``fail_on_error`` is False);
    warnings are returned with the other results.
    """
    silver_df = silver.read(spark)
    if months:
        months = checked_months(months)
        month = F.col(contract.processing_month)
        shown = silver.months(spark)
        if shown is not None:
            silver_df = silver.read(spark, [m for m in shown if shown[m].get(NO_MONTH, 1)])
        silver_df = (
            read_months(spark, silver, months).where(month.isNotNull())
            .unionByName(silver_df.where(month.isNull()))
        )
    counts = code_counts(spark, silver, codes, contract) if codes else quality.code_counts(silver_df, contract)
    labels_df = labels.read(spark)
    staging = gold.staging_spend(silver_df, contract)
    spend = _written(spark, gold.monthly_spend_by_each(staging, contract), "gold-spend")
    stored = []
    for key, table, build in (
        (contract.service, service_table, gold.service_mart),
        (contract.region, region_table, gold.region_mart),
    ):
        mart = build(spend.where(F.col("axis") == key), labels_df, contract)
        mart = mart.select("*", gold.mart_month(contract))
        # few rows, clustered by month so that each month is one file
        clustered = mart.repartition(mart.columns[-1])
        if months:
            overwrite_months(clustered, table, [*months, gold.UNKNOWN_MONTH])
        else:
            overwrite_partitioned_table(clustered, table)
        if not table.is_catalog:  # the schema is known: no inference over the month folders
            table = TableRef(path=table.path, schema=mart.schema)
        stored.append(
            read_months(spark, table, [*months, gold.UNKNOWN_MONTH]) if months else table.read(spark)
        )

    summary = _written(spark, silver_summary(staging, contract), "gold-summary")
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), F.lit(severity).alias("severity"), "rows"
        )
        for name, (severity, df) in checks(summary, *stored, labels_df, counts, contract).items()
    ]
    # one job for every check: the scans run as concurrent stages, one round trip
    results = [
        CheckResult(r["name"], r["severity"], int(r["rows"]))
        for r in reduce(DataFrame.unionByName, counted).collect()
    ]
    errors = [r for r in results if r.severity == ERROR and r.rows]
    if errors and fail_on_error:
        raise DataTestError(", ".join(f"{r.name}: {r.rows} rows" for r in errors))
    return results
