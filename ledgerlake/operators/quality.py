"""Data checks. Each check is a DataFrame of offending rows: 0 rows means it passes.

Severity ``error`` fails a build, ``warn`` is reported only. Every check is one scan with partial
aggregation before the shuffle, so hot keys and hot codes are combined map-side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN, Contract
from ledgerlake.functions.ratio import ratio
from ledgerlake.operators.silver import (
    CARE_MONTH_INVALID,
    UNKNOWN_CARE_MONTHS,
    raw_month_text,
    silver_value,
)

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class NotNull:
    column: str
    severity: str = ERROR


def not_null_counts(df: DataFrame, table: str, checks: list[NotNull]) -> DataFrame:
    """(table, column, severity, null_rows) for every checked column with NULLs; one scan."""
    sums = df.agg(
        *[F.count_if(F.col(c.column).isNull()).cast("bigint").alias(c.column) for c in checks]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.column).alias("column"),
                F.lit(c.severity).alias("severity"),
                F.col(c.column).alias("null_rows"),
            )
            for c in checks
        ]
    )
    return (
        sums.select(F.inline(rows))
        .select(F.lit(table).alias("table"), "column", "severity", "null_rows")
        .where(F.col("null_rows") > 0)
    )


def unique_grain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their number of occurrences."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).cast("bigint").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def totals_match(
    gold: DataFrame, staging: DataFrame, month: str, columns: str | list[str]
) -> DataFrame:
    """Months where a gold total differs from the silver total (NULL-safe), per column:
    (column, month, total_gold, total_silver).

    Both sides are reduced to one row per month (all columns summed in the same aggregate, so
    several checks over the same silver share one aggregation) before the full outer join, so
    the join is tiny; a NULL month never matches and surfaces as a difference.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)

    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(month).agg(
            *[F.sum(c).cast("decimal(38,2)").alias(f"{side}_{c}") for c in columns]
        )

    g, s = sums(gold, "g").alias("g"), sums(staging, "s").alias("s")
    joined = g.join(s, F.col(f"g.{month}") == F.col(f"s.{month}"), "full")
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"g_{c}").alias("total_gold"),
                F.col(f"s_{c}").alias("total_silver"),
            )
            for c in columns
        ]
    )
    return (
        joined.select(
            F.coalesce(F.col(f"g.{month}"), F.col(f"s.{month}")).alias(month),
            F.inline(per_column),
        )
        .where(~F.col("total_gold").eqNullSafe(F.col("total_silver")))
        .select("column", month, "total_gold", "total_silver")
    )


def code_counts(silver: DataFrame, contract: Contract) -> DataFrame:
    """(code_column, code, lignes) for every non-NULL value of every code column.

    One scan: the code columns are unpivoted (Expand) and counted with partial aggregation,
    instead of one scan per column glued by UNION ALL.
    """
    codes = [(spec.name, spec.source) for spec in contract.code_specs]
    narrow = silver.select(*[F.col(name).alias(source) for name, source in codes])
    return (
        narrow.unpivot([], [source for _, source in codes], "code_column", "code")
        .where(F.col("code").isNotNull())
        .groupBy("code_column", "code")
        .agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))
    )


def monthly_code_counts(silver: DataFrame, contract: Contract) -> DataFrame:
    """``code_counts`` of each stored month: (code_column, code, lignes, month). The counts of some
    months add up to those of all (``merged_code_counts``)."""
    codes = [(spec.name, spec.source) for spec in contract.code_specs]
    narrow = silver.select(PARTITION_COLUMN, *[F.col(name).alias(source) for name, source in codes])
    return (
        narrow.unpivot(PARTITION_COLUMN, [source for _, source in codes], "code_column", "code")
        .where(F.col("code").isNotNull())
        .groupBy("code_column", "code", PARTITION_COLUMN)
        .agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))
        .select("code_column", "code", "lignes", PARTITION_COLUMN)
    )


def merged_code_counts(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("code_column", "code").agg(F.sum("lignes").cast("bigint").alias("lignes"))


def without_label(counts: DataFrame, labels: DataFrame) -> DataFrame:
    return counts.join(labels.select("code_column", "code"), ["code_column", "code"], "left_anti")


def missing_labels(silver: DataFrame, labels: DataFrame, contract: Contract) -> DataFrame:
    """Codes present in silver (all months) without a label: (code_column, code, lignes)."""
    return without_label(code_counts(silver, contract), labels)


def label_coverage(silver: DataFrame, labels: DataFrame, contract: Contract) -> DataFrame:
    """Per code column: rows with a code, rows whose code has a label, and the labelled share."""
    keys = labels.select("code_column", "code", F.lit(True).alias("labelled"))
    counted = code_counts(silver, contract).join(keys, ["code_column", "code"], "left")
    return counted.groupBy("code_column").agg(
        F.sum("lignes").cast("bigint").alias("lignes"),
        F.coalesce(F.sum(F.when(F.col("labelled"), F.col("lignes"))), F.lit(0))
        .cast("bigint")
        .alias("lignes_libellees"),
        F.count(F.lit(1)).cast("bigint").alias("codes"),
        F.count_if(F.col("labelled").isNull()).cast("bigint").alias("codes_sans_libelle"),
    ).withColumn(
        "couverture",
        ratio(F.col("lignes_libellees").cast("decimal(28,2)"), F.col("lignes").cast("decimal(28,2)")),
    )


def source_profile(bronze: DataFrame, contract: Contract) -> DataFrame:
    """What the raw extract looks like: one (indicator, lignes) row per indicator, one scan.

    Indicators: rows, negative amounts (kept, they are corrections), unknown care months (kept
    with a NULL care month), invalid care months, and unconvertible values per checked column.
    """
    care = contract.spec(contract.care_month)
    amount_source = contract.amount_source
    indicators: list[tuple[str, Column]] = [
        ("lignes", F.lit(True)),
        (
            f"montant_negatif:{amount_source}",
            F.col(amount_source).try_cast(contract.spec(contract.amount).dtype) < 0,
        ),
        ("mois_soins_inconnu", raw_month_text(care).isin(*UNKNOWN_CARE_MONTHS)),
        (
            CARE_MONTH_INVALID,
            ~raw_month_text(care).isin(*UNKNOWN_CARE_MONTHS) & silver_value(care).isNull(),
        ),
    ]
    indicators += [
        (
            f"non_convertible:{source}",
            F.col(source).isNotNull() & F.col(source).try_cast(dtype).isNull(),
        )
        for source, dtype in contract.checked_sources
    ]
    sums = bronze.agg(
        *[F.count_if(cond).cast("bigint").alias(f"i{i}") for i, (_, cond) in enumerate(indicators)]
    )
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("indicateur"), F.col(f"i{i}").alias("lignes"))
            for i, (name, _) in enumerate(indicators)
        ]
    )
    return sums.select(F.inline(rows))


def rows_per_month(df: DataFrame) -> DataFrame:
    """(month, lignes) of a month-partitioned frame."""
    return df.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))


def fingerprints(df: DataFrame, by: str) -> DataFrame:
    """(by, rows, sum_a, sum_b) of every partition: its rows as a multiset, whatever their order.

    Each row gives two 64-bit hashes, added up exactly, so parts of a partition add up too. NULLs are
    hashed by their place (a hash alone passes over them). One row a partition is shuffled by each task.
    """
    marked = [c for name in sorted(df.columns) for c in (F.col(name), F.col(name).isNull())]
    hashes = {"sum_a": F.xxhash64(*marked), "sum_b": F.xxhash64(F.lit("second"), *marked)}
    sums = [F.sum(h.cast("decimal(20,0)")).alias(name) for name, h in hashes.items()]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *sums)


def differing_partitions(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """(by) of partitions whose rows differ between two tables, NULL included."""
    facts = ["rows", "sum_a", "sum_b"]
    sides = [
        fingerprints(df.select(*left.columns), by).select(by, F.lit(n).alias("_side"), *facts)
        for n, df in enumerate((left, right))
    ]
    same = [(F.count_distinct(f) == 1) for f in facts]
    alike = (F.count(F.lit(1)) == 2) & same[0] & same[1] & same[2]
    return sides[0].unionByName(sides[1]).groupBy(by).agg(alike.alias("_alike")).where("NOT _alike").select(by)


def table_parity_by(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """``table_parity`` of large tables: partitions with equal fingerprints are left out first, rows of
    the others are compared exactly. ``by`` is a column that the tables are stored by: the differing
    values reach the driver, so no other folder is opened for the second reading. Columns whose types
    differ between the tables count as different and are compared exactly."""
    differing = [row[by] for row in differing_partitions(left, right, by).collect()]
    chosen = F.col(by).isin(*[d for d in differing if d is not None])
    if None in differing:
        chosen = F.col(by).isNull() | chosen
    return table_parity(left.where(chosen), right.where(chosen))


def table_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one table only, as multisets (duplicates count): ``side`` says which one.

    Both tables are read once: rows count +1 on the left and -1 on the right, equal rows meet in
    one aggregation (combined by each task first), and what is left over is repeated.
    """
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    rest = both.groupBy(*left.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "left_only").otherwise("right_only")
    copies = F.explode(F.array_repeat(F.lit(1), F.abs("_n").cast("int")))
    return rest.select(*left.columns, side.alias("side"), copies.alias("_copy")).drop("_copy")
