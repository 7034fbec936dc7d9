"""Label dimension: one label per (code column, code), merged from several sources.

Each source is a DataFrame of raw rows with an explicit position (file order is not a DataFrame
property). Per source, codes are normalised, labels cleaned, blank codes/labels dropped, and one
label per code kept (first or last by position). Sources are then merged by per-column priority;
complements only fill codes no source has. All of it is grouping and joins: the work is spread
over the cluster however large the sources are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.codes import clean_label, is_blank, normalize_code

# --- Fixed values ---------------------------------------------------------------------------
COMPLEMENT_SOURCE = "Complément du projet"
DIMENSION_COLUMNS = ("code_column", "code", "libelle", "source")
# --- end of fixed values -------------------------------------------------------------------


class LabelError(ValueError):
    """Inconsistent label inputs (complement overlapping a source, unknown code column)."""


def _clean(rows: DataFrame, code: str, label: str, position: str) -> DataFrame:
    return rows.where(~is_blank(F.col(code)) & ~is_blank(F.col(label))).select(
        normalize_code(F.col(code)).alias("code"),
        clean_label(F.col(label)).alias("libelle"),
        F.col(position).alias("pos"),
    )


def first_label_per_code(rows: DataFrame, code: str, label: str, position: str) -> DataFrame:
    """Code-list semantics: for a repeated code the FIRST row (lowest position) wins."""
    return (
        _clean(rows, code, label, position)
        .groupBy("code")
        .agg(F.min_by("libelle", F.struct("pos", "libelle")).alias("libelle"))
    )


def last_label_per_code(rows: DataFrame, code: str, label: str, position: str) -> DataFrame:
    """Lexicon-sheet semantics: for a repeated code the LAST row (highest position) wins."""
    return (
        _clean(rows, code, label, position)
        .groupBy("code")
        .agg(F.max_by("libelle", F.struct("pos", "libelle")).alias("libelle"))
    )


def as_source(labels: DataFrame, code_column: str, source: str, priority: int) -> DataFrame:
    """Tag a (code, libelle) frame as one source of one code column."""
    return labels.select(
        F.lit(code_column).alias("code_column"),
        "code",
        "libelle",
        F.lit(source).alias("source"),
        F.lit(priority).alias("priority"),
    )


def merge_by_priority(sources: DataFrame) -> DataFrame:
    """For each (code column, code) the label of the highest-priority source (lowest number)."""
    best = F.min_by(F.struct("libelle", "source"), F.struct("priority", "source"))
    return (
        sources.groupBy("code_column", "code")
        .agg(best.alias("best"))
        .select("code_column", "code", "best.libelle", "best.source")
    )


def normalized_complements(complements: DataFrame) -> DataFrame:
    """Complements (code_column, code, libelle, justification) with canonical codes, one row for
    each code: of rows that repeat one, the LAST (highest ``pos``) wins."""
    last = F.max_by(F.struct("libelle", "justification"), F.struct("pos", "libelle"))
    return (
        complements.withColumn("code", normalize_code(F.col("code")))
        .groupBy("code_column", "code")
        .agg(last.alias("last"))
        .select("code_column", "code", "last.libelle", "last.justification")
    )


def complement_conflicts(complements: DataFrame, merged: DataFrame) -> DataFrame:
    """Complements for a code some source already labels (must be empty)."""
    return normalized_complements(complements).join(
        merged.select("code_column", "code"), ["code_column", "code"], "left_semi"
    )


def complement_unknown_columns(complements: DataFrame, code_columns: DataFrame) -> DataFrame:
    """Complements aimed at a code column that is not in the contract (must be empty)."""
    return normalized_complements(complements).join(
        code_columns.select("code_column"), "code_column", "left_anti"
    )


def column_positions(spark, code_columns: list[str]) -> DataFrame:
    return spark.createDataFrame(
        list(zip(code_columns, range(len(code_columns)))), "code_column string, position int"
    )


def dimension(sources: DataFrame, complements: DataFrame) -> DataFrame:
    """Merged sources plus the complements (no ordering, no checks)."""
    comp = normalized_complements(complements).select(
        "code_column", "code", "libelle", F.lit(COMPLEMENT_SOURCE).alias("source")
    )
    return merge_by_priority(sources).unionByName(comp)


def dimension_problems(dim: DataFrame, code_columns: list[str]) -> DataFrame:
    """What is wrong with a dimension: (problem, code_column, code, rows).

    ``repeated``: a code labelled more than once; ``blank``: a code without label or source text;
    ``absent``: a code column of the contract without any label."""
    counted = dim.groupBy("code_column", "code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_blank(F.col("libelle")) | is_blank(F.col("source"))).alias("blank"),
    )
    positions = column_positions(dim.sparkSession, code_columns)
    absent = positions.join(counted, "code_column", "left_anti").select(
        F.lit("absent").alias("problem"), "code_column", F.lit(None).cast("string").alias("code"),
        F.lit(0).cast("bigint").alias("rows"),
    )
    found = counted.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("rows") > 1, F.struct(F.lit("repeated").alias("problem"), "rows")),
                    F.when(
                        F.col("blank") > 0,
                        F.struct(F.lit("blank").alias("problem"), F.col("blank").alias("rows")),
                    ),
                )
            )
        ).alias("x"),
        "code_column",
        "code",
    )
    return found.select("x.problem", "code_column", "code", "x.rows").unionByName(absent)


def build_dimension(
    sources: DataFrame, complements: DataFrame, code_columns: list[str]
) -> DataFrame:
    """The whole dimension, checked, in (declared column order, code) order.

    Raises LabelError when a complement targets an unknown column or a code that a source labels,
    and when the result repeats a code or has a blank label. One job; only offending rows, bounded
    by the complement file, reach the driver.
    """
    positions = column_positions(sources.sparkSession, code_columns)
    merged = merge_by_priority(sources)
    dim = dimension(sources, complements)

    def offending(kind: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "code_column", "code")

    problems = dimension_problems(dim, code_columns).where("problem <> 'absent'")
    faults = (
        offending("aimed at a column that is not in the contract", complement_unknown_columns(complements, positions))
        .unionByName(offending("already labelled by a source", complement_conflicts(complements, merged)))
        .unionByName(offending("repeated or blank", problems))
        .orderBy("kind", "code_column", "code")
        .collect()
    )
    if faults:
        raise LabelError("; ".join(f"{f['code_column']} {f['code']}: {f['kind']}" for f in faults))
    return (
        dim.join(F.broadcast(positions), "code_column")
        .orderBy("position", "code")
        .select(*DIMENSION_COLUMNS)
    )
