"""Profiles of raw months that add up: what each raw column holds, in a few kilobytes a month.

A month's profile has one row for each raw column: exact counts of rows, of NULLs and of texts that do
not convert, and three built-in sketches: distinct texts (HyperLogLog), values of a checked column (KLL
quantiles) and its most frequent texts that do not convert. A month that is loaded again replaces its
profile; the profile of any set of months, or of all, is the merged one, and no bronze row is read for it.

Errors, whatever the number of months merged: distinct texts within ``DISTINCT_ERROR`` (three standard
errors); a quantile's rank within ``RANK_ERROR``; a text's count within ``TEXT_ERROR`` of the texts that
do not convert in its column, exact while fewer than ``TEXTS`` differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN, Contract

LG_K = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
KLL_K = 400
RANK_ERROR = 0.01
TEXTS = 1_000
TEXT_ERROR = 3.5 / TEXTS
COUNTS = ("lignes", "vides", "non_convertibles")


def monthly_profile(bronze: DataFrame, contract: Contract) -> DataFrame:
    """(colonne, counts, sketches, month) of each month and raw column: one scan, sketches are made by
    each task and merged after the shuffle."""
    types = dict(contract.checked_sources)
    cells = []
    for name in contract.raw_columns:
        text = F.col(name)
        typed = text.try_cast(types[name]) if name in types else F.lit(None)
        bad = F.when(typed.isNull(), text) if name in types else F.lit(None)
        cells.append(
            F.struct(
                F.lit(name).alias("colonne"), text.alias("texte"),
                typed.cast("double").alias("valeur"), bad.cast("string").alias("refuse"),
            )
        )
    rows = bronze.select(PARTITION_COLUMN, F.inline(F.array(*cells)))
    return (
        rows.groupBy(PARTITION_COLUMN, "colonne")
        .agg(
            F.count(F.lit(1)).alias("lignes"),
            F.count_if(F.col("texte").isNull()).alias("vides"),
            F.count("refuse").alias("non_convertibles"),
            F.hll_sketch_agg("texte", LG_K).alias("distincts"),
            F.kll_sketch_agg_double("valeur", F.lit(KLL_K)).alias("valeurs"),
            F.expr(f"approx_top_k_accumulate(refuse, {TEXTS}) FILTER (WHERE refuse IS NOT NULL)").alias("refuses"),
        )
        .select("colonne", *COUNTS, "distincts", "valeurs", "refuses", PARTITION_COLUMN)
    )


def merged_profile(monthly: DataFrame) -> DataFrame:
    """The profile of all the months of ``monthly`` together; a few rows for each month are merged."""
    return monthly.groupBy("colonne").agg(
        *(F.sum(c).cast("bigint").alias(c) for c in COUNTS),
        F.hll_union_agg("distincts").alias("distincts"),
        F.kll_merge_agg_double("valeurs").alias("valeurs"),
        F.expr(f"approx_top_k_combine(refuses, {TEXTS})").alias("refuses"),
    )


def distinct_texts(profile: DataFrame) -> DataFrame:
    """(colonne, counts, distincts): distinct texts, estimated."""
    return profile.select("colonne", *COUNTS, F.hll_sketch_estimate("distincts").alias("distincts"))


def quantiles(profile: DataFrame, shares: list[float]) -> DataFrame:
    """(colonne, part, valeur) of the columns that hold converted values."""
    # an empty sketch has no quantiles, and asking it for some is an error
    filled = profile.where(F.kll_sketch_get_n_double("valeurs") > 0)
    asked = F.array(*(F.lit(float(s)) for s in shares))
    found = filled.select("colonne", F.kll_sketch_get_quantile_double("valeurs", asked).alias("v"))
    pairs = F.arrays_zip(asked.alias("part"), F.col("v").alias("valeur"))
    return found.select("colonne", F.inline(pairs).alias("part", "valeur"))


def frequent_texts(profile: DataFrame, n: int = 10) -> DataFrame:
    """(colonne, texte, lignes): the most frequent texts of each column that do not convert."""
    top = F.expr(f"approx_top_k_estimate(refuses, {n})")
    return (
        profile.where("non_convertibles > 0")
        .select("colonne", F.inline(top).alias("texte", "lignes"))
        .where("texte IS NOT NULL")
    )
