"""A training-data pipeline over ``documents``: five stages, each written and read again.

language ID (rejected documents go), line dedup, SimHash near-dedup (the smallest doc_id of each
group stays), benchmark decontamination (documents with a leaked item go), BPE encoding and
decoding (digests of every document that is left).

Extra columns are carried to the last stage but one. Rows without a ``doc_id`` are judged like any
other, each by its own text; of the rows of a SimHash component one stays, that with the smallest
``doc_id`` (one without only where no row of the component has one).

Cases: null and empty texts have no language of their own and are judged by declared language and
host, no lines to cut, and fingerprint zero, so one of them stays; very long texts are read whole, in
parts; rows that repeat are near copies of each other; an empty table gives an empty result; columns
named like those that a stage adds are carried unharmed. ``documents`` must have ``n_chars``.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from ledgerlake.llm import bpe, decontam, langid, line_dedup, simhash  # noqa: E402
from ledgerlake.llm.common import column, free_prefix, materialize  # noqa: E402
from ledgerlake.session import configure  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    langs, model = langid.fit_text_model(docs)
    found = langid.identify_language(
        docs, langs, model, F.col("text"), F.col("lang"), F.col("source")
    )
    return found.where("lang_ok").select(*map(column, docs.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = free_prefix(docs.columns, "_removed")
    found = line_dedup.dedup_lines(docs, removed_col=removed)
    count = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType)).select(*map(column, docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs).select(*map(column, docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.drop_contaminated(docs, benchmark).select(*map(column, docs.columns))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_roundtrip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_stage),
]

# SQL can express neither the fingerprints nor the tokenizer; tests/llm checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
