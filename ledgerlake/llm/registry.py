"""Queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bpe,
    decontam,
    embed_dedup,
    exact_dedup,
    fill_middle,
    langid,
    line_dedup,
    lm_score,
    prefix_trie,
    secret_scan,
    simhash,
    token_output,
    url_filter,
)
from ledgerlake.llm.common import materialize
from ledgerlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_output.write_tokens(_table(spark, sf_dir, "documents"), path, end_id=1)
    return token_output.token_digest(files)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.bpe_roundtrip(_table(spark, sf_dir, "documents"), path)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(_table(spark, sf_dir, "documents"))


def op7_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(_table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_removed"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    langs, model = langid.fit_text_model(docs)
    found = langid.identify_language(
        docs, langs, model, F.col("text"), F.col("lang"), F.col("source"), carry=["doc_id"]
    )
    return found.select("doc_id", "lang_id", F.round("lang_posterior", 6).alias("posterior"), F.col("lang_ok").alias("kept"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over raw pages: text of the markup, its declared language, the url's host."""
    langs, model = langid.fit_text_model(_table(spark, sf_dir, "documents"))
    html = F.col("html")
    found = langid.identify_language(
        _table(spark, sf_dir, "pages"), langs, model, langid.page_text(html),
        langid.markup_language(html), url_filter.host_of(F.col("url")), carry=["page_id"],
    )
    return found.select("page_id", "lang_id", F.round("lang_posterior", 6).alias("posterior"), F.col("lang_ok").alias("kept"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_sequences(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuild(materialize(turns, "turn-sequences")))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fill_middle.restore(F.col("fim_text"), F.col("fim_form"))
    return found.select(
        "doc_id", F.col("n_lines").alias("n"), F.col("fim_form").alias("form"), "prefix_chars", "middle_chars",
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(exact_dedup.fold_case(F.col("text")).cast("binary"), 256)
    return exact_dedup.find_copies(_table(spark, sf_dir, "documents"), text_sha256=digest)


QUERIES: dict[str, Query] = {
    "op1_token_output": op1_token_output,
    "op2_url_filter": op2_url_filter,
    "op3_secret_scan": op3_secret_scan,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_lm_score": op6_lm_score,
    "op7_embed_dedup": op7_embed_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_decontam": op10_decontam,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fill_middle": op12_fill_middle,
    "op13_exact_dedup": op13_exact_dedup,
    "language_id_pages": language_id_pages,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": url_filter.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_fill_middle": fill_middle.SQL,
    "op13_exact_dedup": exact_dedup.SQL,
}
