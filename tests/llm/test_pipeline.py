"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlake.llm import registry
from tests.conftest import SMOKE_DIR


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries() and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")


def test_stages_on_odd_rows(spark, documents):
    item = spark.read.parquet(f"{SMOKE_DIR}/benchmark.parquet").first().text
    text = documents.where("lang = 'en' AND length(text) > 900").first().text
    extra = [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, text + " more", "en", "s", 5), (9003, text, "en", None, 7),
             (9003, text, "en", None, 7), (9004, text[:300] + "\n" + item + "\n" + text[300:500], None, "s", 3)]
    more = spark.createDataFrame(extra, documents.schema)
    docs = documents.union(more).selectExpr("*", "1 AS _lid", "2 AS fp", "'z' AS `a.b`", "3 AS n_removed", "4 AS _near")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SMOKE_DIR)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not left & {9001, 9002, 9003, 9004}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE_DIR)
    assert last.count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), SMOKE_DIR).collect() == []


def test_line_stage_counts_characters(spark):
    rows = [(1, "a\nb\nc", "en", "s", 5), (2, "a\nb\nc\nd", "en", "s", 99), (3, "q", "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup_stage(spark, docs, SMOKE_DIR).collect()}
    assert got == {1: ("a\nb\nc", 5), 2: ("d", 1), 3: ("q", None)}


def test_run(spark, documents):
    out = corpus_pipeline.run(spark, SMOKE_DIR)
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) and 0.5 * documents.count() < len(ids) < documents.count()
    assert out.where(F.col("n_tokens").isNull()).count() == 0
