"""Held-out accuracy, evidence and odd rows of the language identification."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import langid as op
from tests.conftest import SMOKE_DIR


def test_trigrams_of_letters():
    gram, counts = op.trigrams(pa.array(["Ab", None, "12 !", "É", "ab 7 ab"]))
    assert counts.tolist() == [2, 0, 0, 2, 6]
    assert (gram[:2] == op.trigrams(pa.array(["aB"]))[0]).all()


def judge(frame, langs, model, declared="lang", host="source", **more):
    return op.identify_language(frame, langs, model, F.col("text"), F.col(declared), F.col(host), **more)


def test_held_out_accuracy_from_text_alone(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    langs, model = op.fit_text_model(docs.where("doc_id % 2 = 0"))
    assert langs == ["de", "en", "es", "fr"]
    rest = docs.where("doc_id % 2 = 1").withColumn("none", F.lit(None).cast("string"))
    rows = judge(rest, langs, model, "none", "none").collect()
    assert len(rows) == rest.count()
    assert np.mean([r.lang_id == r.lang for r in rows]) >= 0.97
    assert np.mean([r.lang_ok for r in rows]) >= 0.99


def test_evidence_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    langs, model = op.fit_text_model(docs)
    english = docs.where("lang = 'en' AND length(text) > 500").first().text
    rows = [(1, english, "en-US", "a.b.com"), (2, None, "en", None), (3, "", "en", "a.b.com"), (4, "12 345 !!", "en", "x"),
            (5, "xqj zvk wqx jjq qqz vvx kzx " * 40, None, "y"), (6, english, None, "a.b.com"), (6, english, None, "a.b.com"),
            (None, english * 200, "tlh", "z")] + [(100 + i, english, "en", "hot.de") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").selectExpr(
        "*", "1 AS _lid", "2 AS _host", "3 AS lang_id", "4 AS `a.b`"
    )
    got = judge(frame, langs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "_lid", "_host", "a.b", *op.RESULTS]
    found = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert all(not found[i].lang_ok and found[i].lang_id is None for i in (2, 3, 4))
    assert found[5].lang_id == op.UND and not found[5].lang_ok
    assert found[1].lang_id == found[6].lang_id == found[None].lang_id == "en" and found[6].lang_ok
    # a word that several languages share follows the host
    weak = spark.createDataFrame([(i, "a", None, "hot.de") for i in range(2)] + rows[8:], frame.select("doc_id", "text", "lang", "source").schema)
    assert {r.lang_id for r in judge(weak, langs, model).where("doc_id < 2").collect()} == {"en"}
    assert judge(frame.limit(0), langs, model).collect() == []


def test_no_labelled_rows(spark):
    none = spark.createDataFrame([(1, "some text", None, None)], "doc_id bigint, text string, lang string, source string")
    langs, model = op.fit_text_model(none)
    assert langs == [] and [r.lang_ok for r in judge(none, langs, model).collect()] == [False]


def test_host_priors_by_hand(spark):
    rows = [("a.x.com", [1.0, 0.0, 0.0])] * 3 + [("b.x.com", [0.0, 1.0, 0.0])] + [("c.org", [0.0, 1.0, 0.0])]
    got = {r["_host"]: np.exp(r["_prior"]) for r in op.host_priors(spark.createDataFrame(rows, "_host string, _soft array<double>"), 3, 2.0).collect()}
    even = np.array([(1 - op.UND_PRIOR) / 2] * 2 + [op.UND_PRIOR])
    root = (np.array([3, 2, 0]) + 2 * even) / 7
    com = (np.array([3, 1, 0]) + 2 * root) / 6
    site = (np.array([3, 1, 0]) + 2 * com) / 6
    np.testing.assert_allclose(got["a.x.com"], (np.array([3, 0, 0]) + 2 * site) / 5)


def test_markup(spark):
    html = '<!DOCTYPE html><HTML class=a lang="de-AT"><script>var a="<p>";</script><!-- x --><p>Hallo <b>Welt</b></p>'
    row = spark.createDataFrame([(html,), (None,)], "html string").select(
        op.markup_language(F.col("html")).alias("lang"), op.page_text(F.col("html")).alias("text")
    ).collect()
    assert row[0].lang == "de-AT" and row[0].text.split() == ["Hallo", "Welt"] and row[1].text is None


def test_rare_and_many_languages_are_modelled(spark):
    rng = np.random.default_rng(3)

    def text(letters, words):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(words))

    common = [(text("abcdefgh", 4), "en") for _ in range(9000)]
    rare = [(text("qvwxyz", 40), "tlh") for _ in range(6)]  # under 1/4000 of 30,000 rows
    rows = [*common, *common, *common, *([("the same text again", "en")] * 3000), *rare, *rare]
    many = [(text("klmnop", 6), "x" + chr(97 + k // 26) + chr(97 + k % 26)) for k in range(70) for _ in range(5)]
    frame = spark.createDataFrame(rows + many, "text string, lang string").repartition(4)
    langs, model = op.fit_text_model(frame)
    assert langs == sorted({"en", "tlh", *(x for _, x in many)})
    # the model of a few texts counts each of them once
    gram, _ = op.trigrams(pa.array([x for x, _ in rare]))
    counts = np.bincount(gram, minlength=op.GRAMS) + op.SMOOTH
    assert np.allclose(model[langs.index("tlh")], np.log(counts / counts.sum()), atol=1e-5)
