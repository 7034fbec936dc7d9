"""Radix groups against grouping by the folded text itself."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import exact_dedup as op

_FOLD = str.maketrans(op._UPPER, op._UPPER.lower())


def fold(text):
    return (text or "").translate(_FOLD)


def brute(rows):
    """(id, keep_id, group_size) of every row, and how many rows stay."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    top = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    want = [(i, top[fold(t)], len(groups[fold(t)])) for i, t in rows]
    return sorted(want, key=repr), len(groups)


def texts():
    rng = random.Random(3)
    long = "".join(rng.choice("abc dé\n") for _ in range(5000))
    same_start = [long[:n] + c for n in (63, 64, 65, 1087, 1088, 1089, 4990) for c in ("x", "y", "X", "")]
    return [None, "", "", "a", "A", "É", "é", "ß", "SS", long, long.upper(), long, long[:-1] + "!",
            *same_start, *same_start, "\x00", "\x00\x00", "İ", "i̇", "K"]


@pytest.mark.parametrize("digit,growth", [(64, 16), (1, 2), (3, 4)])
def test_against_grouping(spark, monkeypatch, digit, growth):
    monkeypatch.setattr(op, "DIGIT", digit)
    monkeypatch.setattr(op, "GROWTH", growth)
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts())]
    rows += [(3, "a"), (3, "a"), (900, "unique"), (901, "Twice"), (901, "twice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = op.find_copies(docs).collect()
    want, kept = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == kept
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(1, "Same", "a", 7), (2, "same", "b", 8), (None, None, "c", 9), (None, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `kept` string, `copies.x` int")
    got = op.drop_copies(docs)
    assert got.columns == docs.columns
    rows = [tuple(r) for r in got.collect()]
    assert (2, "same", "b", 8) in rows and len(rows) == 2
    carried = op.find_copies(docs, extra=F.col("`copies.x`")).collect()
    assert sorted(r.extra or 0 for r in carried) == [0, 7, 8, 9]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.find_copies(docs).collect() == [] and op.drop_copies(docs).collect() == []


def test_unique_texts_leave_in_the_first_round(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc "), "id").alias("text"))
    plan = op.find_copies(docs)
    assert plan.where("kept and group_size = 1").count() == 300
