"""Backoff-automaton scores against a plain bigram model."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from ledgerlake.llm import lm_score as op


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w] + [None]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def plain_scores(rows, history, pair):
    c, pairs = collections.Counter(), collections.Counter()
    for d, text in rows:
        if not held(d):
            t = tokens(text)
            c.update(t)
            pairs.update(zip(t, t[1:]))
    n, v = sum(c.values()), len(c)
    kept = {k: x for k, x in pairs.items() if x >= pair and min(c[k[0]], c[k[1]]) >= history}
    seen, kinds = collections.Counter(), collections.Counter()
    for (a, _), x in kept.items():
        seen[a] += x
        kinds[a] += 1

    def score(text):
        base, full, last = 0.0, 0.0, ""
        for w in tokens(text):
            p = (c[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            if kinds[last]:
                p *= 1 - (seen[last] - op.DISCOUNT * kinds[last]) / c[last]
            if (last, w) in kept:
                p += (kept[last, w] - op.DISCOUNT) / c[last]
            full += math.log10(p)
            last = w
        return base, full

    return [(d, held(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, *score(t)) for d, t in rows]


def key(row):
    return (row[0] is None, row[0] or 0, row[2], row[5])


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_scores(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    rng = random.Random(7)
    vocab = ["The", "of", "a", "Éa", "b\x1cc", "\x85"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, weights=[30] * 6 + [1] * 60, k=rng.randint(0, 40)))) for i in range(150)]
    rows += [(None, "the of"), (3, None), (3, None), (900, " \n\t"), (901, "never seen of the"), (902, "a " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS block", "2 AS x").repartition(3)
    got = sorted(map(tuple, op.score_texts(docs, history_share=0.005, pair=2).collect()), key=key)
    trained = sum(len(tokens(t)) for d, t in rows if not held(d))
    want = sorted(plain_scores(rows, math.ceil(0.005 * trained), 2), key=key)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:])


def test_rare_pairs_count_at_any_size(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["the", "of", "a", "to"], k=900) + [f"r{i % 150}", f"s{i % 150}", f"t{i}"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, op.score_texts(docs).collect()), key=key)
    assert got[0][4] > 200_000  # a share of the tokens would leave out words seen once or twice
    for g, w in zip(got, sorted(plain_scores(rows, 1, 1), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:])


def test_weights_of_a_state_add_up():
    counts = np.array([50, 30, 15, 5])
    arcs = np.array([0 << 32 | 1, 0 << 32 | 2])  # from word 0 to words 1 and 2
    model = op.Automaton(
        counts, np.array([True] * 3 + [False]), 100, 4, np.array([40, 0, 0, 0]), np.array([2, 0, 0, 0]), arcs, np.array([25, 15])
    )
    after = [10 ** model.read(np.array([0, w]), np.array([2]))[1] for w in range(4)]
    unknown = model.fail[0] * op.ADD / (100 + op.ADD * 5)
    assert sum(after) + unknown == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    assert op.score_texts(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    alone = spark.createDataFrame([(None, "a b")], "doc_id bigint, text string")
    row = op.score_texts(alone).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 3, 0, 0, 0.0)


@pytest.mark.parametrize("pair", [1, 3])
def test_many_buckets_and_units(spark, monkeypatch, pair):
    monkeypatch.setattr(op, "BLOCK_BYTES", 700)
    monkeypatch.setattr(op, "BUCKET_TOKENS", 150)
    monkeypatch.setattr(op, "CAP", 30)  # pairs of frequent words are dealt to several units
    rng = random.Random(5)
    vocab = ["the", "of", "a"] + [f"w{i}" for i in range(40)]
    rows = [
        (i, " ".join(rng.choices(vocab, weights=[40] * 3 + [1] * 40, k=60) + ["only", f"x{i // 2}", f"y{i}", "the"]))
        for i in range(120)
    ]
    rows += [(500, "the of " * 200), (500, "the of " * 200), (None, "the only x3 y4 z of"), (501, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, op.score_texts(docs, pair=pair).collect()), key=key)
    for g, w in zip(got, sorted(plain_scores(rows, 1, pair), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:])


def test_packed_lists():
    rng = np.random.default_rng(3)
    lists = [np.zeros(0, np.int64), np.array([0]), rng.integers(0, 1 << 63, 500), np.arange(300), np.array([2**64 - 1], "u8")]
    for got, want in zip(op._unpack(op._pack(*lists)), lists, strict=True):
        assert (got == np.asarray(want).astype("u8")).all()
    sizes = np.array([0, 3, 0, 1, 5, 0])
    x = np.concatenate([np.sort(rng.integers(0, 1 << 48, n)) for n in sizes]).astype(np.uint64)
    heads = np.flatnonzero(np.diff(np.repeat(np.arange(6), sizes), prepend=-1))
    assert (op._sums(op._steps(x, heads), sizes) == x).all()
    assert (op._sums(op._steps(x[:3])) == x[:3]).all()
