"""Links of vectors against all cosines."""

import numpy as np
import pytest

from ledgerlake.llm import embed_dedup as op
from tests.conftest import SMOKE_DIR


def brute(ids, vectors, cosine=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = unit @ unit.T >= cosine
    label = np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return near.sum(1) - 1, label
        label = new


@pytest.mark.parametrize("most", [1024, 60])
def test_clusters(spark, most):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(25, 24))
    vectors = np.concatenate([
        rng.normal(size=(150, 24)),
        *(c + rng.normal(scale=s, size=(n, 24)) for c, s, n in zip(centres, np.linspace(0.05, 0.35, 25), [8] * 24 + [160])),
    ])
    vectors = np.concatenate([vectors, vectors[:20], 3.5 * vectors[20:40]])
    ids = list(range(100, 100 + len(vectors)))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in op.link_vectors(rows.repartition(4), most=most).collect()}
    links, label = brute(ids, vectors)
    found = np.array([got[i].n_links for i in ids])
    assert (found <= links).all() and found.sum() >= 0.99 * links.sum()
    assert np.mean([got[i].component_id == x for i, x in zip(ids, label)]) >= 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)


def test_given_table(spark):
    table = spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet")
    rows = table.collect()
    links, label = brute([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    got = {r.vec_id: r for r in op.link_vectors(table).collect()}
    assert sum(got[r.vec_id].n_links for r in rows) >= 0.98 * links.sum()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, []),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1e308, 1e307]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (11, [inf, 0.0]),
            (12, [1e-200, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS node", "2 AS v")
    got = op.link_vectors(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        linked = r.vec_id in (1, 2, 8, 9, 12)
        assert r.n_links == (5 if linked else 0)
        assert r.component_id == (1 if linked else r.vec_id)
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
    assert op.link_vectors(frame.limit(0)).collect() == []


def test_least_collisions_keeps_the_recall():
    rng = np.random.default_rng(0)
    count = (np.abs(rng.normal(size=(20_000, op.LINES))) <= op.WINDOW).sum(1)
    least = op.least_collisions(op.LINES, op.WINDOW, 0.99)
    assert (count >= least).mean() >= 0.985 and (count >= least + 1).mean() < 0.99
