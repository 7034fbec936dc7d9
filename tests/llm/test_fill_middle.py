"""Learned rank index: bounded and exact; transformed texts against a plain line-by-line version."""

import hashlib
import re

import numpy as np
import pytest

from ledgerlake.llm import fill_middle as op

LINES = re.compile(r"[^\n]*\n|[^\n]+")


@pytest.mark.parametrize("error", [0, 1, 7, 255])
@pytest.mark.parametrize("kind", ["even", "random", "jumps", "equal", "one", "none"])
def test_index_is_bounded_and_exact(kind, error):
    rng = np.random.default_rng(1)
    steps = {
        "even": np.full(5000, 40), "random": rng.integers(0, 200, 5000),
        "jumps": np.where(rng.random(3000) < 0.01, 10**9, 3), "equal": np.zeros(700, int),
        "one": np.array([5]), "none": np.zeros(0, int),
    }[kind]
    offsets = np.cumsum(steps)
    index = op.fit_rank_index(offsets, error)
    ranks = np.arange(len(offsets))
    if len(offsets):
        assert np.abs(index.predict(ranks) - offsets).max() <= error
        assert (index.offsets(ranks) == offsets).all()
    if kind in ("even", "equal") and error:
        assert len(index.first) == 1
    if kind == "random" and error == 255:
        assert len(index.first) < len(offsets) / 10


def brute(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    lines = LINES.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    pre, mid, suf = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, len(lines), "plain", None, None, text, text)
    if h[3] % 100 < spm_rate:
        return (doc_id, len(lines), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text)
    return (doc_id, len(lines), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text)


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb", "é\n日本\r\n😀", "x <P> y\nz", "<S>", "no <M", "a\n<M>\n",
    "\u2028a\x0bb\x85c\n", "word " * 40_000, "l\n" * 30_000, ("long " * 900 + "\n") * 30, "trap $1 \\n \\0\n{}\n%s",
]


@pytest.mark.parametrize("rate,spm_rate,error", [(100, 50, 255), (60, 0, 1), (100, 100, 40), (0, 50, 255)])
def test_against_plain_lines(spark, rate, spm_rate, error):
    rows = [(i, t) for k, t in enumerate(TEXTS) for i in (k, 1000 + k, -k)] + [(None, "a\nb\nc"), (5, "a\nb"), (5, "a\nb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = op.fill_in_middle(docs, rate=rate, spm_rate=spm_rate, error=error)
    found = found.withColumn("restored", op.restore(found.fim_text, found.fim_form))
    got = [
        (r.doc_id, r.n_lines, r.fim_form, r.prefix_chars, r.middle_chars, r.fim_text, r.restored) for r in found.collect()
    ]
    assert sorted(map(repr, got)) == sorted(repr(brute(*r, rate=rate, spm_rate=spm_rate)) for r in rows)


def test_many_small_batches(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE_BYTES", 20)
    rows = [(i, "\n".join("x" * (i % 7) for _ in range(i % 5))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = op.fill_in_middle(docs).collect()
    assert sorted((r.doc_id, r.fim_text) for r in got) == sorted((i, brute(i, t)[5]) for i, t in rows)


def test_columns_that_clash_and_empty_table(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb", "own", 5, [1])], "doc_id bigint, text string, fim_form string, `n.lines` int, z array<int>"
    )
    got = op.fill_in_middle(docs)
    assert got.columns == ["doc_id", "text", "n.lines", "z", "n_lines", "fim_form", "prefix_chars", "middle_chars", "fim_text"]
    assert got.first().fim_form in ("psm", "spm")
    assert op.fill_in_middle(docs.limit(0)).collect() == []
