"""Fingerprints and components against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from ledgerlake.llm import simhash as op
from ledgerlake.llm.components import connected_components


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]


def plain_print(text):
    words = plain_words(text)
    if not words:
        return 0
    rows = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_fingerprints():
    texts = [None, "", " \n", "A", "a b", "É É \x1c x\x0by\x0cz a a a a a", "one two three four five six", "w " * 3000]
    assert op.fingerprints(pa.array(texts)).tolist() == [plain_print(t) for t in texts]


def test_masks_cover_every_choice():
    masks = op.covering(list(range(64)), 4)
    assert len(masks) == 31 and all(31 <= m.bit_count() <= 34 for m in masks)
    rng = random.Random(0)
    for _ in range(4000):
        hidden = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & hidden for m in masks)


def near_prints(seed, centres, each):
    rng = np.random.default_rng(seed)
    found = set()
    for centre in rng.integers(0, 1 << 62, centres).tolist():
        found.add(centre)
        for _ in range(each):
            found.add(centre ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False)))
    return sorted(found)


def test_links_with_and_without_crowded_buckets(spark):
    prints = near_prints(3, 4, 110)
    want = plain_components(prints, 4)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for most in (1024, 40):
        roots = {r.node: r.root for r in connected_components(op.near_links(nodes, 4, most)).collect()}
        assert {p: roots.get(p, p) for p in prints} == want


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(rows, "x bigint, y bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_documents(spark):
    base = "the quick brown fox jumps over the lazy dog near the old river bank " * 12
    rows = [
        (5, base), (9, base + "again"), (2, base), (2, base), (7, None), (3, ""), (None, "lonely text of no id at all"),
        (11, "something else entirely, with its own words and no neighbour"), (None, base),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS fp", "2 AS node", "3 AS _near")
    got = op.simhash_components(docs).collect()
    assert len(got) == len(rows)
    prints = {t: plain_print(t) for _, t in rows}
    comps = plain_components(set(prints.values()), 4)
    for i, t in rows:
        same = [d for d, x in rows if d is not None and comps[prints[x]] == comps[prints[t]]]
        assert (i, min(same, default=None)) in {
            (r.doc_id, r.component_id) for r in got if r.fp % (1 << 64) == prints[t]
        }
    kept = op.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 11]
    assert op.drop_near_duplicates(docs.limit(0)).collect() == []


def test_rows_are_judged_by_their_own_component(spark):
    rng = random.Random(4)
    base, *alone = (" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300)) for _ in range(7))
    rows = [(None, t) for t in alone[:4]] + [(None, alone[0]), (None, base), (1, base), (1, base), (8, base)]
    rows += [(6, alone[4]), (6, alone[5]), (None, alone[5])]  # one id on different texts
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS _near").repartition(3)
    comps = plain_components({plain_print(t) for _, t in rows}, 4)
    assert len(set(comps.values())) == len(comps) == 7  # no two of the texts are near
    got = [(r.doc_id, r.text) for r in op.drop_near_duplicates(docs).collect()]
    want = [(None, t) for t in alone[:4]] + [(1, base), (6, alone[4]), (6, alone[5])]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_steps_into_crowded_buckets_end(spark):
    for radius in (1, 2, 4, 5):
        for n in range(radius + 1, 65):
            assert all(op.covering(list(range(n)), radius))  # every step hides fewer bits
    hidden = {64 - op.mask_of(path, 4).bit_count() for path in itertools.product(range(31), repeat=3)}
    assert max(hidden) <= 8 and 1 << max(hidden) <= op.MOST
    # all prints lie in a subcube of the bits that two steps hide
    free = [b for b in range(63) if not op.mask_of((2, 2), 4) >> b & 1]
    rng = np.random.default_rng(1)
    prints = sorted({sum(1 << b for b in free if rng.integers(2)) for _ in range(200)})
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    roots = {r.node: r.root for r in connected_components(op.near_links(nodes, 4, 60)).collect()}
    assert {p: roots.get(p, p) for p in prints} == plain_components(prints, 4)
