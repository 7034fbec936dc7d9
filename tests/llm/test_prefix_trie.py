"""The trie against one built from plain Python tuples; the radix tree's own layouts and paths."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerlake.llm import prefix_trie as op

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in kids[node])
    found = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        found.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids[node]),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def conversations(n, seed, turns=7, choices=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:  # a third of all rows: one conversation, over and over
            rows += [(c, k, "user", f"hot {k}") for k in range(3)]
            continue
        for k in range(rng.randrange(turns)):
            text = rng.choice(["", None, "é 日本", "x" * 300, *map(str, range(choices))])
            rows.append((c, k, rng.choice(["user", "assistant", None]), text))
    rng.shuffle(rows)
    return rows


def trie(spark, rows):
    schema = "conv_id bigint, turn bigint, role string, text string"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    found = op.prefix_trie(op.rebuild(op.turn_sequences(docs)))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("run_keys", [1, 4, 50_000])
def test_against_plain_tuples(spark, monkeypatch, run_keys):
    monkeypatch.setattr(op, "RUN_KEYS", run_keys)
    monkeypatch.setattr(op, "LIST_BYTES", 20 if run_keys < 10 else 1 << 18)
    rows = conversations(150, seed=run_keys)
    rows += [(None, 1, "user", "lost"), (-7, None, "user", "b"), (-7, 0, "user", "a"), (1002, 5, None, None)]
    rows += [(1100 + k % 5, k, "user", f"deep {k}") for k in range(900)]
    assert trie(spark, rows) == brute(rows)


def test_only_copies(spark):
    rows = [(c, k, "user", "same") for c in range(0, 400, 5) for k in range(2)]
    assert trie(spark, rows) == brute(rows)


def test_conversations_without_turns(spark):
    # rebuilt from a base that does not exist, and shorter than what they give up
    rows = [(c, 0, "user", "only") for c in range(1, 200) if c % 5]
    want = brute(rows)
    assert trie(spark, rows) == want
    assert any(len(turns) == 0 for turns in rebuilt(rows).values())


def test_other_columns_and_empty_table(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, depth int, `key` string"
    docs = spark.createDataFrame([(5, 0, "user", "a", 1, "k")], schema)
    assert op.prefix_trie(op.rebuild(op.turn_sequences(docs))).count() >= 1
    assert op.prefix_trie(op.rebuild(op.turn_sequences(docs.limit(0)))).collect() == []


@pytest.mark.parametrize("children,layout", [(4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256), (256, 256)])
def test_layouts_grow(children, layout):
    rng = random.Random(children)
    branch = rng.sample(range(256), children)
    keys = [b"path" + bytes([b]) + b"tail" for b in branch]
    root = op.build_tree(keys)
    assert (root.prefix, root.layout, len(list(root.children()))) == (b"path", layout, children)
    for k, b in enumerate(branch):
        assert root.find(b).value == k
    assert all(root.find(b) is None for b in set(range(256)) - set(branch))


def test_paths_are_compressed_and_split():
    keys = [b"aaaa", b"aaaabbbb", b"aaaabbcc", b"a", b""]
    root = op.build_tree(keys)

    def walk(node, path):
        path += node.prefix
        if node.value is not None:
            assert keys[node.value] == path
            yield path
        for kid in node.children():
            yield from walk(kid, path)

    assert sorted(walk(root, b"")) == sorted(keys)
    single = op.build_tree([b"x" * 2000])
    assert single.prefix == b"x" * 2000 and not single.kids


def test_turn_ids_tell_role_from_text(spark):
    rows = [("ab", "c"), ("a", "bc"), ("", "abc"), (None, "abc"), ("abc", None), ("1:a", ""), ("1", ":a")]
    found = spark.createDataFrame(rows, "role string, text string")
    ids = [bytes(r[0]) for r in found.select(op.turn_id(found.role, found.text)).collect()]
    assert len(set(ids)) == 6 and ids[2] == ids[3] and {len(i) for i in ids} == {op.WIDTH}
