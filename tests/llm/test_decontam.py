"""Leak search against the edit distance of every stretch."""

import random

import numpy as np
import pyarrow as pa

from ledgerlake.llm import decontam as op


def plain_best(pattern, text):
    """Smallest edit distance of ``pattern`` to any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_best_match():
    rng = random.Random(6)
    for _ in range(400):
        pattern = rng.choices(range(4), k=rng.randint(1, 75))
        text = rng.choices(range(5), k=rng.randint(0, 90))
        edits, end = op.best_match(pattern, text)
        assert edits == plain_best(pattern, text)
        assert plain_best(pattern, text[:end]) == edits


def corpus(seed=9):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(5, 70)))) for i in range(60)]
    docs = []
    for i, (_, text) in enumerate(items):
        words, allowed = text.split(), op.edits_allowed(len(text.split()))
        for _ in range(rng.choice([0, allowed // 2, allowed])):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choices(vocab, k=rng.randint(0, 1))
        around = rng.choices(vocab, k=80)
        cut = rng.randint(0, 80)
        docs.append((i, " ".join(around[:cut]).upper() + ",\n" + "; ".join(words) + ". " + " ".join(around[cut:])))
    docs += [(1000 + i, " ".join(rng.choices(vocab, k=150))) for i in range(60)]
    return items, docs


def words_of(text):
    return op.plain_words(pa.array([text]))[0].to_pylist()


def test_search_finds_what_brute_force_finds(spark):
    items, docs = corpus()
    want = {}
    for d, text in docs:
        for i, item in items:
            n = len(words_of(item))
            edits = plain_best(words_of(item), words_of(text))
            if n >= op.LEAST_WORDS and edits <= op.edits_allowed(n):
                want[d, i] = edits
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "2 AS `end`")
    found = op.find_leaks(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert set(got) == set(want) and len(want) >= 50
    for key, r in got.items():
        assert r.edits >= want[key]
        stretch = words_of(dict(docs)[key[0]])[r.start : r.end]
        item = words_of(dict(items)[key[1]])
        assert plain_best(item, stretch) == r.edits


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items, docs = corpus(3)
    frames = (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    whole = {(r.doc_id, r.item_id) for r in op.find_leaks(*frames).collect()}
    monkeypatch.setattr(op, "BLOCK_WORDS", 400)
    parts = {(r.doc_id, r.item_id) for r in op.find_leaks(*frames).collect()}
    assert whole == parts and len(whole) >= 50


def test_filter_and_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short")], "item_id bigint, text string")
    rows = [(1, f"Say: {item}!"), (1, f"Say: {item}!"), (2, None), (3, ""), (None, item.upper()), (5, "too short a text"),
            (6, "word " * 50_000), (7, "word " * 20_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS item_id", "2 AS _x")
    kept = op.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6]
    assert op.drop_contaminated(docs, items.limit(0)).count() == len(rows)
    assert op.drop_contaminated(docs.limit(0), items).collect() == []
    assert op.find_leaks(docs.limit(0), items).collect() == []


def test_keys_read_only_their_window():
    words = np.arange(40)
    a = op.cgk_keys(words, np.array([3]), 13, 2, np.array([40]))
    words[16:] = 7
    assert (a == op.cgk_keys(words, np.array([3]), 13, 2, np.array([40]))).all()


def edited(rng, words, edits, clustered):
    """A copy with exactly this many edits, spread or in the item's opening."""
    spots = sorted(rng.sample(range(len(words)), edits)) if not clustered else range(edits)
    copy, shift = list(words), 0
    for k in spots:
        kind = rng.randrange(3)
        at = k + shift
        copy[at : at + (kind != 1)] = [f"new{rng.randrange(10**6)}"] * (kind != 2)
        shift += (kind == 1) - (kind == 2)
    return copy


def test_every_leak_at_the_full_budget_is_found():
    rng = random.Random(12)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(900)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([5, 9, 14, 33, 150, 349, 600, 1000] * 3)]
    index = op.Index(items)
    texts = []
    for i, text in items:
        words = text.split()
        copy = edited(rng, words, op.edits_allowed(len(words)), clustered=i % 2 == 0)
        texts.append(" ".join([*rng.choices(vocab, k=50), *copy, *rng.choices(vocab, k=50)]))
    hits = {(r, i): e for r, i, _, _, e in index.search(pa.array(texts))}
    for i, text in items:
        assert hits[i, i] <= op.edits_allowed(len(text.split()))


def test_walks_alone_reach_the_aim_at_every_size():
    rng = random.Random(21)
    for n in (5, 6, 9, 14, 20, 33, 64, 150, 349, 600, 1000):
        items = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(n))) for i in range(12)]
        index = op.Index(items)
        index.pieces = {}  # without the exact way
        assert all(recall >= op.RECALL for _, recall in index.repeats.values()), index.repeats
        texts, of = [], []
        for k in range(120 if n < 200 else 60):
            i = k % len(items)
            copy = edited(rng, items[i][1].split(), op.edits_allowed(n), clustered=k % 2 == 0)
            around = [f"w{rng.randrange(2000)}" for _ in range(20)]
            texts.append(" ".join(around + copy + around))
            of.append(i)
        hits = {(r, i) for r, i, *_ in index.search(pa.array(texts))}
        assert sum((r, i) in hits for r, i in enumerate(of)) >= 0.97 * len(of), n


def test_pieces_complete_what_walks_miss():
    items, docs = corpus(17)
    index, texts = op.Index(items), pa.array([t for _, t in docs])
    whole = index.search(texts)
    index.walks = {}
    assert index.search(texts) == whole and len(whole) >= 50


def test_short_items_and_scripts_without_spaces(spark):
    chinese, thai = "法国的首都是哪一座城市？", "เมืองหลวงของประเทศฝรั่งเศสคือเมืองใด"
    items = [(1, "Which river?"), (2, "yes"), (3, chinese), (4, thai), (5, "four short words here")]
    docs = [(1, "Q: which river? I know"), (2, "Yes."), (3, f"问题：{chinese}答案：巴黎。"), (4, f"ก่อน{thai}หลัง"),
            (5, chinese.replace("首都", "首府")), (6, "four short, other words here"), (7, "什么都没有"), (8, "yesterday")]
    frames = (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    got = {(r.doc_id, r.item_id, r.edits) for r in op.find_leaks(*frames).collect()}
    assert got == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 3, 1)}
    assert sorted(r.doc_id for r in op.drop_contaminated(*frames).collect()) == [1, 6, 7, 8]


def test_equal_items_reach_the_driver_once(spark):
    text = "one benchmark text that makes up most of the rows"
    items = spark.createDataFrame([(i, text) for i in range(500)] + [(900, "another item of six words")], "item_id bigint, text string")
    assert sum(len(block) for block in op._blocks(items, "text")) == 2
    docs = spark.createDataFrame([(1, f"so {text}, yes"), (2, "nothing")], "doc_id bigint, text string")
    got = op.find_leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [(1, i, 0) for i in range(500)]
    assert [r.doc_id for r in op.drop_contaminated(docs, items).collect()] == [2]
