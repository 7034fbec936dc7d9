"""Three-line windows against a plain pass over the lines."""

import random

from ledgerlake.llm import line_dedup as op


def plain_dedup(docs):
    """docs: distinct (doc_id, text) in order -> {doc_id: (text, removed)}."""
    seen, out = {}, {}
    covered = {d: set() for d, _ in docs}
    for d, text in docs:
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        for trio in zip(full, full[1:], full[2:]):
            window = tuple(lines[i] for i in trio)
            if window in seen:
                covered[d].update(trio)
            seen.setdefault(window, (d, trio[0]))
    for d, text in docs:
        if text is None:
            out[d] = (None, 0)
        else:
            left = [x for i, x in enumerate(text.split("\n")) if i not in covered[d]]
            out[d] = ("\n".join(left), len(covered[d]))
    return out


def run(spark, rows, extra=()):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", *extra).repartition(3)
    return op.dedup_lines(docs)


def test_random_documents(spark):
    rng = random.Random(8)
    rows = [(i, "\n".join(rng.choices(["a", "b", "c", "", " ", "dd"], k=rng.randint(0, 9)))) for i in range(120)]
    got = {r.doc_id: (r.text, r.n_removed) for r in run(spark, rows).collect()}
    assert got == plain_dedup(rows)


def test_copies_and_overlaps(spark):
    block = "one\ntwo\nthree\nfour"
    rows = [(1, f"x\n{block}\ny"), (2, f"{block}\n\nz"), (3, "one\ntwo"), (4, None), (5, ""), (6, "r\n" * 6 + "s")]
    got = {r.doc_id: (r.text, r.n_removed) for r in run(spark, rows).collect()}
    assert got == plain_dedup(rows)
    assert got[2] == ("\nz", 4) and got[6] == ("r\ns", 5)


def test_nulls_repeats_and_names(spark):
    rows = [(None, "p\nq\nr"), (1, "p\nq\nr"), (1, "p\nq\nr"), (2, "k\nl\nm"), (2, "k\nl\nm\nn")]
    got = run(spark, rows, ("7 AS d", "8 AS t", "9 AS _line", "1 AS h1", "5 AS n_removed", "text AS `a.b`"))
    assert got.columns == ["doc_id", "text", "d", "t", "_line", "h1", "a.b", "n_removed"]
    found = sorted(((r.doc_id or 0, r.text, r.n_removed) for r in got.collect()))
    # the row without an id comes last; equal rows share their fate; one id with two texts is two documents
    assert found[:3] == [(0, "", 3), (1, "p\nq\nr", 0), (1, "p\nq\nr", 0)]
    assert sorted(x[2] for x in found[3:]) in ([0, 3],)


def test_empty_table_and_long_text(spark):
    assert run(spark, [(1, "a")]).where("doc_id > 5").collect() == []
    assert op.dedup_lines(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    lines = [f"line {i}" for i in range(40_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[100:39_000] + ["end"]))]
    got = {r.doc_id: r for r in run(spark, rows).collect()}
    assert got[1].n_removed == 0 and got[2].text == "end" and got[2].n_removed == 38_900
