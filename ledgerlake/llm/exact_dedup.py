"""Operator 13: exact dedup by MSD radix partitioning of whole texts.

A text is the key "its length, then its bytes"; rows are split by successive digits of that key.
The first digit is the length and the first ``DIGIT`` bytes, each further digit ``GROWTH`` times as
many bytes as the one before, so the number of rounds grows with the logarithm of the longest text
that repeats. A round counts rows by (group, digit); rows alone with their digit are settled and
leave, groups whose text has ended (all have the same length) are settled as copies, all others go
on with their remaining bytes. Equality is decided by the bytes themselves: no digest is computed.

At scale: a text is moved once, in the first round, and after that only bytes still in doubt are.
Counts are combined by each task before they are shuffled, so a third of all rows with one text is
one row for each task; the join that gives rows their new group is a sort-merge join at every size
(the plan measured on little data is the one that runs on much), whose hot digits adaptive execution
splits. Every round is a table in the shared folder, and the bytes it read are deleted when it is
committed.

Cases: null texts count as empty and equal each other and empty ones; upper-case A-Z equal lower-case
ones, no other letters are folded; of equal texts the row with the largest id stays (a null id is
smaller than any), of rows that repeat it one; an empty table gives no row; other columns, also
ones named like a result, are carried apart from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import column, discard, materialize

DIGIT = 64  # bytes of the first digit, beside the length
GROWTH = 16  # of the digits, from round to round

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold_case(text: Column) -> Column:
    """A text with A-Z lower-cased; null: empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())


def _split(rows: DataFrame, by: list[str], width: int, name: str) -> DataFrame:
    """One round: ``rows`` (doc, id, row, size, rest, done: bytes split so far) with ``grp`` and
    ``copies`` of those that share their digit, and ``rest`` only of those still in doubt."""
    digit = rows.withColumn("digit", F.substring("rest", 1, width))
    counts = digit.groupBy(*by, "digit").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    # written, so that group numbers are fixed
    groups = materialize(counts.withColumn("next", F.monotonically_increasing_id()), f"{name}-groups")
    joined = digit.join(groups.hint("merge"), [*by, "digit"], "left")
    doubt = F.col("next").isNotNull() & (F.octet_length("rest") > width)
    return joined.select(
        "doc", "id", "size", F.col("next").alias("grp"), "copies",
        F.when(doubt, F.substring("rest", width + 1, 2**31 - 1)).alias("rest"),
        doubt.alias("open"),
    )


def radix_groups(docs: DataFrame, text: Column, row_id: Column, doc: Column) -> DataFrame:
    """(doc, id, row, copies, keep, kept) of every row: ``doc`` as given, how many rows have its
    text, the id of the one that stays, and whether this row is it."""
    data = text.cast("binary")
    rows = docs.select(
        doc.alias("doc"), row_id.alias("id"), F.octet_length(data).alias("size"), data.alias("rest")
    )
    by, width, settled, n, before = ["size"], DIGIT, [], 0, None
    while True:
        table = materialize(_split(rows, by, width, f"radix-{n}"), f"radix-{n}", by="open")
        if before is not None:
            discard(before, "open=true")
        settled.append(table.where("not open").withColumn("round", F.lit(n)))
        rows = table.where("open").drop("open", "copies")
        if rows.isEmpty():
            break
        by, width, n, before = ["grp"], width * GROWTH, n + 1, table
    settled = reduce(DataFrame.unionByName, settled).select("doc", "id", "round", "grp", "copies")
    alone = settled.where("grp is null").select(
        "doc", "id", F.lit(1).cast("bigint").alias("copies"), F.col("id").alias("keep"), F.lit(True).alias("kept")
    )
    # numbered in a written table: one of the rows that repeat the largest id is told from the others
    shared = materialize(
        settled.where("grp is not null").withColumn("row", F.monotonically_increasing_id()), "radix-copies"
    )
    stays = shared.groupBy("round", "grp").agg(F.max(F.struct("id", "row")).alias("stays"))
    copies = shared.join(stays, ["round", "grp"]).select(
        "doc", "id", "copies", F.col("stays.id").alias("keep"), (F.col("row") == F.col("stays.row")).alias("kept")
    )
    return alone.unionByName(copies)


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **carry: Column
) -> DataFrame:
    """(id, keep_id, group_size, kept) of every row, and further columns computed from it."""
    extra = [c.alias(name) for name, c in carry.items()]
    doc = F.struct(F.lit(0).alias("_"), *extra)
    found = radix_groups(docs, fold_case(column(text_col)), column(id_col), doc)
    return found.select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("copies").alias("group_size"),
        "kept", *(F.col("doc")[name].alias(name) for name in carry),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    doc = F.struct(*map(column, docs.columns))
    found = radix_groups(docs, fold_case(column(text_col)), column(id_col), doc)
    return found.where("kept").select("doc.*")


SQL = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM folded
"""
