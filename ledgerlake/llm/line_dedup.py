"""Operator 8: line dedup by overlapping three-line windows, in DataFrame operations only.

A text's lines are what stands between line feeds; blank ones (white space only) are kept as they
are and belong to no window. A window is three consecutive lines that are not blank, known by two
64-bit hashes of its lines' hashes. Over the whole table each window's first occurrence, by
(document, position), stands; every later one covers its three lines, and the union of covered
lines is removed. Only windows that occur again are joined back, and only positions travel; the
counts are combined by each task before the shuffle, and a window that many documents share is
split by the adaptive skew join. Both joins are sort-merge joins whatever the size, so that the plan
measured on little data is the one that runs on much.

Documents are ordered by ``doc_id`` (null last), then by a hash of the text.

Cases: a null text stays null; a text of fewer than three lines that are not blank is kept whole;
rows that repeat id and text are one document and share its fate; windows may repeat inside a
document too; an empty table gives no row; all other columns are carried along, but for one
named like the count, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import column, free_prefix, materialize

WINDOW = 3


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, t, p, q, r, h1, h2): document and text hash, line numbers of the window, its hashes."""
    text = column(text_col).cast("string")
    lines = docs.select(
        column(id_col).alias("d"), F.xxhash64(text).alias("t"), F.split(text, "\n").alias("lines")
    )
    full = F.filter(
        F.transform(
            "lines",
            lambda x, i: F.struct(
                i.alias("i"),
                F.when(F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) != "", F.xxhash64(x)).alias("a"),
                F.xxhash64(F.lit("second"), x).alias("b"),
            ),
        ),
        lambda x: x["a"].isNotNull(),
    )
    lines = lines.select("d", "t", full.alias("full")).where(F.size("full") >= WINDOW)

    def window(i: Column) -> Column:
        x, y, z = (F.col("full")[i + k] for k in range(WINDOW))
        return F.struct(
            x["i"].alias("p"), y["i"].alias("q"), z["i"].alias("r"),
            F.xxhash64(x["a"], y["a"], z["a"]).alias("h1"),
            F.xxhash64(x["b"], y["b"], z["b"]).alias("h2"),
        )

    each = F.transform(F.sequence(F.lit(0), F.size("full") - WINDOW), window)
    return lines.select("d", "t", F.explode(each).alias("w")).select("d", "t", "w.*")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "n_removed"
) -> DataFrame:
    """``docs`` without the lines of repeated windows; ``removed_col`` counts them."""
    windows = materialize(_windows(docs, id_col, text_col), "line-windows")
    place = F.struct(F.col("d").isNull().alias("n"), "d", "t", "p")
    first = windows.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last")
    )
    again = materialize(first.where("first <> last").select("h1", "h2", "first"), "repeated-windows")
    # sort-merge joins at every size: adaptive execution splits their hot keys
    later = windows.join(again.hint("merge"), ["h1", "h2"]).where(place != F.col("first"))
    covered = later.groupBy("d", "t").agg(
        F.flatten(F.collect_set(F.array("p", "q", "r"))).alias("_covered")
    )
    own = free_prefix(docs.columns, "_line")
    covered = materialize(
        covered.select(
            F.col("d").alias(f"{own}d"),
            F.col("t").alias(f"{own}t"),
            F.array_distinct("_covered").alias(f"{own}covered"),
        ),
        "covered-lines",
    )
    text, gone = column(text_col).cast("string"), F.col(f"{own}covered")
    joined = docs.join(
        covered.hint("merge"),
        column(id_col).eqNullSafe(F.col(f"{own}d")) & (F.xxhash64(text) == F.col(f"{own}t")),
        "left",
    )
    lines = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    columns = [
        F.when(gone.isNull(), text).otherwise(kept).alias(c) if c == text_col else column(c)
        for c in docs.columns
        if c != removed_col
    ]
    return joined.select(*columns, F.when(gone.isNull(), 0).otherwise(F.size(gone)).alias(removed_col))


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM lines WHERE trim(translate(line, chr(9) || chr(13) || chr(11) || chr(12), '    ')) <> ''),
windows AS (
  SELECT a.doc_id, a.i AS p, b.i AS q, c.i AS r, a.line AS x, b.line AS y, c.line AS z
  FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.k = a.k + 1
    JOIN filled c ON c.doc_id = a.doc_id AND c.k = a.k + 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, p) AS nth FROM windows),
covered AS (
  SELECT DISTINCT doc_id, unnest([p, q, r]) AS i FROM ranked WHERE nth > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
  FROM lines ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  coalesce(n, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN removed USING (doc_id)
"""
