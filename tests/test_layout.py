"""Rows placed by several columns: the same rows, far fewer of them read by a filter on two columns."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.operators import layout
from ledgerlake.sinks.partitions import overwrite_months
from ledgerlake.sources.tables import TableRef

COLUMNS = ["service", "region", "care"]
ROWS, FILES = 200_000, 32
PAGES = {"parquet.page.row.count.limit": "500"}  # as many pages as a month of millions of rows has


def _spend(spark):
    """One month; a third of the rows have one service, some values are NULL."""
    mixed = F.xxhash64("id")
    return spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "1000").when(F.col("id") % 97 != 0, F.pmod(mixed, F.lit(400)).cast("string")).alias("service"),
        F.pmod(F.shiftright(mixed, 20), F.lit(90)).cast("string").alias("region"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.shiftright(mixed, 40), F.lit(700)).cast("int")).alias("care"),
        F.col("id").alias("n"),
        F.lit("202503").alias(PARTITION_COLUMN),
    )


def _stored(spark, folder, df, options=None):
    table = TableRef(path=str(folder), schema=df.schema)
    overwrite_months(df, table, ["202503"], options=options)
    return table


def _rows_read(df):
    """Rows that came out of the scan, and the rows of the result."""
    found = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), found


def test_a_filter_on_two_columns_reads_few_rows(spark, tmp_path):
    df = _spend(spark)
    points = layout.split_points(df, COLUMNS)
    assert all(0 < len(p) < 2**layout.BITS for p in points.values())
    plain = _stored(spark, tmp_path / "plain", df.repartition(FILES), PAGES)
    options = PAGES | layout.bloom_options(COLUMNS[:2])
    placed = _stored(spark, tmp_path / "placed", layout.clustered(df, COLUMNS, points, FILES), options)
    wanted = (F.col("region") == "42") & (F.col("care") < "2024-02-01")
    every, expected = _rows_read(plain.read(spark).where(wanted))
    some, found = _rows_read(placed.read(spark).where(wanted))
    assert expected and sorted(r["n"] for r in found) == sorted(r["n"] for r in expected)
    assert every == ROWS and some < ROWS / 8
    for column, value in (("service", "250"), ("region", "42")):  # each alone
        some, found = _rows_read(placed.read(spark).where(F.col(column) == value))
        assert some < ROWS / 2 and len(found) == df.where(F.col(column) == value).count()


def test_a_hot_value_is_cut_over_files(spark, tmp_path):
    df = _spend(spark).withColumn("service", F.lit("1")).withColumn("region", F.lit(None).cast("string"))
    points = layout.split_points(df, COLUMNS[:2])
    assert points["region"] == []
    table = _stored(spark, tmp_path / "hot", layout.clustered(df, COLUMNS[:2], points, 8))
    files = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/hot/**/*.parquet", recursive=True)]
    assert sum(files) == ROWS == table.read(spark).count()
    assert len(files) > 4 and max(files) < ROWS / 4


def test_rows_lie_in_cells(spark):
    df = spark.createDataFrame([(str(a), b) for a in range(4) for b in range(4)], "a string, b int")
    points = {"a": [int((str(k).encode().hex()).ljust(14, "0"), 16) for k in (1, 2, 3)], "b": [100, 200, 300]}
    ranks = [layout.rank(df, c, points[c]) for c in ("a", "b")]
    cells = {(r["a"], r["b"]): r["cell"] for r in df.select("a", "b", layout.cell(ranks, 2).alias("cell")).collect()}
    assert sorted(cells.values()) == list(range(16))
    assert [cells[k] for k in (("0", 0), ("0", 1), ("1", 0), ("1", 1), ("0", 2), ("2", 0), ("3", 3))] == [0, 1, 2, 3, 4, 8, 15]


def test_an_empty_frame_is_placed(spark, tmp_path):
    df = _spend(spark).limit(0)
    points = layout.split_points(df, COLUMNS)
    table = _stored(spark, tmp_path / "none", layout.clustered(df, COLUMNS, points, 0))
    assert points == {c: [] for c in COLUMNS} and table.read(spark).count() == 0
