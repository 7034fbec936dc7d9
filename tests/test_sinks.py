from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.sinks.partitions import (
    overwrite_month,
    overwrite_months,
    overwrite_partitioned_table,
    overwrite_table,
)
from ledgerlake.sources.tables import TableRef, read_month

SCHEMA = "x string, _year_month string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _counts(df):
    return {r[0]: r[1] for r in df.groupBy(PARTITION_COLUMN).count().collect()}


def test_path_month_replace_and_empty_clears(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "t"), schema=_rows(spark, []).schema)
    assert overwrite_months(_rows(spark, [("a", "202501"), ("b", "202502")]), table, ["202501", "202502"]).rows == 2
    assert overwrite_month(_rows(spark, [("c", "202501")] * 3), table, "202501") == 3
    assert _counts(table.read(spark)) == {"202501": 3, "202502": 1}
    assert overwrite_month(_rows(spark, []), table, "202501") == 0
    assert _counts(table.read(spark)) == {"202502": 1}
    assert read_month(spark, table, "202502").first()["x"] == "b"


def test_dynamic_months_empty_requested_month_is_cleared(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "t"), schema=_rows(spark, []).schema)
    overwrite_months(_rows(spark, [("a", "202501"), ("b", "202502")]), table, ["202501", "202502"])
    result = overwrite_months(_rows(spark, [("z", "202502")]), table, ["202501", "202502"])
    assert result.months == ("202502",)
    assert _counts(table.read(spark)) == {"202502": 1}


def test_rows_of_other_months_fail_before_anything_is_written(spark, tmp_path):
    import pytest

    table = TableRef(path=str(tmp_path / "t"), schema=_rows(spark, []).schema)
    overwrite_months(_rows(spark, [("a", "202501")]), table, ["202501"])
    for stray in ("202509", None):
        with pytest.raises(Exception, match=f"not written: {stray or 'none'}"):
            overwrite_months(_rows(spark, [("b", "202501"), ("c", stray)]), table, ["202501", "202502"])
    assert [tuple(r) for r in table.read(spark).collect()] == [("a", "202501")]


def test_rows_are_counted_by_month_while_written(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "t"), schema=_rows(spark, []).schema)
    result = overwrite_months(_rows(spark, [("a", "202501")] * 3 + [("b", "202503")]), table, ["202503", "202501", "202502"])
    assert result.by_month == {"202501": 3, "202502": 0, "202503": 1} and result.rows == 4


def test_catalog_table_month_replace(spark):
    table = TableRef(name="ledgerlake_sink_test")
    spark.sql("DROP TABLE IF EXISTS ledgerlake_sink_test")
    assert overwrite_month(_rows(spark, [("a", "202501")]), table, "202501") == 1
    assert overwrite_month(_rows(spark, [("b", "202502"), ("c", "202502")]), table, "202502") == 2
    assert overwrite_month(_rows(spark, [("d", "202501")]), table, "202501") == 1
    df = table.read(spark)
    assert _counts(df) == {"202501": 1, "202502": 2}
    assert overwrite_month(_rows(spark, []), table, "202502") == 0
    assert _counts(table.read(spark)) == {"202501": 1}
    spark.sql("DROP TABLE IF EXISTS ledgerlake_sink_test")


def test_a_catalog_table_made_otherwise_keeps_its_other_months(spark):
    """Made by a plain write, with its columns in another order and no option stored with it."""
    name = "ledgerlake_sink_other"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    made = spark.createDataFrame([("202501", "a", 1), ("202502", "b", 2)], "_year_month string, x string, y int")
    made.write.format("parquet").partitionBy(PARTITION_COLUMN).saveAsTable(name)
    table = TableRef(name=name)
    assert overwrite_month(made.select("y", "x").limit(1), table, "202502") == 1
    rows = sorted(tuple(r) for r in table.read(spark).select("x", "y", PARTITION_COLUMN).collect())
    assert [r[2] for r in rows] == ["202501", "202502"] and rows[0] == ("a", 1, "202501")
    assert overwrite_partitioned_table(made.limit(1), table) == 1 and table.read(spark).count() == 1
    assert overwrite_partitioned_table(made, table) == 2
    assert overwrite_month(made.select("x", "y").limit(0), table, "202501") == 0
    assert [tuple(r) for r in table.read(spark).select("x", "y").collect()] == [("b", 2)]
    spark.sql(f"DROP TABLE {name}")


def test_overwrite_table_counts(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "labels"))
    df = spark.range(5).withColumn("y", F.lit("v"))
    assert overwrite_table(df, table) == 5
    assert overwrite_table(df.limit(2), table) == 2
    assert table.read(spark).count() == 2
