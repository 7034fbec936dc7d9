"""Work of loads and writes that must not grow with tasks times months."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.operators.quality import rows_per_month
from ledgerlake.plans.bronze import ingest_months
from ledgerlake.plans.catalog import fixture_lakehouse, lakehouse
from ledgerlake.sinks import partitions
from ledgerlake.sources import fixture, monthly_files
from ledgerlake.sources.tables import TableRef
from tests.conftest import LOADED_AT

MONTHS = [f"{y}{m:02d}" for y in (2021, 2022, 2023) for m in range(1, 13)]
SCHEMA = "A string, B string, _source_file string, _ingested_at timestamp, _year_month string"


@pytest.fixture
def table(spark, tmp_path):
    return TableRef(path=str(tmp_path / "bronze"), schema=spark.createDataFrame([], SCHEMA).schema)


def month_files(folder, **rows):
    for month in MONTHS:
        with gzip.open(folder / f"A{month}.csv.gz", "wt", encoding="utf-8") as out:
            out.write("A;B;\n" + "".join(f"{k * 7919 % 10007};{month};\n" for k in range(rows.get(f"m{month}", 40))))


def stored(spark, table):
    return {tuple(r) for r in rows_per_month(table.read(spark)).collect()}


def test_many_months_go_to_few_tasks_each(spark, tmp_path, table):
    month_files(tmp_path, m202106=4000)
    loaded = ingest_months(spark, str(tmp_path), table, MONTHS, LOADED_AT, spread=4)
    assert loaded == {m: 40 for m in MONTHS} | {"202106": 4000}
    assert stored(spark, table) == set(loaded.items())
    # lines of every month went to every task: 144 files, and a sort in each task
    assert len(table.read(spark).inputFiles()) <= len(MONTHS) + 5
    assert len(table.read(spark, ["202106"]).inputFiles()) > 1  # a large month has several tasks
    read = monthly_files.read_months(spark, str(tmp_path), MONTHS, LOADED_AT, columns=["A", "B"], spread=4)
    per_task = read.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct(PARTITION_COLUMN).alias("n"))
    seen = {r["p"]: r["n"] for r in per_task.collect()}
    assert len(seen) == 5 and max(seen.values()) <= partitions.OPEN_WRITERS
    once, again = (
        {(r["A"], r["B"], r["p"]) for r in read.select("A", "B", F.spark_partition_id().alias("p")).collect()}
        for _ in range(2)
    )
    assert once == again


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "Broadcast" not in line for line in plan.splitlines())


def test_lines_are_dealt_by_default_only_where_a_file_is_large(spark, tmp_path):
    month_files(tmp_path)
    read = monthly_files.read_months(spark, str(tmp_path), MONTHS, LOADED_AT)
    assert shuffles(read) == 0 and read.count() == 40 * len(MONTHS)
    one = monthly_files.read_months(spark, str(tmp_path), MONTHS[:1], LOADED_AT)
    assert shuffles(one) == 1 and one.count() == 40
    month_files(tmp_path, m202106=4000)
    read = monthly_files.read_months(spark, str(tmp_path), MONTHS, LOADED_AT)
    assert shuffles(read) == 1 and read.count() == 40 * (len(MONTHS) - 1) + 4000


def test_months_are_counted_in_one_aggregate(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(partitions, "Observation", lambda: made.append(Observation()) or made[-1])
    months = [f"{y}{m:02d}" for y in range(2012, 2020) for m in range(1, 13)]
    n = F.col("id") % (len(months) - 1)  # the last month gets no row
    df = spark.range(0, 20_000, 1, 3).select("id", F.element_at(F.lit(months), (n + 1).cast("int")).alias(PARTITION_COLUMN))
    table = TableRef(path=str(tmp_path / "t"))
    written = partitions.overwrite_months(df, table, months)
    assert set(made[0].get) == {"rows", "months"}  # it was one count for each month, on every row
    assert written.rows == 20_000 and written.by_month[months[-1]] == 0 and months[-1] not in written.months
    assert set(written.by_month.items()) == stored(spark, table) | {(months[-1], 0)}


def star(spark, folder):
    """Tables of 6 lineitem files that all hold rows of every month (one ship date is missing)."""
    line = spark.range(0, 600, 1, 6).select(
        (F.col("id") % 50).alias("l_orderkey"), (F.col("id") % 20).alias("l_partkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        *(F.lit(v).alias(c) for c, v in {"l_quantity": 3.0, "l_extendedprice": 12.5, "l_discount": 0.1, "l_tax": 0.02,
                                         "l_returnflag": "N", "l_linestatus": "O"}.items()),
        F.make_timestamp(F.lit(1996), (F.col("id") % 3 + 1).cast("int"), F.lit(2), F.lit(0), F.lit(0), F.lit(0)).alias("l_shipdate"),
    )
    line.write.parquet(f"{folder}/lineitem.parquet")
    spark.range(50).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey").write.parquet(f"{folder}/orders.parquet")
    spark.range(9).selectExpr("id AS c_custkey", "CAST(id % 4 AS int) AS c_nationkey").write.parquet(f"{folder}/customer.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "concat('T', id % 5) AS p_type").write.parquet(f"{folder}/part.parquet")


def test_extracts_are_written_by_month(spark, tmp_path):
    star(spark, tmp_path)
    apart, together = (fixture.claims_text(spark, str(tmp_path), with_key=True, together=t) for t in (False, True))
    assert apart.count() == 600 and apart.exceptAll(together).isEmpty() and together.exceptAll(apart).isEmpty()
    assert apart.schema == together.schema
    # each of the 6 tasks wrote a file of each of the 3 months
    house = fixture_lakehouse(spark, str(tmp_path))
    assert len(TableRef(path=house.bronze.path).read(spark).inputFiles()) < 9
    raw = lakehouse(spark, str(tmp_path))
    assert len(list(Path(raw.raw_dir).glob("*/part-*.gz"))) < 9
    assert stored(spark, raw.bronze) == {("199601", 200), ("199602", 200), ("199603", 200)}
