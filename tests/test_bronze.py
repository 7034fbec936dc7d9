"""Monthly files and the bronze job."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.plans.bronze import ingest_month, ingest_months
from ledgerlake.sources import monthly_files
from ledgerlake.sources.tables import TableRef
from tests.conftest import LOADED_AT

SCHEMA = "A string, B string, C string, _source_file string, _ingested_at timestamp, _year_month string"


def put(folder, name, *lines, zipped=True):
    folder.mkdir(parents=True, exist_ok=True)
    with (gzip.open if zipped else open)(folder / name, "wt", encoding="utf-8") as out:
        out.writelines(line + "\n" for line in lines)


@pytest.fixture
def table(spark, tmp_path):
    return TableRef(path=str(tmp_path / "bronze"), schema=spark.createDataFrame([], SCHEMA).schema)


def rows(spark, table):
    return sorted(tuple(r) for r in table.read(spark).select("A", "B", "C", "_source_file", PARTITION_COLUMN).collect())


def load(spark, folder, table, *months, **options):
    return ingest_months(spark, str(folder), table, list(months), LOADED_AT, **options)


def test_text_is_kept_and_empty_is_null(spark, tmp_path, table):
    put(tmp_path / "raw", "A202311.csv.gz", "A;B;C;", '007;;"x;y";', ";1,5; z ;")
    assert load(spark, tmp_path / "raw", table, "202311") == {"202311": 2}
    got = table.read(spark)
    assert {tuple(r) for r in got.select("A", "B", "C").collect()} == {("007", None, "x;y"), (None, "1,5", " z ")}
    stamp = got.selectExpr("_source_file", "CAST(_ingested_at AS string)", PARTITION_COLUMN).distinct().collect()
    assert [tuple(r) for r in stamp] == [("A202311.csv.gz", "2026-03-09 12:30:00", "202311")]


def test_each_file_has_its_own_header(spark, tmp_path, table):
    put(tmp_path, "A202301.csv.gz", "C;A;B;", "c;a;b;")
    put(tmp_path, "A202302.csv.gz", "A;B;C;D;", "a;b;c;d;")
    load(spark, tmp_path, table, "202301", "202302")
    assert rows(spark, table) == [("a", "b", "c", f"A2023{m}.csv.gz", f"2023{m}") for m in ("01", "02")]
    put(tmp_path, "A202303.csv.gz", "A;C;", "a;c;")
    with pytest.raises(ValueError, match="A202303.csv.gz lacks the column.* B"):
        load(spark, tmp_path, table, "202303", "202301")
    assert len(rows(spark, table)) == 2


def test_months_are_replaced_alone_and_taken_once(spark, tmp_path, table):
    for month, n in (("202301", 3), ("202302", 2)):
        put(tmp_path, f"A{month}.csv.gz", "A;B;C;", *(f"{k};x;y;" for k in range(n)))
    assert load(spark, tmp_path, table, "202302", "202301", "202302") == {"202301": 3, "202302": 2}
    put(tmp_path, "A202301.csv.gz", "A;B;C;", "only;x;y;")
    assert ingest_month(spark, str(tmp_path), table, 2023, 1, ingested_at=LOADED_AT) == 1
    assert [r[0] for r in rows(spark, table)] == ["0", "1", "only"]
    put(tmp_path, "A202302.csv.gz", "A;B;C;")
    assert load(spark, tmp_path, table, "202302") == {"202302": 0}
    assert [r[0] for r in rows(spark, table)] == ["only"]


def test_exactly_the_named_files_count(spark, tmp_path, table):
    raw = tmp_path / "A202301.csv.gz"  # a folder named like a file of it
    put(raw, "A202302.csv.gz.part", "A;B;C;", "1;2;3;")
    put(raw, "A202304.csv.gz")
    put(raw, "A202305.csv.gz", "A;B;C;", "1;2;3;")
    with pytest.raises(FileNotFoundError, match="2 month.*A202302.csv.gz, .*A202303.csv.gz$"):
        load(spark, raw, table, "202303", "202305", "202302")
    assert not (tmp_path / "bronze").exists()
    assert load(spark, raw, table, "202304", "202305") == {"202304": 0, "202305": 1}


@pytest.mark.parametrize("template", ["A {year} é/{month:02d}.csv.gz", "100%{year}-{month:02d}+.csv", "{year}&{month}.csv.gz"])
def test_odd_names(spark, tmp_path, table, template):
    name = template.format(year=2023, month=7)
    folder = (tmp_path / "in put" / name).parent
    put(folder, name.split("/")[-1], "A;B;C;", "1;2;3;", zipped=name.endswith("gz"))
    assert load(spark, tmp_path / "in put", table, "202307", template=template) == {"202307": 1}
    assert rows(spark, table) == [("1", "2", "3", name, "202307")]


@pytest.mark.parametrize("month", ["202313", "2023", "20230", "202300", "2023-1", ""])
def test_months_are_checked_at_every_entry(spark, tmp_path, table, month):
    with pytest.raises(ValueError, match="not a month"):
        load(spark, tmp_path, table, "202301", month)


def test_lines_of_one_file_are_parsed_by_several_tasks(spark, tmp_path, table):
    put(tmp_path, "A202301.csv.gz", "A;B;C;", *(f"{k};{k % 5};x;" for k in range(4000)))
    read = monthly_files.read_months(spark, str(tmp_path), ["202301"], LOADED_AT, columns=["A", "B", "C"], spread=4)
    assert len({r[0] for r in read.selectExpr("spark_partition_id()").distinct().collect()}) == 4
    assert load(spark, tmp_path, table, "202301", spread=4) == {"202301": 4000}
    assert len(table.read(spark, ["202301"]).inputFiles()) == 4
    assert load(spark, tmp_path, table, "202301", spread=0) == {"202301": 4000}
    assert len(table.read(spark, ["202301"]).inputFiles()) == 1


def test_lines_are_dealt_by_number_and_not_sorted(spark, tmp_path):
    put(tmp_path, "A202301.csv.gz", "A;B;C;", *(f"{k};{k % 5};x;" for k in range(4000)))
    read = monthly_files.read_months(spark, str(tmp_path), ["202301"], LOADED_AT, columns=["A", "B", "C"], spread=4)
    plan = read._jdf.queryExecution().executedPlan().toString()
    # dealing rows in turns (round robin) sorts every task's rows first, inside the exchange
    assert "hashpartitioning(_line" in plan and "RoundRobin" not in plan and "Sort" not in plan
    per_task = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 4 and min(per_task) > 800
    once, again = (
        {(r["A"], r["p"]) for r in read.select("A", F.spark_partition_id().alias("p")).collect()} for _ in range(2)
    )
    assert once == again  # a task that is run again deals the same lines the same way


def executed_plans(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    found = store.executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(found.size())]


def test_writes_need_no_sort(spark, tmp_path, table):
    for month in ("202301", "202302"):
        put(tmp_path, f"A{month}.csv.gz", "A;B;C;", "1;2;3;")
    before = len(executed_plans(spark))
    load(spark, tmp_path, table, "202301")
    load(spark, tmp_path, table, "202301", "202302")
    plans = [p for p in executed_plans(spark)[before:] if "InsertIntoHadoopFsRelation" in p]
    assert len(plans) == 2 and not any("Sort " in p or "\nSort" in p for p in plans)
