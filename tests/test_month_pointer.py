"""Months are replaced in one step: whatever point a job dies at, readers see old or new rows."""

import threading
from pathlib import Path

import pytest

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.sinks import partitions
from ledgerlake.sinks.partitions import overwrite_month, overwrite_months, overwrite_partitioned_table
from ledgerlake.sources import month_pointer
from ledgerlake.sources.tables import TableRef, read_months

SCHEMA = "x string, _year_month string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def shown(spark, table):
    return sorted(tuple(r) for r in table.read(spark).collect())


@pytest.fixture
def table(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "t"), schema=rows(spark).schema)
    overwrite_months(rows(spark, ("a", "202501"), ("b", "202502"), ("c", "202503")), table, ["202501", "202502", "202503"])
    return table


OLD = [("a", "202501"), ("b", "202502"), ("c", "202503")]
NEW = [("a", "202501"), ("y", "202502"), ("z", "202502")]  # 202502 replaced, 202503 emptied


class Died(Exception):
    pass


def dies(*_, **__):
    raise Died


@pytest.mark.parametrize(
    "step,seen",
    [("version_folder", OLD), ("_publish", OLD), ("_clean", NEW), (None, NEW)],
    ids=["while writing rows", "before the rename", "after the rename", "not at all"],
)
def test_a_job_that_dies_leaves_old_or_new_months(spark, table, monkeypatch, step, seen):
    change = rows(spark, ("y", "202502"), ("z", "202502"))
    if step is None:
        overwrite_months(change, table, ["202502", "202503"])
    else:
        with monkeypatch.context() as patched:
            patched.setattr(month_pointer, step, dies)
            with pytest.raises(Died):
                overwrite_months(change, table, ["202502", "202503"])
    assert shown(spark, table) == seen
    overwrite_months(change, table, ["202502", "202503"])  # a rerun is always safe
    assert shown(spark, table) == NEW


def test_a_failing_row_shows_nothing(spark, table):
    with pytest.raises(Exception, match="not written: 202509"):
        overwrite_months(rows(spark, ("y", "202502"), ("z", "202509")), table, ["202502"])
    assert shown(spark, table) == OLD


def test_a_reader_under_way_keeps_its_month(spark, table):
    before = table.read(spark)
    overwrite_month(rows(spark, ("n", "202502")), table, "202502")
    assert sorted(tuple(r) for r in before.collect()) == OLD
    assert ("n", "202502") in shown(spark, table)


def test_old_versions_go(spark, table):
    for k in range(6):
        overwrite_month(rows(spark, (f"n{k}", "202502")), table, "202502")
    folders = list(Path(table.path).glob(f"{month_pointer.VERSION}=*/{PARTITION_COLUMN}=202502"))
    assert len(folders) == 2 and len(list((Path(table.path) / month_pointer.FOLDER).glob("*.json"))) == 2
    assert shown(spark, table) == [("a", "202501"), ("c", "202503"), ("n5", "202502")]


def test_writers_of_other_months_do_not_undo_each_other(spark, table):
    failed = []

    def write(month):
        try:
            overwrite_month(rows(spark, (month, month)), table, month)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(f"20250{m}",)) for m in (4, 5, 6, 7)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    assert {m for _, m in shown(spark, table)} == {f"20250{m}" for m in range(1, 8)}


def test_facts_are_kept_by_month(spark, table):
    from pyspark.sql import functions as F

    change = rows(spark, ("q", "202502"), (None, "202502"), (None, "202504"))
    overwrite_months(change, table, ["202502", "202503", "202504"], facts={"without_x": F.col("x").isNull()})
    assert overwrite_months(rows(spark, ("q", "202505")), table, ["202505"], facts={"without_x": F.col("x").isNull()}).rows == 1
    assert table.months(spark)["202505"]["without_x"] is False
    overwrite_month(rows(spark), table, "202505")
    months = table.months(spark)
    assert {m: (e["rows"], e.get("without_x")) for m, e in months.items()} == {
        "202501": (1, None), "202502": (2, True), "202504": (1, True),
    }


def test_whole_table_and_months_asked_for(spark, table):
    assert overwrite_partitioned_table(rows(spark, ("w", "202507"), ("v", "202508")), table) == 2
    assert shown(spark, table) == [("v", "202508"), ("w", "202507")]
    assert [r["x"] for r in read_months(spark, table, ["202508", "209901"]).collect()] == ["v"]
    assert len(read_months(spark, table, ["202508"]).inputFiles()) == 1
    assert read_months(spark, table, ["209901"]).collect() == []
    overwrite_partitioned_table(rows(spark), table)
    assert shown(spark, table) == []


def test_table_without_pointer_is_read_as_it_lies(spark, tmp_path):
    table = TableRef(path=str(tmp_path / "plain"), schema=rows(spark).schema)
    rows(spark, ("a", "202501"), ("b", "202502")).write.partitionBy(PARTITION_COLUMN).parquet(table.path)
    assert table.months(spark) is None and len(shown(spark, table)) == 2
    assert [r["x"] for r in read_months(spark, table, ["202502"]).collect()] == ["b"]


def test_pointer_taken_by_others_is_an_error(spark, table, monkeypatch):
    monkeypatch.setattr(month_pointer, "_publish", lambda *_: False)
    with pytest.raises(RuntimeError, match="other writers"):
        overwrite_month(rows(spark, ("n", "202502")), table, "202502")
    assert partitions.WriteResult and shown(spark, table) == OLD
