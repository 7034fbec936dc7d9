"""Idempotent writes of month partitions.

Rows have no key, so a month is always *replaced*, never merged: re-running a month replaces its
rows, and an empty input empties the month.

* Rows are written into a new version folder; one renamed pointer file then shows all months of
  the write at once (``sources.month_pointer``). Whenever a job dies, every month is as before or as
  after, and a month that received no row is one that the new pointer does not name;
* a row of a month that was not asked for fails the job, before anything is shown;
* rows are counted, and any facts asked for found, per month with an Observation during the write, never
  by re-reading, and stored in the pointer;
* each task keeps one writer open per month (up to ``OPEN_WRITERS``), so its rows need no sort.

Catalog tables have no pointer: their months are replaced by dynamic partition overwrite, which moves
folders one after the other at commit, and emptied by an empty insert for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN
from ledgerlake.sources import month_pointer
from ledgerlake.sources.tables import TableRef

OPEN_WRITERS = 16  # months that a task writes side by side; with more, its rows are sorted
_WRITE_CONF = {
    "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_WRITERS),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",  # of inserts into catalog tables
}


@dataclass(frozen=True)
class WriteResult:
    rows: int
    months: tuple[str, ...]
    by_month: dict[str, int] = field(default_factory=dict)


def by_month(df: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """The same rows with those of a month side by side, in tasks of about the advisory size: large months
    are cut, small ones share a task. A write of many months then makes files by the bytes of a month, not
    one for each task and month, and its tasks keep few writers open. Costs one shuffle of the rows."""
    return df.hint("rebalance", F.col(column))


@contextmanager
def month_writes(spark: SparkSession) -> Iterator[None]:
    """Month writers side by side, and only the months written replaced, while a write is planned."""
    before = {key: spark.conf.get(key) for key in _WRITE_CONF}
    for key, value in _WRITE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def overwrite_month(df: DataFrame, table: TableRef, year_month: str) -> int:
    """Replace one month of ``table`` with ``df`` and return the rows written."""
    return overwrite_months(
        df.withColumn(PARTITION_COLUMN, F.lit(year_month)), table, [year_month]
    ).rows


def _clear_month(df: DataFrame, table: TableRef, year_month: str) -> None:
    """Empty one month of a catalog table by an empty insert."""
    view = f"_ledgerlake_month_{year_month}"
    nothing = df.limit(0).drop(PARTITION_COLUMN)
    nothing.createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}`" for c in nothing.columns)
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table.name} PARTITION ({PARTITION_COLUMN} = '{year_month}') "
        f"SELECT {columns} FROM {view}"
    )
    df.sparkSession.catalog.dropTempView(view)


def _month_counts(months: int) -> Column:
    """Rows by month, in one aggregate: a row costs one look-up, where a count for each month would
    compare every row with every month. The counts are exact as long as the sketch has room for all
    months, and it has twice that."""
    most = max(1, months)
    return F.call_function("approx_top_k", F.col(PARTITION_COLUMN), F.lit(most), F.lit(2 * most)).alias("months")


def overwrite_months(
    df: DataFrame,
    table: TableRef,
    months: list[str],
    facts: dict[str, Column] | None = None,
    made_from: dict[str, str] | None = None,
    options: dict[str, str] | None = None,
) -> WriteResult:
    """Replace every month of ``months`` with the rows of ``df`` in one job; other months are not
    touched, and a row of another month (or of none) fails the write. ``facts``: conditions; whether any
    row of a month meets one is kept with the month (``TableRef.months``), as is ``made_from``, the
    version of each month in the table that the rows were made from. ``options`` go to the Parquet writer."""
    spark, months, facts = df.sparkSession, sorted(set(months)), facts or {}
    made_from = made_from or {}
    month = F.col(PARTITION_COLUMN)
    stray = F.concat(F.lit("row of a month that is not written: "), F.coalesce(month, F.lit("none")))
    checked = df.withColumn(
        PARTITION_COLUMN, F.when(month.isin(months), month).otherwise(F.raise_error(stray))
    )
    seen = Observation()
    counted = checked.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        _month_counts(len(months)),
        *(F.collect_set(F.when(fact, month)).alias(f"with_{name}") for name, fact in facts.items()),
    )
    version = month_pointer.new_version()
    with month_writes(spark):
        if table.is_catalog:
            table.replace_months(counted, options)
        else:
            table.add_version(counted, version, options)
    result = seen.get
    by_month = dict.fromkeys(months, 0) | {r["item"]: int(r["count"]) for r in result["months"] or []}
    if sum(by_month.values()) != result["rows"]:
        raise RuntimeError(f"{sum(by_month.values())} rows counted by month of {result['rows']} written")
    if table.is_catalog:
        stored = spark.sql(f"SHOW PARTITIONS {table.name}").collect()  # one row a month
        held = {r[0].rpartition("=")[2] for r in stored}
        for empty in (m for m, rows in by_month.items() if not rows and m in held):
            _clear_month(checked, table, empty)
    else:
        entries = {
            m: {"version": version, "rows": by_month[m]}
            | {name: m in (result[f"with_{name}"] or []) for name in facts}
            | ({"made_from": made_from[m]} if m in made_from else {})
            for m in months
        }
        month_pointer.swap(spark, table.path, {m: e if e["rows"] else None for m, e in entries.items()})
    written = tuple(m for m, rows in by_month.items() if rows)
    return WriteResult(rows=int(result["rows"]), months=written, by_month=by_month)


def overwrite_table(df: DataFrame, table: TableRef) -> int:
    """Replace a whole (small) table and return the rows written."""
    seen = Observation()
    table.replace(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def overwrite_partitioned_table(df: DataFrame, table: TableRef) -> int:
    """Replace a whole table, partitioned by month; returns the rows written. Its months are few."""
    spark, seen = df.sparkSession, Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.collect_set(PARTITION_COLUMN).alias("months")
    )
    version = month_pointer.new_version()
    with month_writes(spark):
        if table.is_catalog:
            counted.write.mode("overwrite").format("parquet").partitionBy(PARTITION_COLUMN).saveAsTable(table.name)
        else:
            table.add_version(counted, version)
    if not table.is_catalog:
        shown = {m: {"version": version} for m in seen.get["months"] or []}
        month_pointer.swap(spark, table.path, shown, whole=True)
    return int(seen.get["rows"])
