"""Claims-like text extract derived from the TPC-H style test tables.

No real monthly file is available, so the raw extract is derived from lineitem, its order's
customer and its part, with anomalies injected by a deterministic selector. Every value is text,
exactly as it would come out of a delimited file.

Scale notes: lineitem is the only large input and always the streamed side. Orders and customer
are first reduced to (order key -> nation key) and that narrow relation is joined to lineitem;
part is reduced to (part key -> type). No side is hinted: the optimizer broadcasts one whose size in
bytes is known to be small, and adaptive execution re-plans the others by the bytes it measures and
splits a skewed key, so nothing grows on the driver or in one task.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contract import FIXTURE_RAW_COLUMNS
from ledgerlake.sinks.partitions import by_month

# --- Fixed values: the anomaly selector of the fixture (k = order key * 10 + line number) --
FLOW_MISMATCH_EVERY = 101  # processing month replaced by 209901
FLOW_NULL_EVERY = 149  # empty processing month (valid: it raises no reason)
CARE_ZERO_EVERY = 103  # care 0000/00 (unknown)
CARE_ONE_EVERY = 107  # care 0001/01 (unknown)
CARE_MONTH_13_EVERY = 109  # care month 13
CARE_LATE_EVERY = 113  # care nine months later (after processing)
SPEND_COMMA_EVERY = 127  # decimal comma
SPEND_NULL_EVERY = 131  # empty spend
SPEND_OVERFLOW_EVERY = 137  # twenty ones
QUANTITY_FRACTION_EVERY = 139  # quantity 1.5
MISMATCH_MONTH = "209901"
INGESTED_AT = datetime(2026, 1, 15, tzinfo=timezone.utc)
FILE_TEMPLATE = "A{year_month}.csv.gz"
# --- end of fixed values -------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _hit(k: Column, every: int) -> Column:
    return k % every == 0


def claims_text(
    spark: SparkSession, sf_dir: str, with_key: bool = False, together: bool = False
) -> DataFrame:
    """The raw extract: the fixture text columns plus ``_year_month`` (and ``k`` if asked).

    ``together``: rows of a month side by side, for writes by month. They are dealt as numbers, before
    they become text, which takes less to shuffle."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    order_nation = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select("o_orderkey", "c_nationkey")
    )
    part_type = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = line.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part_type, F.col("l_partkey") == F.col("p_partkey")
    )

    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    rows = rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_k"), "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        "p_type", "c_nationkey", (year * 100 + month).alias("_ym"),
    )
    if together:
        rows = by_month(rows, "_ym")
    k, ym = F.col("_k"), F.col("_ym")
    care = year * 12 + month - 1 - (F.col("l_linenumber") - 1)
    late = care + 9

    def care_year(c: Column) -> Column:
        return _text(F.floor(c / 12).cast("bigint"))

    def care_month_text(c: Column) -> Column:
        return F.lpad(_text(c % 12 + 1), 2, "0")

    price = _text(F.col("l_extendedprice").cast("decimal(18,2)"))
    reimbursed = F.col("l_extendedprice").cast("decimal(18,2)") * (
        1 - F.col("l_discount").cast("decimal(18,2)")
    )
    columns = {
        "flow_month": F.when(_hit(k, FLOW_MISMATCH_EVERY), F.lit(MISMATCH_MONTH))
        .when(_hit(k, FLOW_NULL_EVERY), F.lit(None).cast("string"))
        .otherwise(_text(ym)),
        "care_year": F.when(_hit(k, CARE_ZERO_EVERY), F.lit("0000"))
        .when(_hit(k, CARE_ONE_EVERY), F.lit("0001"))
        .when(_hit(k, CARE_LATE_EVERY), care_year(late))
        .otherwise(care_year(care)),
        "care_month": F.when(_hit(k, CARE_ZERO_EVERY), F.lit("00"))
        .when(_hit(k, CARE_ONE_EVERY), F.lit("01"))
        .when(_hit(k, CARE_MONTH_13_EVERY), F.lit("13"))
        .when(_hit(k, CARE_LATE_EVERY), care_month_text(late))
        .otherwise(care_month_text(care)),
        "status_code": F.concat(F.lit("0"), F.col("l_returnflag"), F.col("l_linestatus")),
        "service_code": F.col("p_type"),
        "region_code": _text(F.col("c_nationkey")),
        "spend": F.when(_hit(k, SPEND_COMMA_EVERY), F.regexp_replace(price, r"\.", ","))
        .when(_hit(k, SPEND_NULL_EVERY), F.lit(None).cast("string"))
        .when(_hit(k, SPEND_OVERFLOW_EVERY), F.lit("1" * 20))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), price))
        .otherwise(price),
        "reimbursed": _text(reimbursed),
        "overrun": F.regexp_replace(_text(F.col("l_tax").cast("decimal(18,2)")), "^0", ""),
        "quantity": F.when(_hit(k, QUANTITY_FRACTION_EVERY), F.lit("1.5")).otherwise(
            _text(F.col("l_quantity").cast("int"))
        ),
        "_year_month": _text(ym),
    }
    selected = [columns[c].alias(c) for c in (*FIXTURE_RAW_COLUMNS, "_year_month")]
    if with_key:
        selected.insert(0, k.alias("k"))
    return rows.select(*selected)


def claims_bronze(
    spark: SparkSession, sf_dir: str, with_key: bool = False, together: bool = False
) -> DataFrame:
    """The extract as bronze rows: text columns plus the three technical columns."""
    text = claims_text(spark, sf_dir, with_key=with_key, together=together)
    return text.select(
        *[c for c in text.columns if c != "_year_month"],
        F.concat(F.lit("A"), F.col("_year_month"), F.lit(".csv.gz")).alias("_source_file"),
        F.lit(INGESTED_AT).alias("_ingested_at"),
        F.col("_year_month"),
    )
