"""Benchmark: the monthly pipeline end to end plus the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) and prints ONE
JSON line. ``value`` is the time of the monthly job chain: bronze load of every month from the
raw CSV.gz files, silver build with quarantine and reconciliation, loading the label file into the
label table, gold marts with their checks. Two preparation steps are timed but not counted:
``raw_files`` (producing the monthly files from the test tables, the stand-in for the downloads)
and ``labels_build`` (the offline merge of label sources into the label file).

``claims_56`` is the like-for-like measure, of ``$BENCH_CLAIMS_ROWS`` rows a month (100,000; 0: left out): two months of the 56-column
contract with as many generated rows each, one plain ``.gz`` file a month, through
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "spend_by_service",
    "spend_by_region",
    "top_services",
    "rejection_reason_counts",
    "missing_labels",
    "label_coverage",
    "totals_match",
    "table_parity",
]


BASELINE_ROWS = 71_350_000
BASELINE_SECONDS = {"bronze": 277.0, "silver": 479.0, "gold": 15.0}


def claims_rows() -> int:
    return int(os.environ.get("BENCH_CLAIMS_ROWS", "100000"))


def claims_months(spark, house) -> dict:
    """Two months of generated 56-column rows through the three jobs; microseconds a row."""
    from pyspark.sql import functions as F

    from ledgerlake.contract import PARTITION_COLUMN
    from ledgerlake.plans import bronze, gold, silver
    from ledgerlake.plans.layout import LABELS_SCHEMA
    from ledgerlake.sinks.partitions import overwrite_table
    from ledgerlake.sources import monthly_files

    contract = house.contract
    per_month, months = claims_rows(), ["202501", "202502"]
    month = F.element_at(F.array(*map(F.lit, months)), (F.col("id") % 2 + 1).cast("int"))
    kinds = {source: field.kind for field in contract.columns for source in field.sources}

    def value(i: int, name: str):
        mixed = F.abs(F.xxhash64(F.col("id"), F.lit(i)))
        if name == "FLX_ANN_MOI":
            return month
        if name in ("SOI_ANN", "SOI_MOI"):
            return F.lit({"SOI_ANN": "2024", "SOI_MOI": "11"}[name])
        if kinds[name] == "text":
            return (mixed % (5 + 37 * (i % 4))).cast("string")
        if kinds[name] == "int":
            return (mixed % 30).cast("string")
        return ((mixed % 100_000) / 100).cast("decimal(18,2)").cast("string")

    rows = spark.range(2 * per_month).select(
        *(value(i, c).alias(c) for i, c in enumerate(contract.raw_columns)), month.alias(PARTITION_COLUMN)
    )
    monthly_files.write_month_files(
        rows.repartition(2, PARTITION_COLUMN), f"{house.base}/parts", list(contract.raw_columns)
    )
    monthly_files.name_single_parts(
        spark,
        monthly_files.month_files(f"{house.base}/parts", months, layout=monthly_files.FIXTURE_LAYOUT),
        monthly_files.month_files(house.raw_dir, months),
    )
    overwrite_table(spark.createDataFrame([("PRS_NAT", "1", "one", "list")], LABELS_SCHEMA), house.labels)
    jobs = {
        "bronze": lambda: bronze.ingest_months(spark, house.raw_dir, house.bronze, months),
        "silver": lambda: silver.build_silver(
            spark, house.bronze, house.silver, house.quarantine, months, contract, codes=house.codes
        ),
        "gold": lambda: gold.build_gold(
            spark, house.silver, house.labels, house.gold("service"), house.gold("region"), contract,
            fail_on_error=False, codes=house.codes,
        ),
    }
    out: dict = {"rows": 2 * per_month, "seconds": {}, "us_per_row": {}, "baseline_us_per_row": {}}
    for name, job in jobs.items():
        t0 = time.perf_counter()
        job()
        seconds = time.perf_counter() - t0
        out["seconds"][name] = round(seconds, 3)
        out["us_per_row"][name] = round(seconds * 1e6 / (2 * per_month), 2)
        out["baseline_us_per_row"][name] = round(BASELINE_SECONDS[name] * 1e6 / BASELINE_ROWS, 2)
    for key in ("us_per_row", "baseline_us_per_row"):
        out[key]["pipeline"] = round(sum(out[key].values()), 2)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", scratch)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")

    from ledgerlake.contract import CLAIMS, FIXTURE
    from ledgerlake.plans import bronze, catalog, gold, silver
    from ledgerlake.operators.labels import build_dimension
    from ledgerlake.sinks.partitions import overwrite_table
    from ledgerlake.plans.layout import Lakehouse
    from ledgerlake.session import configure, work_path
    from ledgerlake.sources import fixture, labels, monthly_files

    configure(spark)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    house = Lakehouse(work_path(spark, "bench"), FIXTURE)
    text = fixture.claims_text(spark, sf_dir)
    timed("raw_files", lambda: monthly_files.write_month_files(text, house.raw_dir, list(FIXTURE.raw_columns)))
    months = sorted(r[0] for r in text.select("_year_month").distinct().collect())

    rows = timed(
        "bronze_load",
        lambda: bronze.ingest_months(
            spark, house.raw_dir, house.bronze, months, fixture.INGESTED_AT,
            layout=monthly_files.FIXTURE_LAYOUT,
        ),
    )
    result = timed(
        "silver_build",
        lambda: silver.build_silver(spark, house.bronze, house.silver, house.quarantine, months, FIXTURE, codes=house.codes),
    )
    label_file = f"{house.base}/label_file"
    timed(
        "labels_build",
        lambda: build_dimension(
            labels.fixture_sources(spark, sf_dir), labels.fixture_complements(spark, sf_dir),
            labels.FIXTURE_CODE_COLUMNS,
        ).write.mode("overwrite").option("header", True).option("sep", ";").csv(label_file),
    )
    timed(
        "labels_load",
        lambda: overwrite_table(labels.read_dimension(spark, label_file), house.labels),
    )
    checks = timed(
        "gold_build",
        lambda: gold.build_gold(
            spark, house.silver, house.labels, house.gold("service"), house.gold("region"),
            FIXTURE, fail_on_error=False, codes=house.codes,
        ),
    )
    pipeline = sum(times[k] for k in ("bronze_load", "silver_build", "labels_load", "gold_build"))

    # a monthly run: the busiest month reloaded end to end, gold rebuilt for that month only
    month = max(rows, key=lambda m: rows[m])
    timed("month_bronze", lambda: bronze.ingest_months(
        spark, house.raw_dir, house.bronze, [month], fixture.INGESTED_AT,
        layout=monthly_files.FIXTURE_LAYOUT))
    timed("month_silver", lambda: silver.build_silver(
        spark, house.bronze, house.silver, house.quarantine, [month], FIXTURE, codes=house.codes))
    timed("month_gold", lambda: gold.build_gold(
        spark, house.silver, house.labels, house.gold("service"), house.gold("region"),
        FIXTURE, fail_on_error=False, codes=house.codes, months=[month]))

    # the whole chain again: reloading is idempotent (same counts), and warm
    t0 = time.perf_counter()
    rows_again = bronze.ingest_months(
        spark, house.raw_dir, house.bronze, months, fixture.INGESTED_AT,
        layout=monthly_files.FIXTURE_LAYOUT,
    )
    result_again = silver.build_silver(
        spark, house.bronze, house.silver, house.quarantine, months, FIXTURE, codes=house.codes
    )
    overwrite_table(labels.read_dimension(spark, label_file), house.labels)
    gold.build_gold(
        spark, house.silver, house.labels, house.gold("service"), house.gold("region"),
        FIXTURE, fail_on_error=False, codes=house.codes,
    )
    rerun = round(time.perf_counter() - t0, 3)
    idempotent = rows_again == rows and result_again.rows == result.rows and (
        result_again.amounts == result.amounts
    )

    claims = None
    if claims_rows():
        claims = claims_months(spark, Lakehouse(work_path(spark, "bench-claims"), CLAIMS))

    qs = catalog.QUERIES
    timed("query_tables", lambda: catalog.fixture_lakehouse(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda n=name: qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "pipeline_seconds",
                "value": round(pipeline, 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "rerun_pipeline_seconds": rerun,
                "rerun_idempotent": idempotent,
                "monthly_run_seconds": round(
                    times["month_bronze"] + times["month_silver"] + times["month_gold"], 3
                ),
                "rows": {
                    "bronze": sum(rows.values()),
                    "busiest_month": rows[month],
                    "silver": result.rows["silver"],
                    "quarantine": result.rows["quarantine"],
                    "months": len(months),
                },
                "claims_56": claims,
                "checks_with_rows": {c.name: c.rows for c in checks if c.rows},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
