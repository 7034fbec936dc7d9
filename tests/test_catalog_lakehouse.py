"""The jobs on catalog tables: months replaced by name, staging as a stored view, the same marts."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.contract import CLAIMS, PARTITION_COLUMN
from ledgerlake.plans import gold as gold_plan
from ledgerlake.plans.gold import build_gold
from ledgerlake.plans.layout import LABELS_SCHEMA, CatalogLakehouse, Lakehouse
from ledgerlake.plans.silver import build_silver
from ledgerlake.plans.staging import create_database, create_staging
from ledgerlake.session import work_name
from ledgerlake.sinks.partitions import overwrite_month, overwrite_table

JANUARY = [{"FLX_ANN_MOI": "202501", "SOI_ANN": "2024", "PRS_NAT": "10"}, {"FLX_ANN_MOI": "202501", "PRS_PAI_MNT": "x"}]
FEBRUARY = [{"FLX_ANN_MOI": "202502", "SOI_ANN": "2024", "PRS_NAT": s} for s in ("10", "20", "20")]


def _build(spark, loaded, house, steps):
    for month, rows in steps:
        overwrite_month(loaded(*rows, month=month), house.bronze, month)
        build_silver(spark, house.bronze, house.silver, house.quarantine, [month], CLAIMS, codes=house.codes)


@pytest.fixture
def house(spark, loaded):
    house = CatalogLakehouse(work_name("ledgerlake_test"), CLAIMS)
    create_database(spark, house)
    overwrite_table(spark.createDataFrame([("PRS_NAT", "10", "TEN", "x")], LABELS_SCHEMA), house.labels)
    # January twice: with a rejected row, then without; the month's quarantine is emptied
    _build(spark, loaded, house, [("202501", JANUARY), ("202502", FEBRUARY), ("202501", JANUARY[:1] * 2)])
    yield house
    spark.sql(f"DROP DATABASE `{house.database}` CASCADE")


def _gold(spark, house, months=None):
    return build_gold(
        spark, house.silver, house.labels, house.gold(gold_plan.SERVICE_MART), house.gold(gold_plan.REGION_MART),
        CLAIMS, fail_on_error=False, months=months, codes=house.codes,
    )


def test_months_are_replaced_by_column_name(spark, house):
    rows = {r[0]: r[1] for r in house.silver.read(spark).groupBy(PARTITION_COLUMN).count().collect()}
    assert rows == {"202501": 2, "202502": 3}
    assert house.quarantine.read(spark).count() == 0
    assert set(house.quarantine.read(spark).columns) == {f.name for f in house.quarantine.schema}


def test_staging_is_a_view_that_follows_silver(spark, loaded, house):
    create_staging(spark, house)
    view = spark.read.table(house.staging.name)
    assert view.count() == 5 and len(view.columns) == 7
    _build(spark, loaded, house, [("202502", FEBRUARY[:1])])
    assert spark.read.table(house.staging.name).count() == 3
    plan = spark.sql(f"SELECT sum({CLAIMS.amount}) FROM {house.staging.name} WHERE {CLAIMS.service} = '10'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo({CLAIMS.service},10)" in text  # reaches the scan
    assert CLAIMS.region not in text.split("ReadSchema")[-1]
    create_staging(spark, house)  # again: replaced


def test_marts_equal_those_of_path_tables(spark, loaded, house, tmp_path):
    files = Lakehouse(str(tmp_path / "lake"), CLAIMS)
    overwrite_table(spark.createDataFrame([("PRS_NAT", "10", "TEN", "x")], LABELS_SCHEMA), files.labels)
    _build(spark, loaded, files, [("202501", JANUARY[:1] * 2), ("202502", FEBRUARY)])
    results = [{(r.name, r.rows) for r in _gold(spark, h)} for h in (files, house)]
    assert results[0] == results[1]
    _build(spark, loaded, house, [("202502", FEBRUARY)])
    _gold(spark, house, ["202502"])  # a monthly run on catalog tables
    for name in (gold_plan.SERVICE_MART, gold_plan.REGION_MART):
        mart = files.gold(name).read(spark)
        order = [F.col(c).cast("string").alias(c) for c in sorted(mart.columns)]
        expected = mart.select(*order).collect()
        assert sorted(expected) == sorted(house.gold(name).read(spark).select(*order).collect())
