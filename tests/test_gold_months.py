"""A gold run over some months reads no file of others, and still audits the codes of all."""

from pathlib import Path

import pytest

from ledgerlake.contract import CLAIMS, PARTITION_COLUMN
from ledgerlake.operators import quality
from ledgerlake.plans import gold as gold_plan
from ledgerlake.plans.gold import build_gold
from ledgerlake.plans.layout import LABELS_SCHEMA, Lakehouse
from ledgerlake.plans.silver import NO_MONTH, build_silver
from ledgerlake.sinks.partitions import overwrite_month, overwrite_table
from ledgerlake.sources.month_pointer import month_folder

MONTHS = ["202501", "202502", "202503"]


def month_rows(loaded, month, *services, lost=False):
    rows = [{"FLX_ANN_MOI": "" if lost and not k else month, "SOI_ANN": "2024", "PRS_NAT": s} for k, s in enumerate(services)]
    return loaded(*rows, month=month)


@pytest.fixture
def house(spark, loaded, tmp_path):
    house = Lakehouse(str(tmp_path / "lake"), CLAIMS)
    overwrite_month(month_rows(loaded, "202501", "10", "11", "11"), house.bronze, "202501")
    overwrite_month(month_rows(loaded, "202502", "20", "10", lost=True), house.bronze, "202502")
    overwrite_month(month_rows(loaded, "202503", "30"), house.bronze, "202503")
    build_silver(spark, house.bronze, house.silver, house.quarantine, MONTHS, CLAIMS, codes=house.codes)
    overwrite_table(spark.createDataFrame([("PRS_NAT", "10", "TEN", "x")], LABELS_SCHEMA), house.labels)
    return house


def run(spark, house, months=None):
    results = build_gold(
        spark, house.silver, house.labels, house.gold("s"), house.gold("r"), CLAIMS,
        fail_on_error=False, months=months, codes=house.codes,
    )
    return {r.name: r.rows for r in results}


def break_month(spark, house, month):
    """Make every file of a silver month unreadable."""
    folder = Path(month_folder(house.silver.path, month, house.silver.months(spark)[month]))
    files = list(folder.glob("*.parquet"))
    assert files
    for file in files:
        file.write_bytes(b"not a parquet file")
        (folder / f".{file.name}.crc").unlink(missing_ok=True)


def marts(spark, house):
    return sorted(map(repr, house.gold("s").read(spark).collect()))


def test_only_the_month_and_those_with_lost_rows_are_opened(spark, house):
    whole, before = run(spark, house), marts(spark, house)
    facts = {m: e[NO_MONTH] for m, e in house.silver.months(spark).items()}
    assert facts == {"202501": False, "202502": True, "202503": False}
    break_month(spark, house, "202501")
    part = run(spark, house, ["202503"])
    assert part["missing_labels"] == whole["missing_labels"] > 0
    assert marts(spark, house) == before
    with pytest.raises(Exception, match="(?i)parquet"):
        run(spark, house, ["202501"])


def test_counts_of_another_version_are_not_used(spark, house, loaded):
    # silver of a month is replaced without its counts, as by a job that died in between
    overwrite_month(month_rows(loaded, "202503", "77", "77"), house.bronze, "202503")
    build_silver(spark, house.bronze, house.silver, house.quarantine, ["202503"], CLAIMS)
    found = gold_plan.code_counts(spark, house.silver, house.codes, CLAIMS)
    want = quality.code_counts(house.silver.read(spark), CLAIMS)
    assert sorted(found.collect()) == sorted(want.collect())
    assert found.where("code = '77'").first()["lignes"] == 2
    build_silver(spark, house.bronze, house.silver, house.quarantine, ["202503"], CLAIMS, codes=house.codes)
    kept = sorted(want.collect())
    for month in MONTHS:  # all counts are stored: silver is not read
        break_month(spark, house, month)
    assert sorted(gold_plan.code_counts(spark, house.silver, house.codes, CLAIMS).collect()) == kept


def test_monthly_counts_add_up(spark, house):
    monthly = house.codes.read(spark)
    assert {r[0] for r in monthly.select(PARTITION_COLUMN).distinct().collect()} == set(MONTHS)
    merged = sorted(quality.merged_code_counts(monthly).collect())
    assert merged == sorted(quality.code_counts(house.silver.read(spark), CLAIMS).collect())
