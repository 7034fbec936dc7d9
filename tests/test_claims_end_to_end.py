"""The 56-column claims path from a monthly file to the gold marts."""

from datetime import datetime, timezone
from decimal import Decimal

from ledgerlake.contract import CLAIMS
from ledgerlake.plans import bronze, gold, silver
from ledgerlake.plans.layout import LABELS_SCHEMA, Lakehouse
from ledgerlake.sinks.partitions import overwrite_table
from tests.conftest import claims_file

LOADED_AT = datetime(2026, 1, 15, tzinfo=timezone.utc)


def test_month_file_to_marts(spark, tmp_path):
    house = Lakehouse(str(tmp_path / "lake"), CLAIMS)
    raw = tmp_path / "lake" / "raw"
    claims_file(
        raw, {"PRS_NAT": "3134"}, {"PRS_NAT": "0111", "BEN_RES_REG": "84"}, {"PRS_PAI_MNT": "12,50"},
        {"SOI_MOI": "11"}, {"PRS_NAT": "3134", "PRS_PAI_MNT": ""},
    )
    assert bronze.ingest_months(spark, str(raw), house.bronze, ["202503"], LOADED_AT) == {"202503": 5}
    b = house.bronze.read(spark).where("PRS_NAT = '0111'").first()
    assert b["BEN_RES_REG"] == "84" and b["_source_file"] == "A202503.csv.gz"

    result = silver.build_silver(spark, house.bronze, house.silver, house.quarantine, ["202503"], CLAIMS)
    assert result.rows == {"bronze": 5, "silver": 3, "quarantine": 2}
    assert result.amounts["bronze"] == result.amounts["silver"] + result.amounts["quarantine"]
    assert dict(result.reasons) == {"non_numerique:PRS_PAI_MNT": 1, "soins_apres_traitement": 1}

    labels = spark.createDataFrame(
        [("PRS_NAT", "3134", "SOME SERVICE", "list"), ("BEN_RES_REG", "13", "UNKNOWN", "list")],
        LABELS_SCHEMA,
    )
    overwrite_table(labels, house.labels)
    checks = gold.build_gold(
        spark, house.silver, house.labels, house.gold("s"), house.gold("r"), CLAIMS,
        fail_on_error=False,
    )
    by_name = {c.name: c.rows for c in checks}
    assert by_name["not_null_staging"] == 1  # the empty spend is valid but NULL
    assert by_name["missing_labels"] > 0  # 0111 has no label (raw text join)
    service = {r["nature_prestation"]: r for r in house.gold("s").read(spark).collect()}
    assert service["3134"]["nombre_lignes"] == 2  # the row with an empty spend counts
    assert service["3134"]["montant_depense"] == Decimal("8.25")
    assert service["3134"]["libelle_nature_prestation"] == "SOME SERVICE"
    assert service["0111"]["libelle_nature_prestation"] is None
    region = {r["region_residence_beneficiaire"]: r for r in house.gold("r").read(spark).collect()}
    assert region["13"]["part_depense_nationale"] == Decimal("0.5000")
