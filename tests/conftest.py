"""Shared fixtures: one local Spark session, and claims rows that come in through a monthly file."""

from __future__ import annotations

import gzip
import sys
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlake.contract import CLAIMS  # noqa: E402
from ledgerlake.sources.monthly_files import month_files, read_months  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
LOADED_AT = datetime(2026, 3, 9, 12, 30, tzinfo=timezone.utc)
MONTH = "202503"

# A value for each kind of column; codes count up along the header.
SAMPLE = {"amount": "8.25", "rate": "65", "int": "4"}
MONTHS_OF = {"FLX_ANN_MOI": "202503", "SOI_ANN": "2025", "SOI_MOI": "02"}


def claims_row(**changes: str) -> dict[str, str]:
    """A valid raw row of the claims contract, made from its declaration."""
    kinds = {source: field.kind for field in CLAIMS.columns for source in field.sources}
    row = {c: SAMPLE.get(kinds[c], str(10 + i)) for i, c in enumerate(CLAIMS.raw_columns)}
    return row | MONTHS_OF | changes


def claims_file(folder: Path, *rows: dict[str, str], month: str = MONTH, header: list[str] | None = None) -> Path:
    """The monthly file of ``rows`` (changes to the valid row)."""
    header = header or list(CLAIMS.raw_columns)
    folder.mkdir(parents=True, exist_ok=True)
    path = Path(month_files(str(folder), [month])[0].path)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        for values in (dict(zip(header, header)), *(claims_row(**r) for r in rows)):
            out.write("".join(f"{values[c]};" for c in header) + "\n")
    return path


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> Iterator[SparkSession]:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not (
        session.conf.get("spark.checkpoint.dir", None) or session.sparkContext.getCheckpointDir()
    ):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture
def loaded(spark: SparkSession, tmp_path: Path) -> Callable[..., DataFrame]:
    """``loaded({"PRS_PAI_MNT": "abc"}, {})``: bronze rows of a monthly file with these changes."""

    def load(*rows: dict[str, str], month: str = MONTH) -> DataFrame:
        folder = tmp_path / f"incoming-{len(list(tmp_path.iterdir()))}"
        claims_file(folder, *rows, month=month)
        return read_months(spark, str(folder), [month], LOADED_AT, columns=list(CLAIMS.raw_columns))

    return load
