"""Where the layers live and with which schema they are read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerlake.contract import PARTITION_COLUMN, TECHNICAL_FIELDS, Contract
from ledgerlake.operators.silver import REASONS_COLUMN
from ledgerlake.sources.tables import TableRef

# --- Fixed values: label table columns (code column, code, label, source) -------------------
LABELS_SCHEMA = StructType(
    [StructField(n, StringType(), False) for n in ("code_column", "code", "libelle", "source")]
)
# --- end of fixed values -------------------------------------------------------------------


CODES_SCHEMA = StructType(
    [StructField("code_column", StringType()), StructField("code", StringType()),
     StructField("lignes", LongType()), StructField(PARTITION_COLUMN, StringType())]
)


def quarantine_schema(contract: Contract) -> StructType:
    raw = [StructField(c, StringType()) for c in contract.raw_columns]
    technical = list(TECHNICAL_FIELDS)
    return StructType(
        raw
        + technical[:2]
        + [StructField(REASONS_COLUMN, ArrayType(StringType()))]
        + technical[2:]
    )


@dataclass(frozen=True)
class Lakehouse:
    """The tables of one contract under one base folder."""

    base: str
    contract: Contract

    @property
    def raw_dir(self) -> str:
        return f"{self.base}/raw"

    @property
    def bronze(self) -> TableRef:
        return TableRef(path=f"{self.base}/bronze", schema=self.contract.bronze_schema())

    @property
    def silver(self) -> TableRef:
        return TableRef(path=f"{self.base}/silver", schema=self.contract.silver_schema())

    @property
    def codes(self) -> TableRef:
        """Rows of silver by month and code."""
        return TableRef(path=f"{self.base}/silver_codes", schema=CODES_SCHEMA)

    @property
    def profiles(self) -> TableRef:
        """Profiles of bronze by month and raw column."""
        return TableRef(path=f"{self.base}/bronze_profiles")

    @property
    def quarantine(self) -> TableRef:
        return TableRef(path=f"{self.base}/quarantine", schema=quarantine_schema(self.contract))

    @property
    def labels(self) -> TableRef:
        return TableRef(path=f"{self.base}/labels", schema=LABELS_SCHEMA)

    def gold(self, name: str) -> TableRef:
        return TableRef(path=f"{self.base}/gold/{name}")


@dataclass(frozen=True)
class CatalogLakehouse:
    """The same tables, registered in one database of the session's catalog under their names.

    Staging is a view there, so SQL users and the gold job read the same thing (``plans.staging``)."""

    database: str
    contract: Contract

    def _table(self, name: str, schema: StructType | None = None) -> TableRef:
        return TableRef(name=f"`{self.database}`.`{name}`", schema=schema)

    @property
    def bronze(self) -> TableRef:
        return self._table("bronze", self.contract.bronze_schema())

    @property
    def silver(self) -> TableRef:
        return self._table("silver", self.contract.silver_schema())

    @property
    def codes(self) -> TableRef:
        return self._table("silver_codes", CODES_SCHEMA)

    @property
    def quarantine(self) -> TableRef:
        return self._table("quarantine", quarantine_schema(self.contract))

    @property
    def labels(self) -> TableRef:
        return self._table("labels", LABELS_SCHEMA)

    @property
    def staging(self) -> TableRef:
        return self._table("stg_depenses")

    def gold(self, name: str) -> TableRef:
        return self._table(name)
