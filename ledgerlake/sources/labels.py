"""Label inputs: the dimension file, complements, code lists, lexicon sheets, test sources.

Files are read by Spark (never line by line on the driver) with a position column so that
first-wins / last-wins rules do not depend on task order: the position is (file name, split offset,
row id), which follows the order of the lines in the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.labels import as_source, first_label_per_code, last_label_per_code
from ledgerlake.plans.layout import LABELS_SCHEMA
from ledgerlake.sources.fixture import table

SEPARATOR = ";"


def _csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("sep", SEPARATOR)
    reader = reader.option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The label dimension file (code column; code; label; source) with an explicit schema.

    Columns are taken by position, so a file whose header names differ still loads."""
    schema = ", ".join(f"{f.name} string" for f in LABELS_SCHEMA.fields)
    return _csv(spark, path, schema)


def read_complements(spark: SparkSession, path: str) -> DataFrame:
    """Complements (code column; code; label; justification), by position, with each row's place
    ``pos``; codes are normalised on use, and of repeated ones the last row wins."""
    schema = "code_column string, code string, libelle string, justification string"
    return _csv(spark, path, schema).select("*", _position())


def _position():
    """Row position in file order: (file, byte offset of the split, row id inside the split)."""
    return F.struct(
        F.col("_metadata.file_name"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ).alias("pos")


def read_code_list(spark: SparkSession, path: str, key: str, label: str) -> DataFrame:
    """(code, libelle) of a code-list CSV: key and label columns picked, FIRST row wins."""
    ordered = _csv(spark, path).select(key, label, _position())
    return first_label_per_code(ordered, key, label, "pos")


def read_lexicon_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(code, libelle) of a lexicon sheet exported as CSV (col 1 code, col 2 label, header
    row skipped): the LAST row wins, as in a dictionary built row by row."""
    raw = _csv(spark, path)
    code, label = raw.columns[0], raw.columns[1]
    ordered = raw.select(code, label, _position())
    return last_label_per_code(ordered, code, label, "pos")


# --- Fixed values: label sources of the fixture contract, by priority ----------------------
# region_code  <- nation code list (n_nationkey -> n_name)
# service_code <- part catalog (p_type -> p_name, first part wins; PROMO and STANDARD absent)
#                 then part lexicon (p_type -> upper(p_name), last part wins; STANDARD absent)
# status_code  <- nothing: deliberately unlabelled
# Complements: one grouping code per region, ``R<r_regionkey>`` -> r_name, for region_code.
FIXTURE_CODE_COLUMNS = ["status_code", "service_code", "region_code"]
NATION_SOURCE = "nation code list"
CATALOG_SOURCE = "part catalog"
LEXICON_SOURCE = "part lexicon"
CATALOG_EXCLUDED = ("PROMO", "STANDARD")
LEXICON_EXCLUDED = ("STANDARD",)
# --- end of fixed values -------------------------------------------------------------------


def fixture_nation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = nation.select(
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("label"),
        F.col("n_nationkey").alias("pos"),
    )
    return first_label_per_code(rows, "code", "label", "pos")


def fixture_catalog_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where(~F.col("p_type").isin(*CATALOG_EXCLUDED))
    return first_label_per_code(part, "p_type", "p_name", "p_partkey")


def fixture_lexicon_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where(~F.col("p_type").isin(*LEXICON_EXCLUDED))
    rows = part.select("p_type", F.upper("p_name").alias("label"), "p_partkey")
    return last_label_per_code(rows, "p_type", "label", "p_partkey")


def fixture_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All label sources of the fixture: (code_column, code, libelle, source, priority)."""
    return (
        as_source(fixture_nation_labels(spark, sf_dir), "region_code", NATION_SOURCE, 1)
        .unionByName(
            as_source(fixture_catalog_labels(spark, sf_dir), "service_code", CATALOG_SOURCE, 1)
        )
        .unionByName(
            as_source(fixture_lexicon_labels(spark, sf_dir), "service_code", LEXICON_SOURCE, 2)
        )
    )


def fixture_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(
        F.lit("region_code").alias("code_column"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"),
        F.col("r_name").alias("libelle"),
        F.lit("regional grouping of nations").alias("justification"),
        F.col("r_regionkey").alias("pos"),
    )
