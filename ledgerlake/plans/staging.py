"""Gold's inputs under SQL names: the database of a catalog lakehouse and its staging view."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlake.operators import gold
from ledgerlake.plans.layout import CatalogLakehouse


def create_database(spark: SparkSession, house: CatalogLakehouse) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{house.database}`")


def create_staging(spark: SparkSession, house: CatalogLakehouse) -> None:
    """A stored view over silver with the columns that the marts use. It holds no rows: what silver
    shows is what it shows, and a filter or a column list on it reaches silver's scan."""
    columns = gold.staging_spend(house.silver.read(spark), house.contract).columns
    listed = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {house.staging.name} AS SELECT {listed} FROM {house.silver.name}")
