"""Profiles of bronze, kept month by month and merged when they are asked for.

A profile is marked with the version of the month that it describes: one whose month was loaded again
since is not used, and that month is profiled anew from bronze. No other month of bronze is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.contract import Contract
from ledgerlake.operators import sketches
from ledgerlake.sinks.partitions import overwrite_months
from ledgerlake.sources.monthly_files import checked_months
from ledgerlake.sources.tables import TableRef, read_months


def keep_profiles(
    spark: SparkSession, bronze: TableRef, profiles: TableRef, months: list[str], contract: Contract
) -> dict[str, int]:
    """Store the profile of each of these months; returns its rows (one for each raw column)."""
    months = checked_months(months)
    shown = bronze.months(spark) or {}
    made = sketches.monthly_profile(read_months(spark, bronze, months), contract)
    made_from = {m: shown[m]["version"] for m in months if m in shown}
    return overwrite_months(made, profiles, months, made_from=made_from).by_month


def whole_profile(
    spark: SparkSession,
    bronze: TableRef,
    profiles: TableRef,
    contract: Contract,
    months: list[str] | None = None,
) -> DataFrame:
    """The merged profile of all months that bronze shows, or of some of them."""
    shown, kept = bronze.months(spark), profiles.months(spark) or {}
    if shown is None:  # a table without a pointer tells nothing of its versions
        return sketches.merged_profile(sketches.monthly_profile(bronze.read(spark, months), contract))
    wanted = [m for m in shown if months is None or m in months]
    fresh = [m for m in wanted if kept.get(m, {}).get("made_from") == shown[m]["version"]]
    stale = [m for m in wanted if m not in fresh]
    parts = sketches.monthly_profile(bronze.read(spark, stale), contract)
    if fresh:
        stored = profiles.read(spark, fresh)
        parts = stored.unionByName(parts) if stale else stored
    return sketches.merged_profile(parts)
