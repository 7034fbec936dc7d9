"""Rounded ratio of two amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# --- Fixed values: ratio precision --------------------------------------------------------
RATIO_TYPE = DecimalType(9, 4)
RATIO_DECIMALS = 4
# --- end of fixed values -------------------------------------------------------------------


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half-up to 4 decimals, as decimal(9,4).

    NULL when the denominator is zero or NULL. It may leave [0, 1] (corrections are negative);
    a value beyond decimal(9,4) fails the job under ANSI mode, which flags a nonsensical ratio.
    """
    return F.round(numerator / F.nullif(denominator, F.lit(0)), RATIO_DECIMALS).cast(RATIO_TYPE)
