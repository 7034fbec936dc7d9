"""Order of a table's rows by several columns at once.

Rows are placed by month and by a cell number that interleaves the bits of each column's rank, so
rows that are close in every column lie in the same file and row group. A filter on any of the
columns, or on several, then skips files by their folder statistics and row groups and pages by their
minima and maxima; sorting by one column after the other helps the first one only.

Ranks come from quantiles, one aggregate of bounded sketches over the placed columns alone: at most
``2 ** BITS - 1`` numbers a column reach the driver, however many rows there are. A frequent value
takes several quantiles, and what it leaves is dealt to the others; all of its rows may share a
cell, so the running number of a row is the last part of the order and a hot cell is cut like
any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType

from ledgerlake.contract import PARTITION_COLUMN

BITS = 4  # a column has 2 ** BITS ranks
FILE_ROWS = 4_000_000  # rows that one file is meant for
ACCURACY = 10_000  # of the quantiles: a rank is off by one row in so many
TEXT_BYTES = 7  # leading bytes of a text that its place depends on

SplitPoints = dict[str, list[int]]


def place(column: Column, dtype: DataType) -> Column:
    """A bigint in the order of the column's values: days, hundredths, or the leading bytes of a text."""
    if isinstance(dtype, StringType):
        leading = F.rpad(F.substring(F.hex(column), 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0")
        return F.conv(leading, 16, 10).cast("bigint")
    if isinstance(dtype, DateType):
        return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.floor(column.cast("decimal(28,2)") * 100).cast("bigint")


def split_points(df: DataFrame, columns: list[str], bits: int = BITS) -> SplitPoints:
    """The quantiles that cut each column into ranks of about equally many rows."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    placed = [place(F.col(c), df.schema[c].dataType).alias(c) for c in columns]
    cut = df.select(*placed).agg(
        *(F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns)
    ).first()
    return {c: sorted(set(cut[c] or [])) for c in columns}


def rank(df: DataFrame, column: str, points: list[int]) -> Column:
    """How many of the points a value reaches; NULL comes first."""
    at = place(F.col(column), df.schema[column].dataType)
    reached = F.lit(0)
    for point in points:
        reached = reached + F.coalesce((at >= F.lit(point)).cast("int"), F.lit(0))
    return reached


def cell(ranks: list[Column], bits: int = BITS) -> Column:
    """The bits of the ranks dealt in turn, highest first, into one number."""
    number = F.lit(0)
    for bit in range(bits):
        for k, one in enumerate(ranks):
            value = F.shiftright(one, bit).bitwiseAND(F.lit(1))
            number = number + F.shiftleft(value, bit * len(ranks) + len(ranks) - 1 - k)
    return number


def clustered(
    df: DataFrame, columns: list[str], points: SplitPoints, files: int, bits: int = BITS
) -> DataFrame:
    """The same rows, in about ``files`` tasks, by month and cell."""
    ranks = [F.col(f"_rank_{k}") for k in range(len(columns))]
    placed = df.withColumns({f"_rank_{k}": rank(df, c, points[c]) for k, c in enumerate(columns)})
    placed = placed.withColumn("_cell", cell(ranks, bits)).withColumn("_n", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(max(1, files), PARTITION_COLUMN, "_cell", "_n")
    return dealt.sortWithinPartitions(PARTITION_COLUMN, "_cell").select(*(f"`{c}`" for c in df.columns))


def bloom_options(columns: list[str]) -> dict[str, str]:
    """Writer options: a Bloom filter for each column. The writer makes one where a column has too
    many values for a dictionary; with a dictionary, row groups are skipped by that."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
