"""Label dimension job: sources + complements -> checked dimension table (full replace)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.labels import build_dimension, dimension_problems
from ledgerlake.sinks.partitions import overwrite_table
from ledgerlake.sources.tables import TableRef


def write_labels(
    sources: DataFrame, complements: DataFrame, code_columns: list[str], labels: TableRef
) -> tuple[int, list[str]]:
    """Replace the whole label table; returns the rows written (observed during the write) and the
    code columns that got no label. Faulty inputs raise before anything is written."""
    rows = overwrite_table(build_dimension(sources, complements, code_columns), labels)
    written = labels.read(sources.sparkSession)
    absent = dimension_problems(written, code_columns).where("problem = 'absent'").collect()
    return rows, sorted(r["code_column"] for r in absent)
