"""Helpers shared by the operators: written tables, per-worker caches, ragged arrays, words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import work_path


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table under the cluster's shared folder and read it back.

    It cuts the lineage, survives a lost executor, and gives the optimizer the true size in
    bytes, so a join with it is broadcast only when it is measured to be small. ``by``: a column
    whose values get a folder each, for ``discard``.
    """
    path = work_path(df.sparkSession, name)
    df.write.partitionBy(*[by] if by else []).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path).select(*map(column, df.columns))
    table.work_path = path
    return table


def discard(table: DataFrame, part: str = "") -> None:
    """Delete a table that ``materialize`` made (or one folder of it), once nothing reads it."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table.work_path}/{part}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_prefix(columns: Iterable[str], start: str = "_") -> str:
    """A prefix that no column name begins with."""
    while any(c.lower().startswith(start) for c in columns):
        start += "_"
    return start


BATCH_BYTES = "4m"  # of the Arrow batches that go to Python and of the copies made of them


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` on batches of bounded bytes: rows may hold very long texts. The session's own
    setting stands where there is one."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(run, schema)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process (tasks share it)."""
    import sys
    import types

    holder = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker"))
    return holder.__dict__.setdefault(name, {})


def pieces(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of ``column`` in each piece is about ``max_bytes`` at most
    (a single longer text makes a piece of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        end = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give memory that a finished task no longer needs back to the system: its worker process goes
    on with the next task, beside a JVM that may need it."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def ragged(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[i] : starts[i] + lens[i]]`` for all i."""
    total = int(lens.sum())
    if not total:
        return values[:0]
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((starts - (np.cumsum(lens) - lens)).astype(kind), lens)
    at += np.arange(total, dtype=kind)
    return values[at]


def split_lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Non-empty strings of a list array, flattened, and how many each row has."""
    flat = lists.flatten()
    parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    full = pc.greater(pc.binary_length(flat), 0)
    counts = np.bincount(parents[full.to_numpy(zero_copy_only=False)], minlength=len(lists))
    return flat.filter(full), counts


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: none), A-Z lower-cased; flattened,
    with the number of words of each text."""
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    return split_lists(pc.ascii_split_whitespace(lowered))
