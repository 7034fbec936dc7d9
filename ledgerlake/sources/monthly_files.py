"""Monthly extracts: ``;``-separated text with a header, every line ending in ``;``.

Files are named by a template and found by their exact path. Each file's own header line decides
which column is which: files are scanned together per distinct header, and a header that lacks a
wanted column is refused. Everything stays text (leading zeros of codes survive); an empty field is
NULL.

A compressed file cannot be split, so one task decompresses it. Where that would leave tasks idle (files
fewer or far larger than the tasks), it only cuts lines: they are dealt out over ``spread`` tasks, which
parse the fields, and encode and write the table. Many files of like size are parsed where they are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contract import PARTITION_COLUMN, TECHNICAL_COLUMNS
from ledgerlake.sinks.partitions import OPEN_WRITERS, month_writes

# --- Fixed values: monthly file name and format ---------------------------------------------
DEFAULT_TEMPLATE = "A{year}{month:02d}.csv.gz"
SEPARATOR = ";"
ENCODING = "UTF-8"
# --- end of fixed values -------------------------------------------------------------------
FIXTURE_LAYOUT = "_file={name}"
_SCHEME = re.compile("^[a-zA-Z][a-zA-Z0-9+.-]*:/*")
_MONTH = re.compile(r"([0-9]{4})(0[1-9]|1[0-2])")


class MonthFile(NamedTuple):
    """A requested month, its file name, and where the file (or its folder of parts) lies."""

    month: str
    name: str
    path: str


def checked_months(months: Iterable[str]) -> list[str]:
    """The months in order, each once; anything but ``YYYYMM`` is an error that names them all."""
    wrong = sorted({str(m) for m in months if not _MONTH.fullmatch(str(m))})
    if wrong:
        raise ValueError(f"not a month (YYYYMM, month 01 to 12): {', '.join(wrong)}")
    return sorted(set(months))


def month_files(
    raw_dir: str, months: Iterable[str], template: str = DEFAULT_TEMPLATE, layout: str = "{name}"
) -> list[MonthFile]:
    """``layout`` places a file name in the folder: ``"{name}"`` for plain files, ``"_file={name}"``
    for the folders of a partitioned producer such as ``write_month_files``."""
    files = []
    for month in checked_months(months):
        name = template.format(year=int(month[:4]), month=int(month[4:]))
        files.append(MonthFile(month, name, f"{raw_dir.rstrip('/')}/{layout.format(name=name)}"))
    return files


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location, whatever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def missing_files(spark: SparkSession, files: list[MonthFile]) -> list[MonthFile]:
    """Requested files that do not exist, judged by exactly their paths (an empty file exists)."""
    absent = []
    for file in files:
        store, place = _hadoop(spark, file.path)
        if not store.exists(place):
            absent.append(file)
    return absent


def require_files(spark: SparkSession, files: list[MonthFile]) -> None:
    """All missing files in one error, before anything is read or written."""
    absent = missing_files(spark, files)
    if absent:
        raise FileNotFoundError(f"no file for {len(absent)} month(s): {', '.join(f.path for f in absent)}")


class _Part(NamedTuple):
    path: str
    place: str  # as ``_place`` writes it
    file: MonthFile
    columns: tuple[str, ...]
    packed: bool  # compressed in a way that cannot be split
    header: str
    size: int  # bytes as stored


def _parts(spark: SparkSession, files: list[MonthFile]) -> list[_Part]:
    """Physical files with their header line; the driver reads one line of each."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    splittable = jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    found = []
    for file in files:
        store, place = _hadoop(spark, file.path)
        for status in store.listStatus(place):
            at = status.getPath()
            if status.isDirectory() or at.getName().startswith(("_", ".")):
                continue
            codec = codecs.getCodec(at)
            stream = store.open(at)
            try:
                unpacked = codec.createInputStream(stream) if codec else stream
                reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(unpacked, ENCODING))
                header = (reader.readLine() or "").lstrip("﻿")
            finally:
                stream.close()
            columns = tuple(c.strip().strip('"') for c in header.split(SEPARATOR))
            packed = codec is not None and not splittable.isInstance(codec)
            place = _SCHEME.sub("", at.toUri().toString())
            found.append(_Part(at.toString(), place, file, columns, packed, header, status.getLen()))
    return found


def read_months(
    spark: SparkSession,
    raw_dir: str,
    months: Iterable[str],
    ingested_at: datetime,
    template: str = DEFAULT_TEMPLATE,
    layout: str = "{name}",
    columns: list[str] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Bronze rows of the months: ``columns`` (by default all named ones of the headers, absent
    ones NULL), then the technical columns.

    ``spread``: tasks that parse the lines of compressed files; 0 leaves the lines with the task that
    decompressed them. By default they are dealt over as many tasks as the cluster runs at once where a
    single file holds more than one task's share of the bytes, and left otherwise. Lines equal to the
    file's header are no rows; a file without any line gives none.
    """
    files = month_files(raw_dir, months, template, layout)
    require_files(spark, files)
    parts = [p for p in _parts(spark, files) if p.header]
    for part in parts:
        lacking = [c for c in columns or [] if c not in part.columns]
        if lacking:
            raise ValueError(f"{part.file.name} lacks the column(s) {', '.join(lacking)}")
    wanted = columns or list(dict.fromkeys(c for p in parts for c in p.columns if c))
    if spread is None:
        spread = spark.sparkContext.defaultParallelism if _lopsided(parts, spark.sparkContext.defaultParallelism) else 0
    empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in wanted) or "x string")
    rows = None
    for header in dict.fromkeys(p.header for p in parts):
        own = [p for p in parts if p.header == header]
        read = _scan(spark, own, wanted, spread)
        rows = read if rows is None else rows.unionByName(read)
    if rows is None:
        rows = empty.withColumns({"_source_file": F.lit(""), PARTITION_COLUMN: F.lit("")})
    return rows.withColumn("_ingested_at", F.lit(ingested_at)).select(*wanted, *TECHNICAL_COLUMNS)


def _lopsided(parts: list[_Part], tasks: int) -> bool:
    """Whether one compressed file holds more than the share of a task of all bytes."""
    packed = [p.size for p in parts if p.packed]
    return bool(packed) and max(packed) * tasks > sum(p.size for p in parts)


def _shares(parts: list[_Part], tasks: int) -> dict[str, tuple[float, float]]:
    """Where the lines of each month begin among the tasks, and over how many they go: by its bytes, but
    not so few that a task gets more months than it writes side by side."""
    stored = {month: sum(p.size for p in parts if p.file.month == month) for month in sorted({p.file.month for p in parts})}
    least = 2 * sum(stored.values()) / (tasks * (OPEN_WRITERS - 1))  # at most doubles what there is to deal
    weights = {month: max(size, least, 1) for month, size in stored.items()}
    unit, begin, found = tasks / sum(weights.values()), 0.0, {}
    for month, weight in weights.items():
        found[month] = begin, weight * unit
        begin += weight * unit
    return found


def _dealt(marked: DataFrame, parts: list[_Part], spread: int) -> DataFrame:
    """Lines over ``spread`` tasks, by line number: the same line goes the same way when a task is run
    again, so that no rows need sorting for it (dealing them in turns would sort each file's lines first).

    Up to as many months as a task writes side by side go to every task. With more, each month goes to
    its own run of tasks, of which there are enough for that: a task that had lines of all months would sort them before it writes, and spill.
    """
    lines = marked.withColumn("_line", F.monotonically_increasing_id())
    months = {p.file.month for p in parts}
    if len(months) <= OPEN_WRITERS:
        return lines.repartition(spread, "_line").drop("_line")
    tasks = max(spread, -(-2 * len(months) // (OPEN_WRITERS - 1)))
    shares = _shares(parts, tasks)
    month = F.col(PARTITION_COLUMN)
    begin, width = (
        F.create_map(*(x for m, share in shares.items() for x in (F.lit(m), F.lit(share[k]))))[month] for k in (0, 1)
    )
    part = F.pmod(F.xxhash64("_line"), F.lit(1 << 20)) / F.lit(1 << 20)
    task = F.least(F.floor(begin + width * part), F.lit(tasks - 1)).cast("int")
    return lines.withColumn("_task", task).repartitionById(tasks, "_task").drop("_line", "_task")


def _scan(spark: SparkSession, parts: list[_Part], wanted: list[str], spread: int) -> DataFrame:
    """Files of one header in one scan. Month and name come from a table of the files read, one
    row each, matched on the exact location."""
    places = spark.createDataFrame(
        [(p.place, p.file.name, p.file.month) for p in parts],
        f"_place string, _source_file string, {PARTITION_COLUMN} string",
    )
    # escaped like a uri, but with another number of slashes after the scheme
    place = F.regexp_replace("_metadata.file_path", _SCHEME.pattern, "").alias("_place")
    lines = spark.read.text([p.path for p in parts]).select("value", place)
    marked = lines.join(F.broadcast(places), "_place").drop("_place")
    if spread and any(p.packed for p in parts):
        marked = _dealt(marked, parts, spread)
    named = [c or f"_unnamed{i}" for i, c in enumerate(parts[0].columns)]
    schema = ", ".join(f"`{c}` string" for c in named)
    fields = F.from_csv("value", F.lit(schema), {"sep": SEPARATOR, "mode": "PERMISSIVE"})
    kept = marked.where((F.col("value") != parts[0].header) & (F.trim("value") != ""))
    return kept.select(fields.alias("_row"), "_source_file", PARTITION_COLUMN).select(
        *(
            (F.col(f"_row.`{c}`") if c in named else F.lit(None).cast("string")).alias(c)
            for c in wanted
        ),
        "_source_file",
        PARTITION_COLUMN,
    )


def write_month_files(
    df: DataFrame, raw_dir: str, columns: list[str], mode: str = "overwrite", name: Column | None = None
) -> None:
    """Write bronze-like text rows as monthly extracts (test fixture producer).

    One folder per month (``_file=A202501.csv.gz/part-*.csv.gz``, read back with
    ``layout=FIXTURE_LAYOUT``) is produced by a partitioned write, in one job; each part file
    carries the header and every line ends with the separator, as the real files do. ``name``: the
    file name of a row, by default that of ``DEFAULT_TEMPLATE``.
    """
    if name is None:
        name = F.concat(F.lit("A"), F.col(PARTITION_COLUMN), F.lit(".csv.gz"))
    rows = df.select(*columns, F.lit(None).cast("string").alias(""), name.alias("_file"))
    writer = rows.write.mode(mode).partitionBy("_file").option("compression", "gzip")
    with month_writes(df.sparkSession):
        writer.option("header", True).option("sep", SEPARATOR).option("emptyValue", "").csv(raw_dir)


def name_single_parts(spark: SparkSession, folders: list[MonthFile], files: list[MonthFile]) -> None:
    """Give the one part of each folder the name of a plain monthly file."""
    for folder, file in zip(folders, files, strict=True):
        store, place = _hadoop(spark, folder.path)
        parts = [s.getPath() for s in store.listStatus(place) if not s.getPath().getName().startswith(("_", "."))]
        if len(parts) != 1:
            raise ValueError(f"{folder.path} has {len(parts)} parts")
        target = _hadoop(spark, file.path)[1]
        store.mkdirs(target.getParent())
        store.rename(parts[0], target)
