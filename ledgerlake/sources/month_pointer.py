"""Which stored version of each month a table shows: one small pointer file per table.

A write puts its rows into a folder of its own (``_version=<id>/_year_month=<month>/``) that no reader
looks at, then shows them by renaming one new pointer file into ``_months/``. The file with the
highest number holds; it names the version of every month, with facts found while the month was
written. A job that dies before the rename leaves the old months, after it the new ones, never none.
Two writers of one table that finish together take the next number in turn; of two writers of one
month the later one's rows stay.
"""

from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ledgerlake.contract import PARTITION_COLUMN

FOLDER, VERSION = "_months", "_version"
ATTEMPTS = 50

_ONE_WRITER = threading.Lock()

Months = dict[str, dict]  # month -> {"version": ..., "rows": ..., fact: ...}


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, path: str) -> list[int]:
    store, folder = _store(spark, f"{path}/{FOLDER}")
    if not store.exists(folder):
        return []
    names = (status.getPath().getName() for status in store.listStatus(folder))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Months | None:
    """What a pointer shows; None for one that a writer has deleted since it was listed."""
    store, place = _store(spark, f"{path}/{FOLDER}/{number:012d}.json")
    jvm = spark._jvm
    try:
        stream = store.open(place)
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):
            return None
        raise
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return json.loads(reader.readLine())
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> Months | None:
    """What the table shows; None for a table that has no pointer."""
    for _ in range(ATTEMPTS):
        numbers = _numbers(spark, path)
        if not numbers:
            return None
        months = _load(spark, path, numbers[-1])
        if months is not None:
            return months
    raise RuntimeError(f"{path}: the pointer changed {ATTEMPTS} times while it was read")


def new_version() -> str:
    return f"w{uuid.uuid4().hex}"


def version_folder(path: str, version: str) -> str:
    return f"{path}/{VERSION}={version}"


def month_folder(path: str, month: str, entry: dict) -> str:
    return f"{version_folder(path, entry['version'])}/{PARTITION_COLUMN}={month}"


def _publish(spark: SparkSession, path: str, number: int, months: Months) -> bool:
    """Rename the pointer into place; False where another writer took the number first."""
    store, target = _store(spark, f"{path}/{FOLDER}/{number:012d}.json")
    draft = _store(spark, f"{path}/{FOLDER}/_{uuid.uuid4().hex}")[1]
    out = store.create(draft, False)
    out.write(bytearray(json.dumps(months, sort_keys=True).encode()))
    out.close()
    if not store.exists(target) and store.rename(draft, target):
        return True
    store.delete(draft, False)
    return False


def swap(spark: SparkSession, path: str, changed: dict[str, dict | None], whole: bool = False) -> None:
    """Show the ``changed`` months (None: the month is gone); ``whole``: and no others. What the
    pointer before the last one showed is then deleted: readers that are under way keep theirs."""
    for _ in range(ATTEMPTS):
        with _ONE_WRITER:  # of this driver; those of others are told apart by the rename
            numbers = _numbers(spark, path)
            before = _load(spark, path, numbers[-1]) if numbers else {}
            if before is None:
                continue
            after = ({} if whole else before) | changed
            after = {month: entry for month, entry in after.items() if entry}
            if _publish(spark, path, numbers[-1] + 1 if numbers else 0, after):
                _clean(spark, path, numbers, before, after)
                return
    raise RuntimeError(f"{path}: the pointer was taken by other writers {ATTEMPTS} times")


def _clean(spark: SparkSession, path: str, numbers: list[int], before: Months, after: Months) -> None:
    """Delete months that only older pointers than the last two show, then those pointers."""
    kept = {(m, e["version"]) for months in (before, after) for m, e in months.items()}
    versions = {version for _, version in kept}
    for number in numbers[:-1]:
        for month, entry in (_load(spark, path, number) or {}).items():
            if (month, entry["version"]) in kept:
                continue
            gone = entry["version"] not in versions
            folder = version_folder(path, entry["version"]) if gone else month_folder(path, month, entry)
            store, place = _store(spark, folder)
            store.delete(place, True)
        store, place = _store(spark, f"{path}/{FOLDER}/{number:012d}.json")
        store.delete(place, False)
