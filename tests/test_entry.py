"""The entry module without the optional operators, and without what they import."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

COUNT = """
import sys
for name in {hidden!r}:
    sys.modules[name] = None  # importing it fails
import __spark_entry__ as entry
from ledgerlake.plans.catalog import QUERIES
names = set(entry.queries())
assert set(QUERIES) <= names and set(entry.oracle_sql()) <= names
assert all(sql for name, sql in entry.oracle_sql().items())
print(len(names - set(QUERIES)), entry.NOT_LOADED)
"""


def optional_queries(*hidden):
    made = subprocess.run([sys.executable, "-c", COUNT.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert made.returncode == 0, made.stderr
    return int(made.stdout.split()[0]), made.stdout.split(" ", 1)[1]


def test_core_queries_survive_a_missing_library():
    count, why = optional_queries("public_tokenizers")
    assert count == 0 and "public_tokenizers" in why


def test_core_queries_survive_missing_operators():
    assert optional_queries("ledgerlake.llm", "corpus_pipeline")[0] == 0
