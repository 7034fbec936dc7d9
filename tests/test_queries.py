"""Every registered query against its DuckDB statement on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlake.plans.catalog import QUERIES
from tests.conftest import SMOKE_DIR
from tests.oracle_compare import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "part_depense_nationale" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    from ledgerlake.session import shared_dir

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
