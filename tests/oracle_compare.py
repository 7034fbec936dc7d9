"""Run registered queries in Spark and their SQL in DuckDB, compare like the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/duckdb, schema and value match.
"""

from __future__ import annotations

import hashlib
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return str(v.normalize()) if v == v else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def same_type(spark_type: str, duck_type: str) -> bool:
    duck = duck_type.upper().replace(" ", "")
    names = {
        "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
        "double": "DOUBLE", "boolean": "BOOLEAN",
    }
    if spark_type.startswith("decimal"):
        return duck == spark_type.upper()
    return names.get(spark_type) == duck


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} spark={len(rows)} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        duck_types = {d[0]: str(d[1]) for d in cur.description}
        type_diffs = [
            (f.name, f.dataType.simpleString(), duck_types.get(f.name))
            for f in df.schema
            if not same_type(f.dataType.simpleString(), duck_types.get(f.name, ""))
        ]
        if type_diffs:
            print(f"{name:32s} TYPES {type_diffs}")
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and h1 == h2
        bad += not ok
        print(
            f"{name:32s} rows {len(rows)}/{len(drows)} cols={'ok' if sorted(cols) == sorted(dcols) else (cols, dcols)} "
            f"values={'ok' if h1 == h2 else 'DIFF'} {ts:.1f}s"
        )
        if not ok and h1 != h2:
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("   duck  only:", x[:300])
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
