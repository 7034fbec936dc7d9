"""Monthly profiles: months merge to the whole, and every estimate keeps its bound."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.contract import FIXTURE, PARTITION_COLUMN
from ledgerlake.operators import sketches

ROWS = 60_000


@pytest.fixture(scope="module")
def bronze(spark):
    """Six months of very different sizes; ``quantity`` holds texts that do not convert, one of them hot."""
    n = F.col("id")
    month = F.concat(F.lit("20250"), (1 + F.floor(F.log2(1 + n % 63))).cast("int").cast("string"))
    odd = F.when(n % 40 == 0, F.lit("n/a")).when(n % 200 == 1, F.concat(F.lit("x"), n.cast("string")))
    values = {
        "spend": F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("string"),
        "quantity": F.coalesce(odd, (n % 1000).cast("string")),
        "service_code": F.when(n % 3 != 0, (n % 17).cast("string")),
    }
    columns = [values.get(c, F.lit(None).cast("string")).alias(c) for c in FIXTURE.raw_columns]
    return spark.range(ROWS, numPartitions=6).select(*columns, month.alias(PARTITION_COLUMN))


def test_months_merge_to_the_whole(spark, bronze, tmp_path):
    monthly = sketches.monthly_profile(bronze, FIXTURE)
    monthly.write.partitionBy(PARTITION_COLUMN).parquet(str(tmp_path / "profile"))  # a profile can be stored
    stored = spark.read.parquet(str(tmp_path / "profile"))
    assert stored.select(PARTITION_COLUMN).distinct().count() == 6
    whole = sketches.merged_profile(stored)
    once = sketches.merged_profile(sketches.monthly_profile(bronze.withColumn(PARTITION_COLUMN, F.lit("1")), FIXTURE))
    rows = {r["colonne"]: r for r in sketches.distinct_texts(whole).collect()}
    again = {r["colonne"]: r for r in sketches.distinct_texts(once).collect()}
    for name in FIXTURE.raw_columns:
        exact = bronze.agg(
            F.count(F.lit(1)), F.count_if(F.col(name).isNull()), F.count_distinct(name)
        ).first()
        assert (rows[name]["lignes"], rows[name]["vides"]) == tuple(exact[:2])
        assert abs(rows[name]["distincts"] - exact[2]) <= sketches.DISTINCT_ERROR * exact[2]
        assert rows[name][1:4] == again[name][1:4]
    assert rows["quantity"]["non_convertibles"] == ROWS // 40 + ROWS // 200
    assert rows["spend"]["non_convertibles"] == 0


def test_quantiles_keep_their_rank(bronze):
    profile = sketches.merged_profile(sketches.monthly_profile(bronze, FIXTURE))
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    found = {(r[0], r[1]): r[2] for r in sketches.quantiles(profile, shares).collect()}
    assert {c for c, _ in found} == {"spend", "quantity"}  # the others have no values
    for column in ("spend", "quantity"):
        values = bronze.select(F.expr(f"try_cast({column} AS double)").alias("v")).where("v IS NOT NULL")
        n = values.count()
        for share in shares:
            below = values.where(F.col("v") < found[column, share]).count() / n
            upto = values.where(F.col("v") <= found[column, share]).count() / n
            assert below - sketches.RANK_ERROR <= share <= upto + sketches.RANK_ERROR


def test_frequent_texts(bronze):
    profile = sketches.merged_profile(sketches.monthly_profile(bronze, FIXTURE))
    top = [tuple(r) for r in sketches.frequent_texts(profile, 3).collect()]
    assert {c for c, _, _ in top} == {"quantity"}
    hot = max(top, key=lambda r: r[2])
    assert hot[:2] == ("quantity", "n/a") and hot[2] == ROWS // 40


def test_frequent_texts_among_very_many(spark, bronze):
    """Far more different texts than the sketch keeps: the hot one is found within the bound."""
    n = F.col("id")
    text = F.when(n % 20 == 0, "hot").otherwise(F.concat(F.lit("?"), n.cast("string")))
    columns = [(text if c == "spend" else F.lit(None).cast("string")).alias(c) for c in FIXTURE.raw_columns]
    df = spark.range(ROWS, numPartitions=6).select(*columns, (n % 5).cast("string").alias(PARTITION_COLUMN))
    profile = sketches.merged_profile(sketches.monthly_profile(df, FIXTURE))
    top = max(sketches.frequent_texts(profile, 5).collect(), key=lambda r: r["lignes"])
    assert top["texte"] == "hot" and abs(top["lignes"] - ROWS // 20) <= sketches.TEXT_ERROR * ROWS


def test_an_empty_month_has_no_profile(spark, bronze):
    none = sketches.monthly_profile(bronze.limit(0), FIXTURE)
    assert none.count() == 0 and sketches.merged_profile(none).count() == 0
    assert sketches.quantiles(sketches.merged_profile(none), [0.5]).count() == 0


def test_kept_profiles_spare_the_months_that_did_not_change(spark, bronze, tmp_path):
    from ledgerlake.plans.profiles import keep_profiles, whole_profile
    from ledgerlake.sinks.partitions import overwrite_month, overwrite_months
    from ledgerlake.sources.tables import TableRef

    rows = bronze.limit(3000)
    months = sorted(r[0] for r in rows.select(PARTITION_COLUMN).distinct().collect())
    table, kept = TableRef(path=str(tmp_path / "b"), schema=rows.schema), TableRef(path=str(tmp_path / "p"))
    overwrite_months(rows, table, months)
    columns = len(FIXTURE.raw_columns)
    assert keep_profiles(spark, table, kept, months, FIXTURE) == {m: columns for m in months}

    def total(some=None):
        profile = whole_profile(spark, table, kept, FIXTURE, some)
        read = [f for f in profile.inputFiles() if f"{tmp_path}/b/" in f]
        return {r["lignes"] for r in profile.collect()}, {f.split(f"{PARTITION_COLUMN}=")[1][:6] for f in read}

    assert total() == ({3000}, set())
    first = rows.where(F.col(PARTITION_COLUMN) == months[0])
    overwrite_month(first.unionByName(first), table, months[0])  # its profile is out of date now
    assert total() == ({3000 + first.count()}, {months[0]})
    assert total(months[1:]) == ({3000 - first.count()}, set())
