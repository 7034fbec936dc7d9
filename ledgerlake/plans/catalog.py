"""Registered queries over the test tables: one per operator group of the inventory.

Every query derives its input from the given tables (the fixture extract is lineitem joined to
its order's customer and its part), so its work grows with them. Queries that exercise a sink
write into a fresh folder under the cluster's shared folder (``spark.checkpoint.dir``) and return
what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlake.contract import FIXTURE, PARTITION_COLUMN
from ledgerlake.functions.codes import normalize_code
from ledgerlake.functions.dates import month_start
from ledgerlake.functions.ratio import ratio
from ledgerlake.operators import gold, labels, quality, reconcile, sketches
from ledgerlake.operators.quality import WARN, NotNull
from ledgerlake.operators.silver import (
    REASONS_COLUMN,
    raw_amount,
    raw_month_text,
    rejected_rows,
    silver_projection,
    silver_value,
    valid_rows,
    with_reasons,
)
from ledgerlake.plans import bronze as bronze_plan
from ledgerlake.plans import gold as gold_plan
from ledgerlake.plans import profiles as profile_plan
from ledgerlake.plans import silver as silver_plan
from ledgerlake.plans.labels import write_labels
from ledgerlake.plans.layout import LABELS_SCHEMA, CatalogLakehouse, Lakehouse
from ledgerlake.plans.staging import create_database, create_staging
from ledgerlake.session import configure, work_name, work_path
from ledgerlake.sinks.partitions import month_writes, overwrite_month, overwrite_months, overwrite_table
from ledgerlake.sources import fixture, month_pointer, monthly_files
from ledgerlake.sources import labels as label_sources
from ledgerlake.sources.claims_labels import CLAIMS_CODE_COLUMNS, LABEL_MAP, claims_sources
from ledgerlake.sources.tables import TableRef, read_month

Query = Callable[[SparkSession, str], DataFrame]
C = FIXTURE
BUSINESS = [spec.name for spec in C.columns]


# ---------------------------------------------------------------------------------------------
# shared inputs


_FIXTURE_HOUSES: dict[tuple[str, str], Lakehouse] = {}
_RAW_HOUSES: dict[tuple[str, str], Lakehouse] = {}
_GOLD_HOUSES: dict[tuple[str, str], tuple[Lakehouse, list[gold_plan.CheckResult]]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir)


def _fixture_bronze_ref(house: Lakehouse) -> TableRef:
    return TableRef(path=house.bronze.path, schema=C.bronze_schema().add("k", LongType()))


def fixture_lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Bronze written straight from the fixture extract (partitioned by month, selector ``k``
    kept), then silver and quarantine built from it by the silver job (with reconciliation).

    Done once per session and scale under the shared folder; queries then read these tables,
    as the gold layer and the checks do in production. A written table also cuts the lineage. (The
    test tables are read-only: a folder whose content changed meanwhile would go unnoticed.)
    """
    key = _key(spark, sf_dir)
    if key not in _FIXTURE_HOUSES:
        configure(spark)
        house = Lakehouse(work_path(spark, "fixture"), C)
        bronze = _fixture_bronze_ref(house)
        rows = fixture.claims_bronze(spark, sf_dir, with_key=True, together=True)
        with month_writes(spark):
            rows.write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(bronze.path)
        months = _months(bronze.read(spark))
        silver_plan.build_silver(
            spark, bronze, house.silver, house.quarantine, months, C, codes=house.codes
        )
        _FIXTURE_HOUSES[key] = house
    return _FIXTURE_HOUSES[key]


def gold_lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The fixture tables with the label table and both stored marts, by the label and gold jobs."""
    return _gold(spark, sf_dir)[0]


def _gold(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, list[gold_plan.CheckResult]]:
    key = _key(spark, sf_dir)
    if key not in _GOLD_HOUSES:
        house = fixture_lakehouse(spark, sf_dir)
        write_labels(
            label_sources.fixture_sources(spark, sf_dir),
            label_sources.fixture_complements(spark, sf_dir),
            label_sources.FIXTURE_CODE_COLUMNS,
            house.labels,
        )
        _GOLD_HOUSES[key] = house, _build_gold(spark, house, house)
    return _GOLD_HOUSES[key]


def _build_gold(
    spark: SparkSession, source: Lakehouse, target: Lakehouse, months: list[str] | None = None
) -> list[gold_plan.CheckResult]:
    return gold_plan.build_gold(
        spark, source.silver, source.labels, target.gold(gold_plan.SERVICE_MART),
        target.gold(gold_plan.REGION_MART), C, fail_on_error=False, months=months, codes=source.codes,
    )


def _stored_mart(spark: SparkSession, house: Lakehouse, name: str) -> DataFrame:
    return house.gold(name).read(spark)


def _bronze(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    df = _fixture_bronze_ref(fixture_lakehouse(spark, sf_dir)).read(spark)
    return df if with_key else df.drop("k")


def _checked(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    return with_reasons(_bronze(spark, sf_dir, with_key), C)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_lakehouse(spark, sf_dir).silver.read(spark)


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_lakehouse(spark, sf_dir).quarantine.read(spark)


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture label dimension, as the label job stores it."""
    return gold_lakehouse(spark, sf_dir).labels.read(spark)


def _months(df: DataFrame) -> list[str]:
    """Distinct months of a frame (bounded by the calendar, not by the data)."""
    return sorted(r[0] for r in df.select(PARTITION_COLUMN).distinct().collect())


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The load path from files, once per session and scale: the fixture extract written as
    monthly ``;`` CSV.gz files, then loaded into bronze by the bronze job (all months, one scan)."""
    key = _key(spark, sf_dir)
    if key not in _RAW_HOUSES:
        configure(spark)
        house = Lakehouse(work_path(spark, "lakehouse"), C)
        text = fixture.claims_text(spark, sf_dir, together=True)
        monthly_files.write_month_files(text, house.raw_dir, list(C.raw_columns))
        months = raw_months(spark, house.raw_dir)
        bronze_plan.ingest_months(
            spark, house.raw_dir, house.bronze, months, fixture.INGESTED_AT,
            layout=monthly_files.FIXTURE_LAYOUT,
        )
        _RAW_HOUSES[key] = house
    return _RAW_HOUSES[key]


def raw_months(spark: SparkSession, raw_dir: str) -> list[str]:
    """Months of the files that the fixture producer wrote (from its folder names)."""
    written = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw_dir)
    return sorted(r[0][1:7] for r in written.select("_file").distinct().collect())


# ---------------------------------------------------------------------------------------------
# bronze: scans, technical columns, partitioned sinks


def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture written as ``;`` CSV.gz (trailing ``;``), read back as text in one scan."""
    configure(spark)
    raw_dir = work_path(spark, "raw")
    text = fixture.claims_text(spark, sf_dir, together=True)
    monthly_files.write_month_files(text, raw_dir, list(C.raw_columns))
    back = monthly_files.read_months(
        spark, raw_dir, raw_months(spark, raw_dir), fixture.INGESTED_AT,
        layout=monthly_files.FIXTURE_LAYOUT,
    )
    return back.select(*C.raw_columns, "_source_file", PARTITION_COLUMN)


def bronze_monthly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All monthly files loaded in one job; rows per month of the bronze table."""
    house = lakehouse(spark, sf_dir)
    return quality.rows_per_month(house.bronze.read(spark))


def technical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = lakehouse(spark, sf_dir)
    return (
        house.bronze.read(spark)
        .groupBy("_source_file", PARTITION_COLUMN, F.col("_ingested_at").cast("string").alias("ingere_le"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))
    )


def _latest_month(spark: SparkSession, table: TableRef) -> str:
    return table.read(spark).agg(F.max(PARTITION_COLUMN)).first()[0]


def month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest month of the bronze table (the month literal prunes the partitions)."""
    house = lakehouse(spark, sf_dir)
    latest = _latest_month(spark, house.bronze)
    return read_month(spark, house.bronze, latest).select(*C.raw_columns, PARTITION_COLUMN)


def partition_overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month written twice: still one copy of each month."""
    configure(spark)
    table = TableRef(path=work_path(spark, "bronze_twice"), schema=C.bronze_schema())
    df = _bronze(spark, sf_dir)
    months = _months(df)
    overwrite_months(df, table, months)
    overwrite_months(df, table, months)
    return quality.rows_per_month(table.read(spark))


def partition_overwrite_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest month reloaded with twice its rows; every other month unchanged."""
    configure(spark)
    table = TableRef(path=work_path(spark, "bronze_reload"), schema=C.bronze_schema())
    df = _bronze(spark, sf_dir)
    months = _months(df)
    overwrite_months(df, table, months)
    latest = months[-1]
    month_rows = df.where(F.col(PARTITION_COLUMN) == latest)
    overwrite_month(month_rows.unionByName(month_rows), table, latest)
    return quality.rows_per_month(table.read(spark))


def quarantine_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of every month written, then the latest month rewritten empty: only it empties."""
    configure(spark)
    house = Lakehouse(work_path(spark, "quarantine"), C)
    rejected = rejected_rows(_checked(spark, sf_dir))
    months = _months(_bronze(spark, sf_dir))
    overwrite_months(rejected, house.quarantine, months)
    overwrite_month(rejected.limit(0), house.quarantine, months[-1])
    return quality.rows_per_month(house.quarantine.read(spark))


def write_row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows observed during the writes versus rows found on disk, per layer."""
    configure(spark)
    house = Lakehouse(work_path(spark, "metrics"), C)
    checked = _checked(spark, sf_dir)
    months = _months(_bronze(spark, sf_dir))
    s = overwrite_months(valid_rows(checked, C), house.silver, months)
    q = overwrite_months(rejected_rows(checked), house.quarantine, months)
    actual = (
        house.silver.read(spark).select(F.lit("silver").alias("layer"))
        .unionByName(house.quarantine.read(spark).select(F.lit("quarantine").alias("layer")))
        .groupBy("layer").agg(F.count(F.lit(1)).cast("bigint").alias("actual_rows"))
    )
    observed = spark.createDataFrame(
        [("silver", s.rows), ("quarantine", q.rows)], "layer string, observed_rows bigint"
    )
    return observed.join(actual, "layer", "full")


def _calendar(months: list[str]) -> list[str]:
    """Every month of the calendar years that ``months`` touch."""
    return [f"{y}{m:02d}" for y in sorted({m[:4] for m in months}) for m in range(1, 13)]


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the calendar years covered by the data that have no raw file, by the check that
    the load makes; a file still being written (``.part``) does not count."""
    house = lakehouse(spark, sf_dir)
    months = raw_months(spark, house.raw_dir)
    wanted = monthly_files.month_files(house.raw_dir, _calendar(months), layout=monthly_files.FIXTURE_LAYOUT)
    absent = monthly_files.missing_files(spark, wanted)
    for file in absent[:1]:
        spark.range(1).selectExpr("'unfinished' AS value").write.mode("overwrite").text(f"{file.path}.part")
    found = [(f.month,) for f in monthly_files.missing_files(spark, wanted)]
    return spark.createDataFrame(found, f"{PARTITION_COLUMN} string")


def _loaded(spark: SparkSession, raw_dir: str, months: list[str], **options) -> DataFrame:
    """Bronze table that the load job makes of ``raw_dir``."""
    table = TableRef(path=work_path(spark, "loaded"), schema=C.bronze_schema())
    options = {"layout": monthly_files.FIXTURE_LAYOUT} | options
    bronze_plan.ingest_months(spark, raw_dir, table, months, fixture.INGESTED_AT, **options)
    return table.read(spark)


def bronze_header_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd months written with their columns in reverse order: each file's own header counts."""
    configure(spark)
    raw_dir = work_path(spark, "headers")
    text = fixture.claims_text(spark, sf_dir, together=True)
    odd = F.col(PARTITION_COLUMN).cast("int") % 2 == 1
    monthly_files.write_month_files(text.where(~odd), raw_dir, list(C.raw_columns))
    monthly_files.write_month_files(text.where(odd), raw_dir, list(C.raw_columns[::-1]), mode="append")
    return _loaded(spark, raw_dir, raw_months(spark, raw_dir)).select(*C.raw_columns, PARTITION_COLUMN)


def bronze_repeated_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month requested twice in one load: one copy of each."""
    house = lakehouse(spark, sf_dir)
    months = raw_months(spark, house.raw_dir)
    return quality.rows_per_month(_loaded(spark, house.raw_dir, [*months, *months]))


def bronze_odd_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names with spaces and a per cent sign."""
    configure(spark)
    raw_dir = work_path(spark, "odd names")
    text = fixture.claims_text(spark, sf_dir, together=True)
    ym = F.col(PARTITION_COLUMN)
    named = F.concat(F.lit("A "), F.left(ym, F.lit(4)), F.lit(" 100% "), F.right(ym, F.lit(2)), F.lit(".csv.gz"))
    monthly_files.write_month_files(text, f"{raw_dir}/by name", list(C.raw_columns), name=named)
    months = _months(text)
    template = "A {year} 100% {month:02d}.csv.gz"
    # the producer escapes the per cent sign in its folder names
    loaded = _loaded(spark, f"{raw_dir}/by name", months, template=template.replace("%", "%25"))
    return loaded.groupBy("_source_file", PARTITION_COLUMN).agg(
        F.count(F.lit(1)).cast("bigint").alias("lignes")
    )


def bronze_gzip_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plain ``.gz`` file for each month, its lines parsed by several tasks."""
    configure(spark)
    raw_dir = work_path(spark, "gzip")
    text = fixture.claims_text(spark, sf_dir)
    monthly_files.write_month_files(
        text.repartition(PARTITION_COLUMN), f"{raw_dir}/parts", list(C.raw_columns)
    )
    months = raw_months(spark, f"{raw_dir}/parts")
    monthly_files.name_single_parts(
        spark,
        monthly_files.month_files(f"{raw_dir}/parts", months, layout=monthly_files.FIXTURE_LAYOUT),
        monthly_files.month_files(f"{raw_dir}/files", months),
    )
    loaded = _loaded(spark, f"{raw_dir}/files", months, layout="{name}", spread=8)
    return loaded.select(*C.raw_columns, "_source_file", PARTITION_COLUMN)


# ---------------------------------------------------------------------------------------------
# silver: typing, rules, split, reconciliation


def parse_year_month_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    care = C.spec(C.care_month)
    text = raw_month_text(care)
    return (
        _bronze(spark, sf_dir)
        .select(text.alias("texte"), month_start(text).alias("mois"))
        .groupBy("texte", "mois")
        .agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))
    )


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contract column typed, on every row, before the valid/rejected split."""
    bronze = _bronze(spark, sf_dir, with_key=True)
    return bronze.select("k", *[silver_value(spec).alias(spec.name) for spec in C.columns])


def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir, with_key=True)
    return checked.select("k", F.array_join(REASONS_COLUMN, ",").alias("motifs"))


def silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table as written by the silver job (typed valid rows)."""
    return _silver(spark, sf_dir).select(*BUSINESS, PARTITION_COLUMN)


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir).select(
        *C.raw_columns, PARTITION_COLUMN, F.array_join(REASONS_COLUMN, ",").alias("motifs")
    )


def rejection_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reason_counts(_quarantine(spark, sf_dir))


def _layer_totals(spark: SparkSession, house: Lakehouse) -> DataFrame:
    amount = raw_amount(C)
    return reconcile.layer_totals(
        reconcile.totals_frame(_fixture_bronze_ref(house).read(spark), amount),
        reconcile.totals_frame(house.silver.read(spark), F.col(C.amount)),
        reconcile.totals_frame(house.quarantine.read(spark), amount),
    )


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and converted amount per layer, read back from the written tables."""
    return _layer_totals(spark, fixture_lakehouse(spark, sf_dir))


def reconcile_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing checks: the built tables (none) and a broken input without its quarantine."""
    house = fixture_lakehouse(spark, sf_dir)
    layers = _layer_totals(spark, house)
    built = reconcile.reconciliation_gaps(layers).withColumn("variant", F.lit("as_built"))
    broken = reconcile.reconciliation_gaps(
        layers.where(F.col("layer") != "quarantine")
    ).withColumn("variant", F.lit("quarantine_missing"))
    return built.unionByName(broken).select("variant", "measure", "bronze", "silver_plus_quarantine")


def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.source_profile(_bronze(spark, sf_dir), C)


def source_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of every raw column, merged from profiles kept by month (the latest one kept twice):
    exact counts, the most frequent text that does not convert, and whether the estimate of the distinct
    texts is as near to their exact number as promised."""
    house = lakehouse(spark, sf_dir)
    profiles = TableRef(path=work_path(spark, "profiles"))
    months = sorted(house.bronze.months(spark))
    profile_plan.keep_profiles(spark, house.bronze, profiles, months, C)
    profile_plan.keep_profiles(spark, house.bronze, profiles, months[-1:], C)
    whole = profile_plan.whole_profile(spark, house.bronze, profiles, C)
    frequent = sketches.frequent_texts(whole, 1).withColumnsRenamed({"texte": "texte_frequent", "lignes": "lignes_texte"})
    texts = house.bronze.read(spark).select(*C.raw_columns).unpivot([], list(C.raw_columns), "colonne", "texte")
    exact = texts.distinct().groupBy("colonne").agg(F.count("texte").alias("exacts"))
    near = F.abs(F.col("distincts") - F.col("exacts")) <= sketches.DISTINCT_ERROR * F.col("exacts")
    return (
        sketches.distinct_texts(whole).join(frequent, "colonne", "left").join(exact, "colonne")
        .select("colonne", *sketches.COUNTS, "texte_frequent", "lignes_texte", near.alias("distincts_proches"))
    )


def table_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of the whole extract versus silver: the difference is the typed rejects."""
    every_row = silver_projection(_bronze(spark, sf_dir), C).select(*BUSINESS)
    return quality.table_parity(every_row, _silver(spark, sf_dir).select(*BUSINESS))


def table_parity_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver versus valid typed rows of the extract with one month's amounts negated: that month alone
    is compared row by row."""
    again = valid_rows(_checked(spark, sf_dir), C).select(*BUSINESS)
    that = F.col(C.processing_month) == F.lit("1995-03-01").cast("date")
    changed = again.withColumn(C.amount, F.when(that, -F.col(C.amount)).otherwise(F.col(C.amount)))
    return quality.table_parity_by(changed, _silver(spark, sf_dir).select(*BUSINESS), C.processing_month)


def unique_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated fixture selectors (rows have no key: duplicates are legitimate)."""
    return quality.unique_grain(_bronze(spark, sf_dir, with_key=True), ["k"])


def empty_month_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that asks for months absent from bronze: it names them and writes nothing."""
    house = fixture_lakehouse(spark, sf_dir)
    target = Lakehouse(work_path(spark, "guarded"), C)
    bronze = _fixture_bronze_ref(house)
    wanted = _calendar(_months(bronze.read(spark)))
    try:
        silver_plan.build_silver(spark, bronze, target.silver, target.quarantine, wanted, C)
        absent = []
    except ValueError as err:
        absent = [m for m in wanted if m in str(err)]
    written = not monthly_files.missing_files(
        spark, [monthly_files.MonthFile("", "", target.silver.path)]
    )
    return spark.createDataFrame([(m, written) for m in absent], "mois_absent string, ecrit boolean")


def refused_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month of the extract asked for in four forms at once: the load names each text that is not
    a month, and writes nothing."""
    house = lakehouse(spark, sf_dir)
    month = F.col(PARTITION_COLUMN)
    year, number = F.left(month, F.lit(4)), F.right(month, F.lit(2))
    forms = [month, F.concat(year, F.lit("-"), number), F.concat(year, F.lit("13")), F.concat(year, number.cast("int"))]
    asked = house.bronze.read(spark).select(month).distinct().select(F.explode(F.array(*forms)).alias("texte"))
    texts = sorted({r["texte"] for r in asked.collect()})  # bounded by the calendar
    target = TableRef(path=work_path(spark, "refused"), schema=C.bronze_schema())
    try:
        bronze_plan.ingest_months(spark, house.raw_dir, target, texts, layout=monthly_files.FIXTURE_LAYOUT)
        named = set()
    except ValueError as err:
        named = set(str(err).rpartition(": ")[2].split(", "))
    written = not monthly_files.missing_files(spark, [monthly_files.MonthFile("", "", target.path)])
    return spark.createDataFrame([(t, t in named, written) for t in texts], "texte string, refuse boolean, ecrit boolean")


# ---------------------------------------------------------------------------------------------
# labels


def _label_file(df: DataFrame, path: str) -> None:
    """One ``;`` file in the order of ``line``; code lists are small by nature."""
    ordered = df.coalesce(1).sortWithinPartitions("line").drop("line")
    ordered.write.option("header", True).option("sep", ";").csv(path)


def claims_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label dimension of the 39 code columns of the claims contract, from real files: every code list
    (``supplier`` keys, again in another form further down) and every lexicon sheet (``nation`` keys,
    listed twice) that the label map names, and a complement file."""
    configure(spark)
    base = work_path(spark, "claims-labels")
    supplier, nation, region = (fixture.table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    turns = F.explode(F.array(F.lit(0), F.lit(1))).alias("turn")
    listed = supplier.select("s_suppkey", "s_name", turns)
    sheeted = nation.select("n_nationkey", "n_name", turns)
    for kind, place in sorted({(kind, place) for _, _, kind, place in LABEL_MAP}):
        if kind == "list":
            key = F.col("s_suppkey").cast("string")
            code = F.when(F.col("turn") == 0, key).otherwise(F.concat(F.lit("0"), key, F.lit(".0")))
            rows = listed.select(
                code.alias(place[1]), F.lit("x").alias("AUTRE"),
                F.concat_ws(" ", F.lit(place[0]), "s_name", F.col("turn").cast("string")).alias(place[2]),
                (F.col("turn") * 1_000_000_000 + F.col("s_suppkey")).alias("line"),
            )
        else:
            rows = sheeted.select(
                F.col("n_nationkey").cast("string").alias("CODE"),
                F.concat_ws(" ", F.lit(place[0]), "n_name", F.col("turn").cast("string")).alias("LIBELLE"),
                (F.col("turn") * 1_000_000_000 + F.col("n_nationkey")).alias("line"),
            )
        _label_file(rows, f"{base}/{kind}/{place[0]}.csv")
    complements = region.select(
        F.lit("TOP_PS5_TRG").alias("column"), F.col("r_regionkey").cast("string").alias("code"),
        F.col("r_name").alias("label"), F.lit("region").alias("why"), F.col("r_regionkey").alias("line"),
    )
    _label_file(complements, f"{base}/complements.csv")
    table = TableRef(path=f"{base}/table", schema=LABELS_SCHEMA)
    write_labels(
        claims_sources(spark, f"{base}/list", f"{base}/sheet"),
        label_sources.read_complements(spark, f"{base}/complements.csv"), CLAIMS_CODE_COLUMNS, table,
    )
    return table.read(spark)


def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical form of code texts derived from lineitem (padded, signed, exponent, blanks)."""
    line = fixture.table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber").cast("string")
    candidates = line.select(
        F.lpad(n, 3, "0").alias("c1"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")).alias("c2"),
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")).alias("c3"),
        F.concat(F.lit("+"), n).alias("c4"),
        F.col("l_tax").cast("decimal(18,2)").cast("string").alias("c5"),
        F.concat(n, F.lit("e1")).alias("c6"),
        F.concat(F.lit("0"), F.col("l_returnflag"), F.col("l_linestatus")).alias("c7"),
        F.concat(n, F.lit(".00000000001")).alias("c8"),
        F.concat(n, F.repeat(F.lit("7"), F.lit(30)), F.lit(".000")).alias("c9"),
        F.concat(F.lit("-"), n, F.lit("e"), (F.col("l_quantity").cast("int") + 20).cast("string")).alias("c10"),
        F.concat(F.lit("."), n, F.lit("50E+"), (F.col("l_linenumber") % 3).cast("string")).alias("c11"),
        F.concat(n, F.lit("00e-"), (F.col("l_linenumber") % 4).cast("string")).alias("c12"),
    )
    kinds = candidates.columns
    return (
        candidates.unpivot([], kinds, "kind", "raw_code")
        .select("raw_code")
        .distinct()
        .select("raw_code", normalize_code(F.col("raw_code")).alias("code"))
    )


def _quoted_csv(df: DataFrame, path: str) -> str:
    """``;`` file with every field quoted, in four parts whose order is that of ``df``."""
    df.write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').csv(path)
    return path


def code_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a quoted code list over several files and splits; a type's first part wins."""
    configure(spark)
    part = fixture.table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.concat(F.col("p_name"), F.lit(' "ref; '), F.col("p_partkey"), F.lit('"')).alias("p_label")
    )
    listed = part.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    path = _quoted_csv(listed, work_path(spark, "code-list"))
    return label_sources.read_code_list(spark, path, "p_type", "p_label")


def lexicon_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as a lexicon sheet, listed twice over several files; the last row wins."""
    configure(spark)
    nation = fixture.table(spark, sf_dir, "nation")
    rows = nation.select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"),
        F.col("n_nationkey").cast("string").alias("key"),
        "n_name",
    ).select(
        "key", F.when(F.col("turn") == 0, F.col("n_name")).otherwise(F.lower("n_name")).alias("label"),
        (F.col("turn") * 1000 + F.col("key").cast("int")).alias("line"),
    )
    listed = rows.repartitionByRange(4, "line").sortWithinPartitions("line")
    path = _quoted_csv(listed, work_path(spark, "lexicon"))
    return label_sources.read_lexicon_sheet(spark, path)


def label_complement_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complements for ``supplier`` keys written in two forms (``7``, ``07.0``): the last row wins."""
    supplier = fixture.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    forms = F.explode(F.array(F.struct(key.alias("code"), F.lit(0).alias("turn")),
                              F.struct(F.concat(F.lit("0"), key, F.lit(".0")).alias("code"), F.lit(1).alias("turn"))))
    rows = supplier.select("s_suppkey", "s_name", forms.alias("f")).select(
        F.lit("service_code").alias("code_column"), F.col("f.code").alias("code"),
        F.concat_ws(" ", "s_name", F.col("f.turn").cast("string")).alias("libelle"),
        F.lit("supplier").alias("justification"),
        (F.col("f.turn") * 1_000_000_000 + F.col("s_suppkey")).alias("pos"),
    )
    return labels.normalized_complements(rows)


def label_dimension_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems of the stored dimension (a column without labels), and of one to which every part
    type was added a second time with a blank label."""
    dim = gold_lakehouse(spark, sf_dir).labels.read(spark)
    types = fixture.table(spark, sf_dir, "part").select("p_type").distinct()
    blank = types.select(
        F.lit("service_code").alias("code_column"), F.col("p_type").alias("code"),
        F.lit(" ").alias("libelle"), F.lit("test").alias("source"),
    )
    columns = label_sources.FIXTURE_CODE_COLUMNS
    stored = labels.dimension_problems(dim, columns).withColumn("variant", F.lit("stored"))
    spoilt = labels.dimension_problems(dim.unionByName(blank), columns)
    return stored.unionByName(spoilt.withColumn("variant", F.lit("spoilt"))).select(
        "variant", "problem", "code_column", "code", "rows"
    )


def label_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_sources.fixture_catalog_labels(spark, sf_dir)


def label_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_sources.fixture_lexicon_labels(spark, sf_dir)


def label_merge_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.merge_by_priority(label_sources.fixture_sources(spark, sf_dir))


def _candidate_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid complements plus two faulty kinds derived from region: raw region keys for
    region_code (already labelled by nation) and a code column the contract does not have."""
    region = fixture.table(spark, sf_dir, "region")
    key = F.col("r_regionkey").cast("string")
    conflicting = region.select(
        F.lit("region_code").alias("code_column"), key.alias("code"),
        F.col("r_name").alias("libelle"), F.lit("region key").alias("justification"),
        F.col("r_regionkey").alias("pos"),
    )
    unknown = region.select(
        F.lit("continent_code").alias("code_column"), key.alias("code"),
        F.col("r_name").alias("libelle"), F.lit("continent").alias("justification"),
        F.col("r_regionkey").alias("pos"),
    )
    return (
        label_sources.fixture_complements(spark, sf_dir)
        .unionByName(conflicting)
        .unionByName(unknown)
    )


def complement_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = labels.merge_by_priority(label_sources.fixture_sources(spark, sf_dir))
    return labels.complement_conflicts(_candidate_complements(spark, sf_dir), merged)


def complement_unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = labels.column_positions(spark, label_sources.FIXTURE_CODE_COLUMNS)
    return labels.complement_unknown_columns(_candidate_complements(spark, sf_dir), columns)


def label_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension built and checked, exported as ``;`` CSV, read back with its explicit schema,
    stored as a table (full replace) and read again."""
    configure(spark)
    base = work_path(spark, "labels")
    dim = labels.build_dimension(
        label_sources.fixture_sources(spark, sf_dir),
        label_sources.fixture_complements(spark, sf_dir),
        label_sources.FIXTURE_CODE_COLUMNS,
    )
    dim.write.mode("overwrite").option("header", True).option("sep", ";").csv(f"{base}/csv")
    table = TableRef(path=f"{base}/table", schema=LABELS_SCHEMA)
    overwrite_table(label_sources.read_dimension(spark, f"{base}/csv"), table)
    return table.read(spark)


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service codes present in silver with their label, NULL when there is none."""
    codes = _silver(spark, sf_dir).select(F.col(C.service).alias("code")).distinct()
    lib = gold.labels_for(_labels(spark, sf_dir), C.spec(C.service).source)
    return codes.join(lib, "code", "left")


def label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.label_coverage(_silver(spark, sf_dir), _labels(spark, sf_dir), C)


def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_labels(_silver(spark, sf_dir), _labels(spark, sf_dir), C)


# ---------------------------------------------------------------------------------------------
# gold


def stg_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.staging_spend(_silver(spark, sf_dir), C)


def spend_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.spend_by_service(stg_spend(spark, sf_dir), _labels(spark, sf_dir), C)


def spend_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.spend_by_region(stg_spend(spark, sf_dir), _labels(spark, sf_dir), C)


def top_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_services(spend_by_service(spark, sf_dir), C, 5)


def ratio_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row: reimbursed / spend, and overrun / (overrun - 0.04) (zero and negative
    denominators included), as distinct (numerator, denominator, ratio) with counts."""
    silver = _silver(spark, sf_dir)
    shifted = (F.col(C.overrun) - F.lit(0.04).cast("decimal(18,2)")).cast("decimal(18,2)")
    pairs = silver.select(
        F.lit("rembourse_sur_depense").alias("famille"),
        F.col(C.reimbursed).alias("numerateur"),
        F.col(C.amount).alias("denominateur"),
    ).unionByName(
        silver.select(
            F.lit("depassement_decale").alias("famille"),
            F.col(C.overrun).alias("numerateur"),
            shifted.alias("denominateur"),
        )
    )
    return (
        pairs.withColumn("ratio", ratio(F.col("numerateur"), F.col("denominateur")))
        .groupBy("famille", "numerateur", "denominateur", "ratio")
        .agg(F.count(F.lit(1)).cast("bigint").alias("lignes"))
    )


def totals_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months where a stored mart's total differs from silver: the built marts (only the rows
    without a month, which match nothing) and a service mart whose latest month was dropped."""
    house = gold_lakehouse(spark, sf_dir)
    month = C.processing_month
    summary = gold_plan.silver_summary(stg_spend(spark, sf_dir), C)
    service = _stored_mart(spark, house, gold_plan.SERVICE_MART)
    region = _stored_mart(spark, house, gold_plan.REGION_MART)
    latest = service.agg(F.max(month).alias("m"))
    broken = service.join(latest, F.col(month) == F.col("m"), "left_anti")
    parts = [
        quality.totals_match(mart, summary, month, columns).withColumn(
            "check", F.concat_ws(":", F.lit(name), "column")
        )
        for name, mart, columns in (
            ("service", service, [C.amount, C.reimbursed]),
            ("region", region, [C.amount, C.reimbursed]),
            ("service_latest_month_dropped", broken, [C.amount]),
        )
    ]
    return reduce(DataFrame.unionByName, parts).select("check", month, "total_gold", "total_silver")


def gold_build_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_mart(spark, gold_lakehouse(spark, sf_dir), gold_plan.SERVICE_MART)


def gold_build_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_mart(spark, gold_lakehouse(spark, sf_dir), gold_plan.REGION_MART)


def gold_month_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts of a full build, then every third month rebuilt: the same rows as before."""
    house = gold_lakehouse(spark, sf_dir)
    target = Lakehouse(work_path(spark, "rebuilt"), C)
    _build_gold(spark, house, target)
    months = _months(house.silver.read(spark))
    _build_gold(spark, house, target, months[::3])
    marts = (
        _stored_mart(spark, target, name).select(
            F.lit(name).alias("mart"), F.col(C.processing_month), F.col(key).alias("code"),
            gold.ROWS, C.amount, gold.EFFECTIVE_RATE, PARTITION_COLUMN,
        )
        for name, key in ((gold_plan.SERVICE_MART, C.service), (gold_plan.REGION_MART, C.region))
    )
    return reduce(DataFrame.unionByName, marts)


def catalog_lakehouse(spark: SparkSession, sf_dir: str) -> tuple[CatalogLakehouse, list[gold_plan.CheckResult]]:
    """Files -> bronze -> silver -> staging view and marts, all as tables of one new database; then the
    latest month loaded, built and rebuilt in gold a second time."""
    files = lakehouse(spark, sf_dir)
    house = CatalogLakehouse(work_name("ledgerlake"), C)
    create_database(spark, house)
    months = raw_months(spark, files.raw_dir)
    write_labels(
        label_sources.fixture_sources(spark, sf_dir), label_sources.fixture_complements(spark, sf_dir),
        label_sources.FIXTURE_CODE_COLUMNS, house.labels,
    )
    results = []
    for some in (months, months[-1:]):
        bronze_plan.ingest_months(
            spark, files.raw_dir, house.bronze, some, fixture.INGESTED_AT, layout=monthly_files.FIXTURE_LAYOUT
        )
        silver_plan.build_silver(spark, house.bronze, house.silver, house.quarantine, some, C, codes=house.codes)
        create_staging(spark, house)
        results = gold_plan.build_gold(
            spark, house.silver, house.labels, house.gold(gold_plan.SERVICE_MART), house.gold(gold_plan.REGION_MART),
            C, fail_on_error=False, months=some if results else None, codes=house.codes,
        )
    return house, results


def gold_from_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by month, asked in SQL of the registered tables: the staging view and both marts."""
    house, _ = catalog_lakehouse(spark, sf_dir)
    service, region = (house.gold(n).name for n in (gold_plan.SERVICE_MART, gold_plan.REGION_MART))
    month, amount = C.processing_month, C.amount
    return spark.sql(
        f"""
        WITH rows AS (
          SELECT 'stg_depenses' AS source, {month}, 1 AS lignes, {amount} AS montant FROM {house.staging.name}
          UNION ALL SELECT '{gold_plan.SERVICE_MART}', {month}, {gold.ROWS}, {amount} FROM {service}
          UNION ALL SELECT '{gold_plan.REGION_MART}', {month}, {gold.ROWS}, {amount} FROM {region})
        SELECT source, {month}, CAST(sum(lignes) AS BIGINT) AS lignes, CAST(sum(montant) AS DECIMAL(28,2)) AS montant
        FROM rows GROUP BY source, {month}
        """
    )


def gold_month_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label audit of a run over the latest month only: codes of all months without a label, and
    how many the run reported."""
    house = gold_lakehouse(spark, sf_dir)
    target = Lakehouse(work_path(spark, "audited"), C)
    latest = max(house.silver.months(spark))
    results = _build_gold(spark, house, target, [latest])
    reported = next(r.rows for r in results if r.name == "missing_labels")
    counts = gold_plan.code_counts(spark, house.silver, house.codes, C)
    found = quality.without_label(counts, house.labels.read(spark))
    return found.withColumn("reported", F.lit(reported).cast("bigint"))


def month_swap_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of the latest month while it is replaced by twice its rows: after the first
    load, after a job that died before its commit, and after one that did commit."""
    configure(spark)
    table = TableRef(path=work_path(spark, "bronze_swap"), schema=C.bronze_schema())
    df = _bronze(spark, sf_dir)
    months = _months(df)
    overwrite_months(df, table, months)
    latest = months[-1]
    month_rows = df.where(F.col(PARTITION_COLUMN) == latest)
    twice = month_rows.unionByName(month_rows)
    loaded = quality.rows_per_month(table.read(spark))
    table.add_version(twice, month_pointer.new_version())  # written whole, but never shown
    died = quality.rows_per_month(table.read(spark))
    overwrite_month(twice, table, latest)
    shown = quality.rows_per_month(table.read(spark))
    steps = [("1 loaded", loaded), ("2 died", died), ("3 replaced", shown)]
    return reduce(DataFrame.unionByName, (rows.withColumn("step", F.lit(step)) for step, rows in steps))


def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver placed by service, region and care month together, read with a filter on two of them: one
    service in the regions whose number starts with 1."""
    house = fixture_lakehouse(spark, sf_dir)
    target = Lakehouse(work_path(spark, "clustered"), C)
    bronze = _fixture_bronze_ref(house)
    silver_plan.build_silver(
        spark, bronze, target.silver, target.quarantine, _months(bronze.read(spark)), C,
        cluster_by=(C.service, C.region, C.care_month),
    )
    chosen = (F.col(C.service) == "PROMO") & F.col(C.region).between("1", "19")
    return target.silver.read(spark).where(chosen).select(*BUSINESS, PARTITION_COLUMN)


def gold_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of the full gold build with its severity and its number of offending rows."""
    results = _gold(spark, sf_dir)[1]
    return spark.createDataFrame(
        [(r.name, r.severity, r.rows) for r in results], "name string, severity string, rows bigint"
    )


def not_null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = stg_spend(spark, sf_dir)
    house = gold_lakehouse(spark, sf_dir)
    service = _stored_mart(spark, house, gold_plan.SERVICE_MART)
    region = _stored_mart(spark, house, gold_plan.REGION_MART)
    month = C.processing_month
    measures = [NotNull(C.amount), NotNull(C.reimbursed)]
    return (
        quality.not_null_counts(staging, "stg_depenses", [NotNull(month), NotNull(C.amount)])
        .unionByName(quality.not_null_counts(
            service, gold_plan.SERVICE_MART,
            [NotNull(month), NotNull(C.service), *measures,
             NotNull(gold.LABEL_PREFIX + C.service, WARN)]))
        .unionByName(quality.not_null_counts(
            region, gold_plan.REGION_MART,
            [NotNull(month), NotNull(C.region), *measures,
             NotNull(gold.LABEL_PREFIX + C.region, WARN)]))
    )


QUERIES: dict[str, Query] = {
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "bronze_monthly_files": bronze_monthly_files,
    "technical_columns": technical_columns,
    "month_slice": month_slice,
    "parse_year_month": parse_year_month_q,
    "typed_projection": typed_projection,
    "rejection_reasons": rejection_reasons,
    "silver_valid": silver_valid,
    "quarantine_rows": quarantine_rows,
    "rejection_reason_counts": rejection_reason_counts,
    "reconcile_totals": reconcile_totals,
    "reconcile_check": reconcile_check,
    "source_profile": source_profile,
    "partition_overwrite_idempotent": partition_overwrite_idempotent,
    "partition_overwrite_isolated": partition_overwrite_isolated,
    "quarantine_cleared": quarantine_cleared,
    "write_row_metrics": write_row_metrics,
    "missing_months": missing_months,
    "label_normalize": label_normalize,
    "label_first_wins": label_first_wins,
    "label_last_wins": label_last_wins,
    "label_merge_priority": label_merge_priority,
    "complement_conflicts": complement_conflicts,
    "complement_unknown_columns": complement_unknown_columns,
    "label_dimension": label_dimension,
    "label_lookup": label_lookup,
    "label_coverage": label_coverage,
    "missing_labels": missing_labels,
    "stg_spend": stg_spend,
    "spend_by_service": spend_by_service,
    "spend_by_region": spend_by_region,
    "top_services": top_services,
    "ratio": ratio_q,
    "unique_grain": unique_grain,
    "totals_match": totals_match,
    "not_null_checks": not_null_checks,
    "table_parity": table_parity,
    "table_parity_by_month": table_parity_by_month,
    "bronze_header_order": bronze_header_order,
    "bronze_repeated_month": bronze_repeated_month,
    "bronze_odd_template": bronze_odd_template,
    "bronze_gzip_parallel": bronze_gzip_parallel,
    "empty_month_guard": empty_month_guard,
    "code_list_scan": code_list_scan,
    "lexicon_scan": lexicon_scan,
    "label_complement_last_wins": label_complement_last_wins,
    "label_dimension_checks": label_dimension_checks,
    "gold_build_service": gold_build_service,
    "gold_build_region": gold_build_region,
    "gold_month_rebuild": gold_month_rebuild,
    "gold_checks": gold_checks,
    "gold_month_audit": gold_month_audit,
    "month_swap_atomic": month_swap_atomic,
    "clustered_read": clustered_read,
    "refused_months": refused_months,
    "claims_dimension": claims_dimension,
    "gold_from_catalog": gold_from_catalog,
    "source_profile_merged": source_profile_merged,
}
