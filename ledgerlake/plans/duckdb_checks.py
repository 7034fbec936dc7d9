"""Independent SQL statements of every registered query, for a second engine (DuckDB).

They read the same test tables (registered as views named after them) and re-state each rule in
plain SQL, so a value-level comparison with the Spark result checks the Spark operators.
Integer casts are regex-guarded (DuckDB accepts ``1.5`` as an integer); ratios are computed in
integer cents to reproduce the decimal(38,10) quotient followed by half-up rounding to 4 places.
"""

from __future__ import annotations

from ledgerlake.sources.claims_labels import LABEL_MAP

# Claims-text fixture (see ledgerlake.sources.fixture), typed columns and reasons.
_BASE = """
base AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS k,
         year(l.l_shipdate) * 100 + month(l.l_shipdate) AS ym,
         year(l.l_shipdate) * 12 + month(l.l_shipdate) - 1 - (l.l_linenumber - 1) AS care,
         l.l_returnflag, l.l_linestatus, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_quantity, c.c_nationkey, p.p_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
fx AS (
  SELECT k,
    CASE WHEN k % 101 = 0 THEN '209901' WHEN k % 149 = 0 THEN NULL ELSE CAST(ym AS VARCHAR) END AS flow_month,
    CASE WHEN k % 103 = 0 THEN '0000'
         WHEN k % 107 = 0 THEN '0001'
         WHEN k % 113 = 0 THEN CAST(CAST(floor((care + 9) / 12) AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(floor(care / 12) AS BIGINT) AS VARCHAR) END AS care_year,
    CASE WHEN k % 103 = 0 THEN '00'
         WHEN k % 107 = 0 THEN '01'
         WHEN k % 109 = 0 THEN '13'
         WHEN k % 113 = 0 THEN lpad(CAST((care + 9) % 12 + 1 AS VARCHAR), 2, '0')
         ELSE lpad(CAST(care % 12 + 1 AS VARCHAR), 2, '0') END AS care_month,
    '0' || l_returnflag || l_linestatus AS status_code,
    p_type AS service_code,
    CAST(c_nationkey AS VARCHAR) AS region_code,
    CASE WHEN k % 127 = 0 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         WHEN k % 131 = 0 THEN NULL
         WHEN k % 137 = 0 THEN repeat('1', 20)
         WHEN l_returnflag = 'R' THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS spend,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS VARCHAR)
      AS reimbursed,
    regexp_replace(CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), '^0', '') AS overrun,
    CASE WHEN k % 139 = 0 THEN '1.5' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CAST(ym AS VARCHAR) AS _year_month
  FROM base
)"""


def _ym_date(t: str) -> str:
    y = f"TRY_CAST(substr({t}, 1, 4) AS INTEGER)"
    m = f"TRY_CAST(substr({t}, 5, 2) AS INTEGER)"
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{6}}') AND {y} BETWEEN 1900 AND 2100 "
        f"AND {m} BETWEEN 1 AND 12 THEN make_date({y}, {m}, 1) END"
    )


def _int(t: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({t}), '[+-]?[0-9]+') THEN TRY_CAST(trim({t}) AS INTEGER) END"


_TYPED = f"""
typed AS (
  SELECT fx.*,
    {_ym_date('flow_month')} AS mois_traitement,
    {_ym_date('(care_year || care_month)')} AS mois_soins,
    service_code AS nature_prestation,
    status_code AS code_statut,
    region_code AS region_residence_beneficiaire,
    {_int('quantity')} AS quantite_acte_base,
    TRY_CAST(overrun AS DECIMAL(18,2)) AS montant_depassement,
    TRY_CAST(spend AS DECIMAL(18,2)) AS montant_depense,
    TRY_CAST(spend AS DECIMAL(18,2)) AS base_remboursement,
    TRY_CAST(reimbursed AS DECIMAL(18,2)) AS montant_rembourse
  FROM fx
),
checked AS (
  SELECT typed.*,
    concat_ws(',',
      CASE WHEN quantity IS NOT NULL AND quantite_acte_base IS NULL THEN 'non_numerique:quantity' END,
      CASE WHEN overrun IS NOT NULL AND montant_depassement IS NULL THEN 'non_numerique:overrun' END,
      CASE WHEN spend IS NOT NULL AND montant_depense IS NULL THEN 'non_numerique:spend' END,
      CASE WHEN reimbursed IS NOT NULL AND montant_rembourse IS NULL THEN 'non_numerique:reimbursed' END,
      CASE WHEN flow_month <> _year_month THEN 'mois_traitement_incoherent' END,
      CASE WHEN (care_year || care_month) NOT IN ('000000', '000101') AND mois_soins IS NULL
           THEN 'mois_soins_invalide' END,
      CASE WHEN mois_soins > mois_traitement THEN 'soins_apres_traitement' END
    ) AS motifs
  FROM typed
),
silver AS (SELECT * FROM checked WHERE motifs = ''),
rejected AS (SELECT * FROM checked WHERE motifs <> '')"""

_BUSINESS = (
    "mois_traitement, mois_soins, nature_prestation, code_statut, region_residence_beneficiaire, "
    "quantite_acte_base, montant_depassement, montant_depense, base_remboursement, montant_rembourse"
)
_RAW = "flow_month, care_year, care_month, status_code, service_code, region_code, spend, reimbursed, overrun, quantity"


def _norm(t: str) -> str:
    """Integral numbers as plain integers, decided on the digits."""
    number = "^([+-]?)(\\d*)\\.?(\\d*)(?:[eE]([+-]?\\d+))?$"

    def part(k: int) -> str:
        return f"regexp_extract({t}, '{number}', {k})"

    shift = f"coalesce(TRY_CAST({part(4)} AS INTEGER), 0)"
    fraction = f"rtrim({part(3)}, '0')"
    digits = f"({part(2)} || {fraction})"
    after = f"(length({fraction}) - {shift})"
    whole = f"CASE WHEN {after} <= 0 THEN {digits} || repeat('0', -{after}) ELSE left({digits}, greatest(length({digits}) - {after}, 0)) END"
    behind = f"CASE WHEN {after} <= 0 THEN '' ELSE right({digits}, least({after}, length({digits}))) END"
    plain = f"ltrim({whole}, '0')"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
        f"AND abs({shift}) <= 999 AND rtrim({behind}, '0') = '' "
        f"THEN CASE WHEN {plain} = '' THEN '0' WHEN {part(1)} = '-' THEN '-' || {plain} ELSE {plain} END ELSE {t} END"
    )


def _clean(t: str) -> str:
    return f"trim(regexp_replace(replace({t}, '\"', ' '), '\\s+', ' ', 'g'))"


_LABELS = f"""
nation_src AS (
  SELECT code, arg_min(lbl, pos) AS libelle FROM (
    SELECT {_norm("CAST(n_nationkey AS VARCHAR)")} AS code, {_clean('n_name')} AS lbl, n_nationkey AS pos
    FROM nation WHERE trim(n_name) <> '') GROUP BY code
),
catalog_src AS (
  SELECT code, libelle FROM (
    SELECT {_norm('trim(p_type)')} AS code, {_clean('p_name')} AS libelle,
           row_number() OVER (PARTITION BY {_norm('trim(p_type)')} ORDER BY p_partkey, {_clean('p_name')}) AS rn
    FROM part WHERE p_type NOT IN ('PROMO', 'STANDARD') AND trim(p_type) <> '' AND trim(p_name) <> '')
  WHERE rn = 1
),
lexicon_src AS (
  SELECT code, libelle FROM (
    SELECT {_norm('trim(p_type)')} AS code, {_clean('upper(p_name)')} AS libelle,
           row_number() OVER (PARTITION BY {_norm('trim(p_type)')} ORDER BY p_partkey DESC, {_clean('upper(p_name)')} DESC) AS rn
    FROM part WHERE p_type <> 'STANDARD' AND trim(p_type) <> '' AND trim(p_name) <> '')
  WHERE rn = 1
),
sources AS (
  SELECT 'region_code' AS code_column, code, libelle, 'nation code list' AS source, 1 AS priority FROM nation_src
  UNION ALL SELECT 'service_code', code, libelle, 'part catalog', 1 FROM catalog_src
  UNION ALL SELECT 'service_code', code, libelle, 'part lexicon', 2 FROM lexicon_src
),
merged AS (
  SELECT code_column, code, libelle, source FROM (
    SELECT *, row_number() OVER (PARTITION BY code_column, code ORDER BY priority, source) AS rn FROM sources)
  WHERE rn = 1
),
complements AS (
  SELECT 'region_code' AS code_column, 'R' || CAST(r_regionkey AS VARCHAR) AS code, r_name AS libelle,
         'regional grouping of nations' AS justification FROM region
),
dim AS (
  SELECT code_column, code, libelle, source FROM merged
  UNION ALL SELECT code_column, {_norm('trim(code)')}, libelle, 'Complément du projet' FROM complements
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_ALL = _with(_BASE, _TYPED, _LABELS)


def _ratio(n: str, d: str) -> str:
    """round(n / d, 4) as Spark computes it on decimal(x,2) inputs, NULL when d = 0."""
    nc = f"CAST(round(({n}) * 100) AS HUGEINT)"
    dc = f"CAST(round(({d}) * 100) AS HUGEINT)"
    q10 = f"((abs({nc}) * 20000000000 + abs({dc})) // (2 * abs({dc})))"
    q4 = f"(CAST(sign({nc}) * sign({dc}) AS HUGEINT) * (({q10} + 500000) // 1000000))"
    return (
        f"CASE WHEN ({d}) = 0 OR ({d}) IS NULL OR ({n}) IS NULL THEN NULL "
        f"ELSE CAST(CAST({q4} AS DECIMAL(38,0)) * CAST(0.0001 AS DECIMAL(9,4)) AS DECIMAL(9,4)) END"
    )


_MART_SUMS = """count(*) AS nombre_lignes,
    CAST(sum(montant_depense) AS DECIMAL(28,2)) AS montant_depense,
    CAST(sum(base_remboursement) AS DECIMAL(28,2)) AS base_remboursement,
    CAST(sum(montant_rembourse) AS DECIMAL(28,2)) AS montant_rembourse,
    CAST(sum(montant_depassement) AS DECIMAL(28,2)) AS montant_depassement"""

_SERVICE = f"""
svc_agg AS (
  SELECT mois_traitement, nature_prestation, {_MART_SUMS}
  FROM silver GROUP BY mois_traitement, nature_prestation
),
svc AS (
  SELECT a.mois_traitement, a.nature_prestation, l.libelle AS libelle_nature_prestation,
    a.nombre_lignes, a.montant_depense, a.base_remboursement, a.montant_rembourse, a.montant_depassement,
    CAST(a.montant_depense - a.montant_rembourse AS DECIMAL(28,2)) AS montant_non_rembourse,
    {_ratio('a.montant_rembourse', 'a.montant_depense')} AS taux_remboursement_effectif,
    {_ratio('a.montant_depassement', 'a.montant_depense')} AS part_depassement
  FROM svc_agg a LEFT JOIN (SELECT code, libelle FROM dim WHERE code_column = 'service_code') l
    ON l.code = a.nature_prestation
)"""

_REGION = f"""
reg_agg AS (
  SELECT mois_traitement, region_residence_beneficiaire, {_MART_SUMS}
  FROM silver GROUP BY mois_traitement, region_residence_beneficiaire
),
reg AS (
  SELECT a.mois_traitement, a.region_residence_beneficiaire,
    l.libelle AS libelle_region_residence_beneficiaire,
    a.nombre_lignes, a.montant_depense, a.base_remboursement, a.montant_rembourse, a.montant_depassement,
    CAST(a.montant_depense - a.montant_rembourse AS DECIMAL(28,2)) AS montant_non_rembourse,
    {_ratio('a.montant_rembourse', 'a.montant_depense')} AS taux_remboursement_effectif,
    {_ratio('a.montant_depense', 'sum(a.montant_depense) OVER (PARTITION BY a.mois_traitement)')}
      AS part_depense_nationale
  FROM reg_agg a LEFT JOIN (SELECT code, libelle FROM dim WHERE code_column = 'region_code') l
    ON l.code = a.region_residence_beneficiaire
)"""

_GOLD = _with(_BASE, _TYPED, _LABELS, _SERVICE, _REGION)

_CODE_COUNTS = """
codes AS (
  SELECT code_column, code, count(*) AS lignes FROM (
    SELECT 'service_code' AS code_column, nature_prestation AS code FROM silver
    UNION ALL SELECT 'status_code', code_statut FROM silver
    UNION ALL SELECT 'region_code', region_residence_beneficiaire FROM silver
  ) WHERE code IS NOT NULL GROUP BY code_column, code
)"""

_LAST_MONTH = "(SELECT max(_year_month) FROM fx)"
_REJECT_TOTALS = "count(*) AS rows, CAST(coalesce(sum(TRY_CAST(spend AS DECIMAL(18,2))), 0) AS DECIMAL(28,2)) AS amount"


def _totals_diff(mart: str, column: str, check: str) -> str:
    return f"""
SELECT '{check}' AS "check", coalesce(g.m, s.m) AS mois_traitement, g.t AS total_gold, s.t AS total_silver
FROM (SELECT mois_traitement AS m, CAST(sum({column}) AS DECIMAL(38,2)) AS t FROM {mart} GROUP BY 1) g
FULL OUTER JOIN (SELECT mois_traitement AS m, CAST(sum({column}) AS DECIMAL(38,2)) AS t FROM silver GROUP BY 1) s
  ON g.m = s.m
WHERE g.t IS DISTINCT FROM s.t"""


def _not_null(table: str, source: str, cols: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", '{sev}' AS severity, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_rows FROM {source}"
        for c, sev in cols
    ]
    return " UNION ALL ".join(parts)


_STORED = "coalesce(strftime(mois_traitement, '%Y%m'), 'inconnu') AS _year_month"
_NULLS = {
    "not_null_staging": ("error", "silver", ("mois_traitement", "montant_depense")),
    "not_null_service": (
        "error", "svc", ("mois_traitement", "nature_prestation", "montant_depense", "montant_rembourse")
    ),
    "not_null_service_label": ("warn", "svc", ("libelle_nature_prestation",)),
    "not_null_region": (
        "error", "reg", ("mois_traitement", "region_residence_beneficiaire", "montant_depense", "montant_rembourse")
    ),
    "not_null_region_label": ("warn", "reg", ("libelle_region_residence_beneficiaire",)),
}
_GRAINS = {
    "unique_labels": ("dim", "code_column, code"),
    "unique_service": ("svc", "mois_traitement, nature_prestation"),
    "unique_region": ("reg", "mois_traitement, region_residence_beneficiaire"),
}
_CHECK_COUNTS = [
    *(
        f"SELECT '{name}' AS name, '{severity}' AS severity, CAST("
        + " + ".join(f"(SELECT CAST(count(*) > 0 AS INT) FROM {source} WHERE {c} IS NULL)" for c in columns)
        + " AS BIGINT) AS rows"
        for name, (severity, source, columns) in _NULLS.items()
    ),
    *(
        f"SELECT '{name}', 'error', (SELECT count(*) FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1))"
        for name, (source, keys) in _GRAINS.items()
    ),
    "SELECT 'missing_labels', 'warn', (SELECT count(*) FROM codes c LEFT JOIN dim d "
    "ON d.code_column = c.code_column AND d.code = c.code WHERE d.code IS NULL)",
    *(
        f"SELECT 'totals_{mart}', 'error', (SELECT count(*) FROM ("
        + " UNION ALL ".join(_totals_diff(source, c, c) for c in ("montant_depense", "montant_rembourse"))
        + "))"
        for mart, source in (("depenses_par_prestation", "svc"), ("depenses_par_region", "reg"))
    ),
]


_MAP_ROWS = ", ".join(f"('{column}', {priority}, '{kind}', '{place[0]}')" for column, priority, kind, place in LABEL_MAP)

_UNCONVERTED = {
    "spend": "montant_depense", "reimbursed": "montant_rembourse", "overrun": "montant_depassement",
    "quantity": "quantite_acte_base",
}


def _column_profile(raw: str) -> str:
    """Counts of one raw column, and its most frequent text that does not convert."""
    counts = f"SELECT '{raw}' AS colonne, count(*) AS lignes, count(*) FILTER (WHERE {raw} IS NULL) AS vides, "
    typed = _UNCONVERTED.get(raw)
    if typed is None:
        return counts + "0 AS non_convertibles, NULL AS texte_frequent, NULL AS lignes_texte FROM typed"
    bad = f"{raw} IS NOT NULL AND {typed} IS NULL"
    top = f"FROM (SELECT {raw} AS t, count(*) AS n FROM typed WHERE {bad} GROUP BY 1 ORDER BY 2 DESC LIMIT 1)"
    return counts + f"count(*) FILTER (WHERE {bad}), (SELECT t {top}), (SELECT n {top}) FROM typed"


ORACLE_SQL: dict[str, str] = {
    "bronze_csv_roundtrip": _with(_BASE)
    + f"SELECT {_RAW}, 'A' || _year_month || '.csv.gz' AS _source_file, _year_month FROM fx",
    "bronze_monthly_files": _with(_BASE)
    + "SELECT _year_month, count(*) AS lignes FROM fx GROUP BY _year_month",
    "technical_columns": _with(_BASE)
    + "SELECT 'A' || _year_month || '.csv.gz' AS _source_file, _year_month, "
    "'2026-01-15 00:00:00' AS ingere_le, count(*) AS lignes FROM fx GROUP BY _year_month",
    "month_slice": _with(_BASE) + f"SELECT {_RAW}, _year_month FROM fx WHERE _year_month = {_LAST_MONTH}",
    "parse_year_month": _with(_BASE)
    + f"SELECT care_year || care_month AS texte, {_ym_date('(care_year || care_month)')} AS mois, "
    "count(*) AS lignes FROM fx GROUP BY 1, 2",
    "typed_projection": _ALL + f"SELECT k, {_BUSINESS} FROM typed",
    "rejection_reasons": _ALL + "SELECT k, motifs FROM checked",
    "silver_valid": _ALL + f"SELECT {_BUSINESS}, _year_month FROM silver",
    "quarantine_rows": _ALL + f"SELECT {_RAW}, _year_month, motifs FROM rejected",
    "rejection_reason_counts": _ALL
    + "SELECT motif, count(*) AS lignes FROM (SELECT unnest(string_split(motifs, ',')) AS motif "
    "FROM rejected) GROUP BY motif",
    "reconcile_totals": _ALL
    + f"SELECT 'bronze' AS layer, {_REJECT_TOTALS} FROM fx "
    f"UNION ALL SELECT 'silver', count(*), CAST(coalesce(sum(montant_depense), 0) AS DECIMAL(28,2)) FROM silver "
    f"UNION ALL SELECT 'quarantine', {_REJECT_TOTALS} FROM rejected",
    "reconcile_check": _ALL
    + "SELECT 'quarantine_missing' AS variant, measure, bronze, silver_plus_quarantine FROM ("
    f"SELECT 'rows' AS measure, CAST((SELECT count(*) FROM fx) AS DECIMAL(38,2)) AS bronze, "
    f"CAST((SELECT count(*) FROM silver) AS DECIMAL(38,2)) AS silver_plus_quarantine "
    f"UNION ALL SELECT 'amount', CAST((SELECT coalesce(sum(TRY_CAST(spend AS DECIMAL(18,2))), 0) FROM fx) AS DECIMAL(38,2)), "
    f"CAST((SELECT coalesce(sum(montant_depense), 0) FROM silver) AS DECIMAL(38,2))) "
    "WHERE bronze IS DISTINCT FROM silver_plus_quarantine",
    "source_profile": _ALL
    + """SELECT indicateur, lignes FROM (
  SELECT 'lignes' AS indicateur, count(*) AS lignes FROM typed
  UNION ALL SELECT 'montant_negatif:spend', count(*) FILTER (WHERE montant_depense < 0) FROM typed
  UNION ALL SELECT 'mois_soins_inconnu', count(*) FILTER (WHERE (care_year || care_month) IN ('000000', '000101')) FROM typed
  UNION ALL SELECT 'mois_soins_invalide', count(*) FILTER (WHERE (care_year || care_month) NOT IN ('000000', '000101') AND mois_soins IS NULL) FROM typed
  UNION ALL SELECT 'non_convertible:quantity', count(*) FILTER (WHERE quantity IS NOT NULL AND quantite_acte_base IS NULL) FROM typed
  UNION ALL SELECT 'non_convertible:overrun', count(*) FILTER (WHERE overrun IS NOT NULL AND montant_depassement IS NULL) FROM typed
  UNION ALL SELECT 'non_convertible:spend', count(*) FILTER (WHERE spend IS NOT NULL AND montant_depense IS NULL) FROM typed
  UNION ALL SELECT 'non_convertible:reimbursed', count(*) FILTER (WHERE reimbursed IS NOT NULL AND montant_rembourse IS NULL) FROM typed
)""",
    "partition_overwrite_idempotent": _with(_BASE)
    + "SELECT _year_month, count(*) AS lignes FROM fx GROUP BY _year_month",
    "partition_overwrite_isolated": _with(_BASE)
    + f"SELECT _year_month, count(*) * (CASE WHEN _year_month = {_LAST_MONTH} THEN 2 ELSE 1 END) AS lignes "
    "FROM fx GROUP BY _year_month",
    "month_swap_atomic": _with(_BASE)
    + f"""SELECT _year_month, count(*) * (CASE WHEN step = '3 replaced' AND _year_month = {_LAST_MONTH} THEN 2 ELSE 1 END)
  AS lignes, step FROM fx, (VALUES ('1 loaded'), ('2 died'), ('3 replaced')) AS s(step) GROUP BY _year_month, step""",
    "quarantine_cleared": _ALL
    + f"SELECT _year_month, count(*) AS lignes FROM rejected WHERE _year_month <> {_LAST_MONTH} GROUP BY _year_month",
    "write_row_metrics": _ALL
    + "SELECT 'silver' AS layer, count(*) AS observed_rows, count(*) AS actual_rows FROM silver "
    "UNION ALL SELECT 'quarantine', count(*), count(*) FROM rejected",
    "missing_months": _with(_BASE)
    + """SELECT _year_month FROM (
  SELECT y || lpad(CAST(m AS VARCHAR), 2, '0') AS _year_month
  FROM (SELECT DISTINCT substr(_year_month, 1, 4) AS y, unnest(range(1, 13)) AS m FROM fx)
) WHERE _year_month NOT IN (SELECT DISTINCT _year_month FROM fx)""",
    "label_normalize": f"""SELECT raw_code, {_norm('trim(raw_code)')} AS code FROM (
  SELECT DISTINCT raw_code FROM (
    SELECT lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS raw_code FROM lineitem
    UNION ALL SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.0' FROM lineitem
    UNION ALL SELECT ' ' || l_returnflag || ' ' FROM lineitem
    UNION ALL SELECT '+' || CAST(l_linenumber AS VARCHAR) FROM lineitem
    UNION ALL SELECT CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem
    UNION ALL SELECT CAST(l_linenumber AS VARCHAR) || 'e1' FROM lineitem
    UNION ALL SELECT '0' || l_returnflag || l_linestatus FROM lineitem
    UNION ALL SELECT CAST(l_linenumber AS VARCHAR) || '.00000000001' FROM lineitem
    UNION ALL SELECT CAST(l_linenumber AS VARCHAR) || repeat('7', 30) || '.000' FROM lineitem
    UNION ALL SELECT '-' || CAST(l_linenumber AS VARCHAR) || 'e' || CAST(CAST(l_quantity AS INTEGER) + 20 AS VARCHAR) FROM lineitem
    UNION ALL SELECT '.' || CAST(l_linenumber AS VARCHAR) || '50E+' || CAST(l_linenumber % 3 AS VARCHAR) FROM lineitem
    UNION ALL SELECT CAST(l_linenumber AS VARCHAR) || '00e-' || CAST(l_linenumber % 4 AS VARCHAR) FROM lineitem))""",
    "label_first_wins": _with(_LABELS) + "SELECT code, libelle FROM catalog_src",
    "label_last_wins": _with(_LABELS) + "SELECT code, libelle FROM lexicon_src",
    "label_merge_priority": _with(_LABELS) + "SELECT code_column, code, libelle, source FROM merged",
    "complement_conflicts": _with(_LABELS)
    + "SELECT 'region_code' AS code_column, CAST(r_regionkey AS VARCHAR) AS code, r_name AS libelle, "
    "'region key' AS justification FROM region WHERE CAST(r_regionkey AS VARCHAR) IN "
    "(SELECT code FROM merged WHERE code_column = 'region_code')",
    "complement_unknown_columns": "SELECT 'continent_code' AS code_column, CAST(r_regionkey AS VARCHAR) AS code, "
    "r_name AS libelle, 'continent' AS justification FROM region",
    "label_dimension": _with(_LABELS) + "SELECT code_column, code, libelle, source FROM dim",
    "label_lookup": _with(_BASE, _TYPED, _LABELS)
    + "SELECT c.code, l.libelle FROM (SELECT DISTINCT nature_prestation AS code FROM silver) c "
    "LEFT JOIN (SELECT code, libelle FROM dim WHERE code_column = 'service_code') l ON l.code = c.code",
    "label_coverage": _with(_BASE, _TYPED, _LABELS, _CODE_COUNTS)
    + """SELECT code_column, CAST(lignes AS BIGINT) AS lignes, CAST(lignes_libellees AS BIGINT) AS lignes_libellees,
  CAST(codes AS BIGINT) AS codes, CAST(codes_sans_libelle AS BIGINT) AS codes_sans_libelle,
  """
    + _ratio("lignes_libellees", "lignes")
    + """ AS couverture
FROM (
  SELECT c.code_column, sum(c.lignes) AS lignes,
    coalesce(sum(CASE WHEN d.code IS NOT NULL THEN c.lignes END), 0) AS lignes_libellees,
    count(*) AS codes, count(*) FILTER (WHERE d.code IS NULL) AS codes_sans_libelle
  FROM codes c LEFT JOIN dim d ON d.code_column = c.code_column AND d.code = c.code
  GROUP BY c.code_column)""",
    "missing_labels": _with(_BASE, _TYPED, _LABELS, _CODE_COUNTS)
    + "SELECT c.code_column, c.code, c.lignes FROM codes c LEFT JOIN dim d "
    "ON d.code_column = c.code_column AND d.code = c.code WHERE d.code IS NULL",
    "gold_month_audit": _with(_BASE, _TYPED, _LABELS, _CODE_COUNTS)
    + "SELECT c.code_column, c.code, c.lignes, count(*) OVER () AS reported FROM codes c LEFT JOIN dim d "
    "ON d.code_column = c.code_column AND d.code = c.code WHERE d.code IS NULL",
    "stg_spend": _ALL
    + "SELECT mois_traitement, nature_prestation, region_residence_beneficiaire, montant_depense, "
    "base_remboursement, montant_rembourse, montant_depassement FROM silver",
    "spend_by_service": _GOLD + "SELECT * FROM svc",
    "spend_by_region": _GOLD + "SELECT * FROM reg",
    "top_services": _GOLD
    + """SELECT mois_traitement, rang, nature_prestation, libelle_nature_prestation, montant_depense FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY mois_traitement
    ORDER BY montant_depense DESC NULLS LAST, nature_prestation) AS INTEGER) AS rang FROM svc)
WHERE rang <= 5""",
    "ratio": _ALL
    + f"""SELECT famille, numerateur, denominateur, {_ratio('numerateur', 'denominateur')} AS ratio, count(*) AS lignes
FROM (
  SELECT 'rembourse_sur_depense' AS famille, montant_rembourse AS numerateur, montant_depense AS denominateur FROM silver
  UNION ALL SELECT 'depassement_decale', montant_depassement,
    CAST(montant_depassement - CAST(0.04 AS DECIMAL(18,2)) AS DECIMAL(18,2)) FROM silver
) GROUP BY 1, 2, 3""",
    "unique_grain": _with(_BASE) + "SELECT k, count(*) AS occurrences FROM fx GROUP BY k HAVING count(*) > 1",
    "totals_match": _GOLD
    + " UNION ALL ".join(
        [
            *(
                _totals_diff(mart, column, f"{name}:{column}")
                for name, mart in (("service", "svc"), ("region", "reg"))
                for column in ("montant_depense", "montant_rembourse")
            ),
            _totals_diff(
                "(SELECT * FROM svc WHERE mois_traitement IS NULL OR mois_traitement < (SELECT max(mois_traitement) FROM silver))",
                "montant_depense",
                "service_latest_month_dropped:montant_depense",
            ),
        ]
    ),
    "not_null_checks": _GOLD
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _not_null("stg_depenses", "silver", [("mois_traitement", "error"), ("montant_depense", "error")]),
            _not_null(
                "depenses_par_prestation", "svc",
                [("mois_traitement", "error"), ("nature_prestation", "error"),
                 ("montant_depense", "error"), ("montant_rembourse", "error"),
                 ("libelle_nature_prestation", "warn")],
            ),
            _not_null(
                "depenses_par_region", "reg",
                [("mois_traitement", "error"), ("region_residence_beneficiaire", "error"),
                 ("montant_depense", "error"), ("montant_rembourse", "error"),
                 ("libelle_region_residence_beneficiaire", "warn")],
            ),
        ]
    )
    + ") WHERE null_rows > 0",
    "table_parity": _ALL
    + f"""SELECT {_BUSINESS}, 'left_only' AS side FROM (
  SELECT {_BUSINESS} FROM typed EXCEPT ALL SELECT {_BUSINESS} FROM silver)
UNION ALL SELECT {_BUSINESS}, 'right_only' FROM (
  SELECT {_BUSINESS} FROM silver EXCEPT ALL SELECT {_BUSINESS} FROM typed)""",
    "table_parity_by_month": _ALL.rstrip()
    + f""", changed AS (SELECT * REPLACE (CASE WHEN mois_traitement = DATE '1995-03-01' THEN -montant_depense
  ELSE montant_depense END AS montant_depense) FROM silver)
SELECT {_BUSINESS}, 'left_only' AS side FROM (
  SELECT {_BUSINESS} FROM changed EXCEPT ALL SELECT {_BUSINESS} FROM silver)
UNION ALL SELECT {_BUSINESS}, 'right_only' FROM (
  SELECT {_BUSINESS} FROM silver EXCEPT ALL SELECT {_BUSINESS} FROM changed)""",
    "bronze_header_order": _with(_BASE) + f"SELECT {_RAW}, _year_month FROM fx",
    "bronze_repeated_month": _with(_BASE)
    + "SELECT _year_month, count(*) AS lignes FROM fx GROUP BY _year_month",
    "bronze_odd_template": _with(_BASE)
    + "SELECT 'A ' || left(_year_month, 4) || ' 100%25 ' || right(_year_month, 2) || '.csv.gz' AS _source_file, "
    "_year_month, count(*) AS lignes FROM fx GROUP BY ALL",
    "bronze_gzip_parallel": _with(_BASE)
    + f"SELECT {_RAW}, 'A' || _year_month || '.csv.gz' AS _source_file, _year_month FROM fx",
    "empty_month_guard": _with(_BASE)
    + """SELECT m AS mois_absent, false AS ecrit FROM (
  SELECT DISTINCT left(_year_month, 4) || lpad(CAST(n AS VARCHAR), 2, '0') AS m FROM fx, range(1, 13) t(n))
WHERE m NOT IN (SELECT _year_month FROM fx)""",
    "code_list_scan": f"""SELECT code, arg_min(libelle, p_partkey) AS libelle FROM (
  SELECT {_norm('trim(p_type)')} AS code, p_partkey,
    {_clean("(p_name || ' \"ref; ' || CAST(p_partkey AS VARCHAR) || '\"')")} AS libelle FROM part)
GROUP BY code""",
    "lexicon_scan": f"SELECT CAST(n_nationkey AS VARCHAR) AS code, {_clean('lower(n_name)')} AS libelle FROM nation",
    "label_complement_last_wins": "SELECT 'service_code' AS code_column, CAST(s_suppkey AS VARCHAR) AS code, "
    "s_name || ' 1' AS libelle, 'supplier' AS justification FROM supplier",
    "label_dimension_checks": _with(_LABELS)
    + """SELECT variant, problem, code_column, code, rows FROM (
  SELECT 'stored' AS variant, 'absent' AS problem, 'status_code' AS code_column, CAST(NULL AS VARCHAR) AS code, CAST(0 AS BIGINT) AS rows
  WHERE NOT EXISTS (SELECT * FROM dim WHERE code_column = 'status_code')
  UNION ALL SELECT 'spoilt', 'absent', 'status_code', NULL, 0 WHERE NOT EXISTS (SELECT * FROM dim WHERE code_column = 'status_code')
  UNION ALL SELECT 'spoilt', 'blank', 'service_code', p_type, 1 FROM (SELECT DISTINCT p_type FROM part)
  UNION ALL SELECT 'spoilt', 'repeated', 'service_code', code, 2 FROM dim
  WHERE code_column = 'service_code' AND code IN (SELECT p_type FROM part))""",
    "gold_build_service": _GOLD + f"SELECT *, {_STORED} FROM svc",
    "gold_build_region": _GOLD + f"SELECT *, {_STORED} FROM reg",
    "gold_month_rebuild": _GOLD
    + f"""SELECT 'depenses_par_prestation' AS mart, mois_traitement, nature_prestation AS code, nombre_lignes,
  montant_depense, taux_remboursement_effectif, {_STORED} FROM svc
UNION ALL SELECT 'depenses_par_region', mois_traitement, region_residence_beneficiaire, nombre_lignes,
  montant_depense, taux_remboursement_effectif, {_STORED} FROM reg""",
    "gold_from_catalog": _ALL
    + """SELECT source, mois_traitement, count(*) AS lignes,
  CAST(sum(montant_depense) AS DECIMAL(28,2)) AS montant
FROM silver, (VALUES ('stg_depenses'), ('depenses_par_prestation'), ('depenses_par_region')) AS s(source)
GROUP BY source, mois_traitement""",
    "refused_months": _with(_BASE)
    + """SELECT DISTINCT texte, NOT regexp_full_match(texte, '[0-9]{4}(0[1-9]|1[0-2])') AS refuse, false AS ecrit FROM (
  SELECT unnest([_year_month, left(_year_month, 4) || '-' || right(_year_month, 2), left(_year_month, 4) || '13',
    left(_year_month, 4) || CAST(CAST(right(_year_month, 2) AS INTEGER) AS VARCHAR)]) AS texte FROM fx)""",
    "claims_dimension": f"""WITH map(code_column, priority, kind, file) AS (VALUES {_MAP_ROWS}),
offered AS (
  SELECT code_column, priority, CAST(s_suppkey AS VARCHAR) AS code, file || ' ' || s_name || ' 0' AS libelle,
    'code list ' || file AS source FROM map, supplier WHERE kind = 'list'
  UNION ALL SELECT code_column, priority, CAST(n_nationkey AS VARCHAR), file || ' ' || n_name || ' 1', 'lexicon'
  FROM map, nation WHERE kind = 'sheet')
SELECT code_column, code, arg_min(libelle, priority) AS libelle, arg_min(source, priority) AS source
FROM offered GROUP BY code_column, code
UNION ALL SELECT 'TOP_PS5_TRG', CAST(r_regionkey AS VARCHAR), r_name, 'Complément du projet' FROM region""",
    "clustered_read": _ALL
    + f"SELECT {_BUSINESS}, _year_month FROM silver WHERE nature_prestation = 'PROMO' "
    "AND region_residence_beneficiaire BETWEEN '1' AND '19'",
    "source_profile_merged": _ALL
    + "SELECT colonne, lignes, vides, CAST(non_convertibles AS BIGINT) AS non_convertibles, "
    "CAST(texte_frequent AS VARCHAR) AS texte_frequent, CAST(lignes_texte AS BIGINT) AS lignes_texte, "
    "true AS distincts_proches FROM ("
    + " UNION ALL ".join(_column_profile(c) for c in _RAW.split(", "))
    + ")",
    "gold_checks": _with(_BASE, _TYPED, _LABELS, _SERVICE, _REGION, _CODE_COUNTS) + " UNION ALL ".join(_CHECK_COUNTS),
}
