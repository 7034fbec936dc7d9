"""Operator 2: url filter by host reputation, with explicit rules before it.

Labelled page outcomes are counted by host and rolled up to registered domain and suffix. Going
down from the whole table, each level's rate is the posterior mean of a beta-binomial whose prior
is its parent's rate; the prior's strength is estimated from the spread of the children around
their parents (method of moments). A host is blocked when the lower bound of its rate of bad
pages, ``mean - z * sd`` of its Beta posterior, lies above ``max_bad``. Only counts by host are
shuffled, pre-aggregated, so a hot host is one row of each task.

A host's suffix is its last label, its registered domain the last two.

Cases: a null url, or one without ``://``, has an empty host and path and is judged by the empty
host's reputation; pages without a label count in no outcome; a page labelled twice counts twice;
null and repeated page ids are carried as they are; with no labels at all every rate is one half
and nothing is blocked; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialize

# --- Fixed values: the rules -----------------------------------------------------------------
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# --- end of fixed values ---------------------------------------------------------------------
Z = 1.645  # one-sided 95 %
MAX_BAD = 0.3
LEVELS = ("suffix", "domain", "host")
LEAST_RHO, MOST_RHO = 1e-4, 0.5


def host_of(url: Column) -> Column:
    return F.translate(_after_scheme(url, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return _after_scheme(url, 2)


def _after_scheme(url: Column, group: int) -> Column:
    rest = F.substring_index(url, "://", 1)  # up to the first one
    tail = F.substring(url, F.length(rest) + 4, F.length(url))
    found = F.regexp_extract(tail, r"^([^/?#]*)([^?#]*)", group)
    return F.when(F.contains(url, F.lit("://")), found).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes``: (host, n, bad), one row for each host. Returns (host, rate, low): the
    posterior mean and lower bound of each host's rate of bad pages."""
    hosts = materialize(
        outcomes.select(
            "host",
            F.substring_index("host", ".", -1).alias("suffix"),
            F.substring_index("host", ".", -2).alias("domain"),
            F.col("n").cast("double"),
            F.col("bad").cast("double"),
        ),
        "host-outcomes",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    prior = F.lit(((total["bad"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1.0))
    parents = None
    for depth, level in enumerate(LEVELS):
        above = LEVELS[depth - 1] if depth else None
        keys = [level, above] if above else [level]
        rows = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parents is None:
            rows = rows.withColumn("p", prior)
        else:
            rows = rows.join(parents.select(above, F.col("rate").alias("p")), above)
        # beta-binomial: E (bad - n p)^2 = n p (1 - p) (1 + (n - 1) rho)
        var = F.col("p") * (1 - F.col("p"))
        spread = rows.agg(
            F.sum(F.pow(F.col("bad") - F.col("n") * F.col("p"), 2) - F.col("n") * var).alias("over"),
            F.sum(F.col("n") * (F.col("n") - 1) * var).alias("room"),
        ).first()
        rho = (spread["over"] or 0.0) / spread["room"] if spread["room"] else MOST_RHO
        rho = min(max(rho, LEAST_RHO), MOST_RHO)
        strength = (1 - rho) / rho
        a = F.col("bad") + strength * F.col("p")
        b = F.col("n") - F.col("bad") + strength * (1 - F.col("p"))
        parents = rows.select(level, a.alias("a"), b.alias("b"), (a / (a + b)).alias("rate"))
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("a") + F.col("b") + 1))
    return parents.select("host", "rate", (F.col("rate") - z * sd).alias("low"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    bad: Column | None = None,
    rules=RULES,
    z: float = Z,
    max_bad: float = MAX_BAD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``labels`` judges pages by their id;
    ``bad`` is the condition of a bad outcome (default: low quality or toxic)."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1) if bad is None else bad
    url = F.col(url_col).cast("string")
    judged = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    marks = labels.select(F.col(label_id).alias("_labelled"), bad.alias("_bad")).where("_bad is not null")
    outcomes = (
        judged.join(marks, F.col("page_id") == F.col("_labelled"), "left")
        .groupBy("host")
        .agg(F.count("_bad").alias("n"), F.count(F.when(F.col("_bad"), 1)).alias("bad"))
    )
    known = materialize(host_reputation(outcomes, z), "host-reputation")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    return judged.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(F.col("low") > max_bad, "block").otherwise("allow")).alias("verdict"),
    )


def _rates_sql(level: str, above: str | None) -> str:
    if above is None:
        source = f"SELECT {level}, sum(n) n, sum(bad) bad FROM hosts GROUP BY {level}"
        rows = f"SELECT x.*, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) FROM hosts) p FROM ({source}) x"
    else:
        source = f"SELECT {level}, {above}, sum(n) n, sum(bad) bad FROM hosts GROUP BY {level}, {above}"
        rows = f"SELECT x.*, r.rate p FROM ({source}) x JOIN {above}_rate r USING ({above})"
    return f"""
{level}_rows AS ({rows}),
{level}_rho AS (
  SELECT least(greatest(CASE WHEN coalesce(room, 0) = 0 THEN {MOST_RHO} ELSE above / room END, {LEAST_RHO}), {MOST_RHO})::DOUBLE rho
  FROM (SELECT sum(pow(bad - n * p, 2) - n * p * (1 - p)) above, sum(n * (n - 1) * p * (1 - p)) room FROM {level}_rows)),
{level}_rate AS (
  SELECT {level}, a, b, a / (a + b) rate FROM (
    SELECT {level}, bad + (1 - rho) / rho * p a, n - bad + (1 - rho) / rho * (1 - p) b FROM {level}_rows, {level}_rho))"""


def _rule_case(part: str) -> str:
    whens = []
    for says, text in sorted(RULES, key=lambda r: -len(r[1])):
        domain, slash, rest = text.partition("/")
        whens.append(
            f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + rest}')"
            f" THEN '{text if part == 'rule' else says}'"
        )
    return "CASE " + " ".join(whens)


SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END tail FROM pages),
judged AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(tail, '^([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') host,
    coalesce(regexp_extract(tail, '^[^/?#]*([^?#]*)', 1), '') path
  FROM cut),
marks AS (SELECT doc_id, (quality = 0 OR toxic = 1) bad FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL),
hosts AS (
  SELECT host, list_extract(string_split(host, '.'), -1) suffix,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
    count(bad)::DOUBLE n, (count(*) FILTER (WHERE bad))::DOUBLE bad
  FROM judged LEFT JOIN marks ON page_id = doc_id GROUP BY host),
{_rates_sql('suffix', None)},
{_rates_sql('domain', 'suffix')},
{_rates_sql('host', 'domain')},
known AS (SELECT host, rate - {Z} * sqrt(rate * (1 - rate) / (a + b + 1)) low FROM host_rate)
SELECT page_id, host, path, {_rule_case('rule')} END AS rule,
  {_rule_case('verdict')} ELSE CASE WHEN low > {MAX_BAD} THEN 'block' ELSE 'allow' END END AS verdict
FROM judged LEFT JOIN known USING (host)
"""
