"""Rules and host reputation."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import url_filter as op

PAGES = "page_id bigint, url string, host string, rule int"
LABELS = "doc_id bigint, quality int, toxic int, host string"

CASES = [
    ("http://Shop.Example.NET/en/x?q#f", "shop.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("https://a.example.com/de/1", "a.example.com", "/de/1", "example.com/de/", "block"),
    ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("https://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("ftp://ÄB.org", "Äb.org", "", None, "allow"),
    ("x://y.net?a/b", "y.net", "", None, "allow"),
    ("x://y.net", "y.net", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("://net/x", "net", "/x", "net/", "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "z", 1) for i, c in enumerate(CASES)], PAGES)
    labels = spark.createDataFrame([], LABELS)
    got = {r.page_id: r for r in op.filter_urls(pages, labels).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)


def test_reputation_shrinks_and_blocks(spark):
    urls = ["http://bad.site.com/a"] * 60 + ["http://good.site.com/a"] * 60 + ["http://new.site.com/a"] * 2
    pages = spark.createDataFrame([(i, u, "z", 1) for i, u in enumerate(urls)] + [(None, urls[0], "z", 1)], PAGES)
    marks = [(i, 0 if i < 60 else 1, 0, "h") for i in range(120)] + [(None, 0, 0, "h"), (5, None, None, "h")]
    got = op.filter_urls(pages, spark.createDataFrame(marks, LABELS)).collect()
    assert len(got) == len(urls) + 1
    by_host = {r.host: r.verdict for r in got}
    assert by_host == {"bad.site.com": "block", "good.site.com": "allow", "new.site.com": "allow"}


def test_posterior_by_hand(spark):
    hosts = [("a.x.com", 10, 9), ("b.x.com", 10, 1), ("c.y.com", 0, 0), ("d.z.org", 4, 4)]
    got = {
        r["host"]: r["rate"]
        for r in op.host_reputation(spark.createDataFrame(hosts, "host string, n bigint, bad bigint")).collect()
    }
    rates = {(): 14.5 / 25}
    rows = {tuple(h.split(".")): (n, k) for h, n, k in hosts}
    for depth in (1, 2, 3):
        level = {}
        for h, (n, k) in rows.items():
            a, b = level.get(h[-depth:], (0, 0))
            level[h[-depth:]] = (a + n, b + k)
        parent = {h: rates[h[1:] if depth > 1 else ()] for h in level}
        over = sum((k - n * parent[h]) ** 2 - n * parent[h] * (1 - parent[h]) for h, (n, k) in level.items())
        room = sum(n * (n - 1) * parent[h] * (1 - parent[h]) for h, (n, _) in level.items())
        rho = min(max(over / room, op.LEAST_RHO), op.MOST_RHO)
        s = (1 - rho) / rho
        rates.update({h: (k + s * parent[h]) / (n + s) for h, (n, k) in level.items()})
    for host, rate in got.items():
        assert rate == pytest.approx(rates[tuple(host.split("."))])


def test_empty_table(spark):
    assert op.filter_urls(spark.createDataFrame([], PAGES), spark.createDataFrame([], LABELS)).collect() == []


def test_own_outcome(spark):
    pages = spark.createDataFrame([(1, "http://q.com/", "z", 1)], PAGES)
    labels = spark.createDataFrame([(1, 1, 1, "h")], LABELS)
    assert op.filter_urls(pages, labels, bad=F.lit(False), max_bad=0.0, z=0.0).first().verdict == "block"
