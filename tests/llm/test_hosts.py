import re

import pytest
from compare import difference, duck

from shoploom.llm import checks, hosts
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG", "http://a.example.org/", "https://example.org/es/x", "http://x.example.org/en/12?q#f",
    "http://example.org/en/2", "ftp://b.com/fr/1", "http://b.com/de/1?x=/fr/", "http://b.com/dex", "http://notcom/de/", "http://com/de/", "http://q.net?x://y",
    "http://ÉX.Com/de/\n2", "a\nb://h.org/\n", "http://h.org#/x", "://x.org/y/z#", "http://" + "a" * 100_000 + ".org/",
]


def plain(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3 :]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in RULES:
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path) and (not best or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best and best[1], best and best[0]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(URLS)] * 2, "page_id long, url string, host string")
    found = hosts.judged(pages, spark.createDataFrame([], "host string, bad int")).collect()
    assert len(found) == 2 * len(URLS)
    for r in found:
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")


def test_levels_share_evidence(spark):
    rows = [("bad.a.net", 1)] * 30 + [("good.a.net", 0)] * 200 + [("new.b.net", None)] + [("few.c.net", 1)] * 2 + [("big.d.net", 0)] * 900
    found = {r.host: r for r in hosts.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert len(found) == 5
    assert found["bad.a.net"].bound > 0.5 > found["few.c.net"].bound
    assert 0 < found["new.b.net"].host_rate < 0.5 and found["good.a.net"].host_rate < 0.1
    assert (found["few.c.net"].domain, found["few.c.net"].suffix) == ("c.net", "net")


@pytest.mark.parametrize("host, domain, suffix", [("", "", ""), ("x", "x", "x"), ("a.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("a.b.c", "b.c", "c")])
def test_domains(spark, host, domain, suffix):
    r = hosts.reputations(spark.createDataFrame([(host, 1)], "host string, bad int")).first()
    assert (r.domain, r.suffix) == (domain, suffix)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert hosts.judged(none, hosts.document_outcomes(none, labels)).count() == 0


def test_query_against_sql(spark):
    found = queries()["op3_url_filters"](spark, FOLDER)
    assert difference(found, duck(FOLDER), checks.SQL["op3_url_filters"]) is None
    assert {r[0] for r in found.select("verdict").distinct().collect()} == {"allow", "block"}
