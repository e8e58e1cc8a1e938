import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoploom.llm import language
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"


def plain_fusion(pages, names, logs):
    """(lang, score) of pages (url, html) by sums over all pages, without Spark."""
    rows = []
    for url, html in pages:
        at = (url or "").split("://", 1)
        host = re.split("[/?#]", at[1])[0].lower() if len(at) == 2 else ""
        path = re.split("[?#]", at[1][len(host) :])[0].lower() if len(at) == 2 else ""
        codes = [x for x in path.split("/")[1:-1] if re.fullmatch("[a-z]{2}", x)]
        suffix, domain = host.split(".")[-1], ".".join(host.split(".")[-2:])
        declared = re.search(r'<html lang="([a-z]+)', html or "")
        p = language.posterior(logs, language.main_text(language.parse(html or "")))
        rows.append((host, domain, suffix, declared[1] if declared else "", codes[0] if codes else suffix, p))
    sums = [defaultdict(lambda: np.zeros(len(names))) for _ in range(5)]
    for r in rows:
        for k in range(5):
            sums[k][r[k]] += r[5]
    total = sum(r[5] for r in rows)
    world = (total + 1) / (len(rows) + len(names))
    w = language.PRIOR_PAGES
    out = []
    for host, domain, suffix, declared, code, p in rows:
        by_suffix = (sums[2][suffix] + w * world) / (sums[2][suffix].sum() + w)
        by_domain = (sums[1][domain] + w * by_suffix) / (sums[1][domain].sum() + w)
        found = np.log(p + 1e-12) + np.log(np.maximum(sums[0][host] - p, 0) + w * by_domain)
        for k, value in ((3, declared), (4, code)):
            found += np.log((sums[k][value] + language.ADDED) / (total + language.ADDED * (len(sums[k]) + 1)))
        out.append((names[int(found.argmax())], 1 / np.exp(found - found.max()).sum()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return language.text_model(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_text_model(spark):
    docs = [("aa bb", "en"), ("aa", "en"), ("cc", " FR "), (None, "fr"), ("zz", None), ("", "de")]
    names, logs = language.text_model(spark.createDataFrame(docs, "text string, lang string"))
    assert names == ["en", "fr"] and np.exp(logs).sum(axis=0) == pytest.approx(1)
    assert language.posterior(logs, "cc cc").argmax() == 1 and language.posterior(logs, "") == pytest.approx(1 / 2)


PAGES = [
    (None, None), ("", ""), ("http://a.de/x", '<html lang="de"><p>der und die das ist'), ("http://a.de/y", "<p>"), ("http://b.org/fr/1", '<html lang="fr"><p>le la de des'),
    ("http://b.org/fr/2", "<p>the of and"), ("http://b.org/es/3", '<html lang="zz">'), ("http://c.b.org/en/", "<p>" + "the of and to " * 20_000), ("http://a.de/x", '<html lang="de"><p>der und die das ist'),
]


def test_against_plain_sums(spark, model):
    df = spark.createDataFrame([(k, u, h, "mine") for k, (u, h) in enumerate(PAGES)], "page_id long, url string, html string, lang string").repartition(3)
    found = {r.page_id: r for r in language.fused(df, model).collect()}
    assert len(found) == len(PAGES)
    for k, (lang, score) in enumerate(plain_fusion(PAGES, *model)):
        assert found[k].lang == lang and found[k].score == pytest.approx(score)


def test_codes_in_long_addresses(spark):
    urls = {
        "http://a.de/" + "x/" * 100_000: "de", "http://a.de/" + "xyz/" * 100_000 + "FR/": "fr", "http://a.de/fr": "de", "http://a.de/fr/en/": "fr",
        "http://a.de/fr?/en/": "de", "http://a.de": "de", "http://a.de/f1/é1/it/": "it", "http://a.de//es/": "es", "no": "", "": "",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", language.address_code(F.col("url")).alias("code"))
    assert {r.url: r.code for r in df.collect()} == urls


def test_many_languages_are_pooled(spark):
    docs = [(f"t{k:03d} " * (400 - k), f"l{k}") for k in range(300)] + [("big " * 500, "other")]
    names, logs = language.text_model(spark.createDataFrame(docs, "text string, lang string"), most=50)
    assert names == sorted(["other", *[f"l{k}" for k in range(49)]]) and logs.shape[1] == 50
    assert np.exp(logs).sum(axis=0) == pytest.approx(1)
    names, logs = language.text_model(spark.createDataFrame(docs, "text string, lang string"))
    assert len(names) == 200 and language.posterior(logs, "t299 " * 9).argmax() == names.index("other")


def test_empty_and_untrained(spark):
    nothing = spark.createDataFrame([], "text string, lang string")
    untrained = language.text_model(nothing)
    pages = spark.createDataFrame([(1, "http://a.b/", "x")], "page_id long, url string, html string")
    assert language.fused(pages.limit(0), untrained).count() == 0
    assert language.fused(pages, untrained).first().lang == "und"


def test_query(spark):
    found = queries()["op1_language_id"](spark, FOLDER).collect()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(found) == len(pages)
    by_path = Counter(r.lang == r.address for r in found)
    assert by_path[True] > 0.95 * len(found)
    assert all(0 < r.score <= 1 and not math.isnan(r.score) for r in found)
