import math
import random
import re
from collections import Counter

import pytest
from compare import difference, duck
from hypothesis import given
from hypothesis import strategies as st

from shoploom.llm import checks, lexical
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string, item_id string, score int", "item_id string, text string, rank int"


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(lexical.TERM, lower)


def plain(docs, items, k=50):
    split = [(d[0], terms(d[1])) for d in docs]
    n_docs, n_terms = sum(bool(t) for _, t in split), sum(len(t) for _, t in split)
    df = Counter(x for _, t in split for x in set(t))
    out = []
    for item, text, *_ in items:
        scored = []
        for doc, found in split:
            tf, score = Counter(found), 0
            if found:
                m = 50 + 50 * len(found) * n_docs // n_terms
                for t in set(terms(text)) & set(found):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return sorted(map(repr, out))


def found(spark, docs, items, k=50):
    df = lexical.ranked(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(repr(tuple(r)) for r in df.collect())


@given(st.text())
def test_terms(text):
    assert [x.decode() for words in lexical.terms_of(text.encode()) for x in words] == terms(text)


def test_long_texts_are_cut_between_terms():
    text = "".join(random.Random(1).choice(["ab", "é", " ", ",", "x" * 500_000]) for _ in range(60)) + "y" * 3_000_000
    assert [x.decode() for words in lexical.terms_of(text.encode()) for x in words] == terms(text)


WORDS = [f"w{i}" for i in range(120)] + ["Ünï", "naïve", "日本", "a1"]


def corpus(seed=1, n=700):
    r = random.Random(seed)

    def text():
        return r.choice([" ", ", ", "\n"]).join(r.choices(WORDS, [1 / (i + 1) for i in range(len(WORDS))], k=int(r.paretovariate(0.8)) + r.randrange(20)))

    docs = [(i, text(), "x", 1) for i in range(n)]
    docs += [(2000 + i % 70, "W3 w40 w41 copy Naïve", None, None) for i in range(150)]  # copies, some with the same id
    docs += [(None, "w3 w90", None, None), (None, None, None, None), (5000, None, None, None), (5001, "", None, None), (5002, " ,;\x00\x7f", None, None),
             (5003, "w100 " * 200_000, None, None), (-4, "w3", None, None)]
    items = [(f"i{i}", text(), 3) for i in range(12)]
    items += [("same", "w40 w41 w3", None)] * 2 + [("none", "nowhere found", None), (None, "w3", None), ("null", None, None), ("empty", "", None), ("upper", "ÜNÏ W3", None)]
    return docs, items


def test_against_plain(spark, monkeypatch):
    docs, items = corpus()
    want = plain(docs, items)
    assert found(spark, docs, items) == want
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 16)
    monkeypatch.setattr(lexical, "LEAST_ROWS", 4)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 60)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, 3) == plain(docs, items, 3)


def test_bounds_prune():
    """With a score to beat, most documents are never scored exactly, and the best are still found."""
    import numpy as np

    r = np.random.default_rng(1)
    n, v = 4000, 300
    sizes = r.integers(5, 30, n)
    term = np.concatenate([np.sort(r.choice(v, s, replace=False)) for s in sizes])
    impact = r.integers(1000, 900_000, len(term))
    at = np.repeat(np.arange(n), sizes)
    length = np.sqrt(np.bincount(at, weights=impact.astype(float) ** 2))
    weights = r.integers(1, 9000, v)
    query = np.sort(r.choice(v, 12, replace=False))
    scores = np.bincount(at, weights=np.where(np.isin(term, query), weights[term] * impact, 0)).astype(np.int64)
    best = np.argsort(-scores, kind="stable")[:10]
    held = lexical._Queries([query], weights, np.array([scores[best[-1]]]), 10)
    asked = []
    keep = held._keep
    held._keep = lambda q, s, i, u: (asked.append(len(s)), keep(q, s, i, u))
    held.search(np.arange(n), np.zeros(n, bool), length, sizes, term, impact)
    assert held.best[0][1].tolist() == best.tolist() and sum(asked) == 10


def test_empty(spark):
    docs, items = corpus(n=5)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [], []) == []


@pytest.mark.parametrize("folder", [FOLDER])
def test_query_against_sql(spark, folder):
    got = queries()["op13_lexical_search"](spark, folder)
    assert difference(got, duck(folder), checks.SQL["op13_lexical_search"]) is None
