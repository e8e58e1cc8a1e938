import math
import random

import numpy as np
import pytest
from compare import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoploom.llm import checks, negatives
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, rid string, q int"


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 600), st.integers(0, 40), st.integers(0, 2**32))
def test_products_are_exact(dims, size, seed):
    """Also where scores need doubles or 64-bit integers, which stop at their limits."""
    r = np.random.default_rng(seed)
    a, b = (np.rint(r.uniform(-(2.0**size), 2.0**size, (n, dims))) for n in (3, 5))
    exact = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    bound = math.isqrt(max(sum(int(x) ** 2 for x in u) for u in a) * max(sum(int(x) ** 2 for x in u) for u in b)) + 1
    primes = negatives.primes_for(bound, dims)
    assert len(set(primes)) == len(primes) >= 3 and math.prod(primes) > 2 * bound
    found = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
    assert [[int(x) for x in u] for u in found] == [[max(-(2**63), min(2**63 - 1, x)) for x in u] for u in exact]


def plain(rows, positives=5, wanted=10):
    kept = []
    for i, (vec, v, label, *_) in enumerate(rows):
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, vec, (label + 1) % 10 if vec is not None and vec % 7 == 0 else label, [math.floor(256 * x) for x in v]))

    def dot(x, y):
        return sum(a * b for a, b in zip(x, y))  # noqa: B905  (the shorter one ends in zeros)

    def place(s, x):
        return -s, x[1] is None, x[1] or 0

    out = []
    for i, vec, label, q in kept:
        if vec is None or vec % 100:
            continue
        scored = [(dot(q, x[3]), x) for x in kept if x[0] != i]
        same = sorted((s for s in scored if s[1][2] == label), key=lambda s: place(*s))[:positives]
        for ps, p in same:
            near = sorted((s for s in scored if s[1][2] != label and 30 * ps <= 100 * s[0] <= 90 * ps), key=lambda s: place(*s))[:wanted]
            out += [(vec, p[1], k + 1, x[1], ps, s) for k, (s, x) in enumerate(near)]
    return sorted(map(repr, out))


def mined(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(repr(tuple(r)) for r in negatives.HardNegatives(df, F.col("vec_id") % 100 == 0, label=label).mined(**more).collect())


def rows(seed=1, n=900):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    out = []
    for i in range(n):
        label = r.choice([0, 0, 0, 1, 2, 3, 4])
        out.append((i, [c + r.gauss(0, 0.5) + 0.6 for c in centres[label]], label, "x", 1))
    return out


ODD = [
    (100, None, 1, None, None), (200, [1.0, None], 1, None, None), (300, [float("nan")] * 6, 2, None, None), (400, [float("inf"), 1.0], 2, None, None),
    (None, [0.5] * 6, 0, None, None), (None, [0.5] * 6, 3, None, None), (500, [], 1, None, None), (7, [0.25], None, None, None), (900, [0.1, 0.9], 0, None, None),
    (700, [0.0] * 6, 0, None, None), (9001, [3.0] * 9, 3, None, None),
]


def test_against_plain(spark, monkeypatch):
    """Nulls, unequal lengths, copies of one vector, repeated ids and rows, several blocks on both sides."""
    data = rows() + ODD + [(2000 + i % 40, [0.8, 0.7, 0.9, 0.2, 0.6, 0.4], i % 3, "copy", 2) for i in range(300)] + rows()[:150]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = plain(data)
    assert len(want) > 100 and mined(df) == want
    monkeypatch.setattr(negatives, "MOST_ANCHORS", 4)
    monkeypatch.setattr(negatives, "MOST_ROWS", 300)
    monkeypatch.setattr(negatives, "SLAB", (2, 64))
    assert mined(df) == want
    assert mined(df, positives=2, negatives=1) == plain(data, 2, 1)


def test_large_components(spark):
    """Scores beyond 2^52 stay exact."""
    data = [(i, [x * 3e5 for x in v], label, None, None) for i, v, label, *_ in rows(n=300)]
    assert mined(spark.createDataFrame(data, SCHEMA)) == plain(data)


def test_empty(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1, None, None), (100, [1.0], 1, None, None), (200, [], 2, None, None)], SCHEMA)) == []


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.1"])
def test_query_against_sql(spark, folder):
    found = queries()["op12_hard_negatives"](spark, folder)
    assert difference(found, duck(folder), checks.SQL["op12_hard_negatives"]) is None
    assert found.count() > 100
