import random
from collections import defaultdict

import pytest
from compare import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoploom.llm import checks, mixing
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, size long, taken string, row int"


def plain_targets(sizes):
    """Shared by weight again and again until none is above; in fractions' stead exact enough in doubles."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in stopped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return stopped | share
        for s in above:
            stopped[s] = 2 * sizes[s]
            left -= stopped[s]


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 50), min_size=1, max_size=9))
def test_targets(spark, sizes):
    found = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = plain_targets(sizes)
    assert {r.source: r.target for r in found} == pytest.approx(want) and len(found) == len(sizes)


def rows(seed=3):
    r = random.Random(seed)
    out = [(i, r.choice(["hot", "hot", "hot", "a", "b", None, "ü"]), r.choice([0, 1, 5, 40, 300]), "mine", i) for i in range(400)]
    out += [(7, "hot", 12, None, 1)] * 90 + [(None, "b", 3, None, None)] * 60 + [(None, None, None, None, None)] * 5
    out += [(1000, "long", 5_000_000, None, 0), (1001, "empty", 0, None, 0), (1002, "empty", None, None, 0), (1003, "less", -4, None, 0)]
    return out


def test_budgets_are_met_to_the_word(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    mix = mixing.Mixture(df, "size")
    found = mix.taken().collect()
    assert len(found) == len(rows())
    by = defaultdict(list)
    for r in found:
        by[r.source].append(r)
        assert r.taken <= 2 * r.size and r.taken == r.epochs * r.size + r.cut
    sizes = {s: sum(max(0, x[2] or 0) for x in rows() if x[1] == s) for s in by}
    want = plain_targets(sizes)
    for s, got in by.items():
        assert {r.source_size for r in got} == {sizes[s]} and got[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in got) == int(got[0].target)
        assert sum(0 < r.cut < r.size for r in got) <= 1  # only one row is cut in two

    times = mix.rows().collect()
    assert set(times[0].asDict()) == {*df.columns, "epoch", "order_key", "units"}
    assert sum(t.units for t in times) == sum(r.taken for r in found)
    assert all(t.taken in ("mine", None) for t in times)


def test_reruns_agree_however_rows_are_dealt(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    columns = ["id", "source", "size", "target", "taken"]
    one = sorted(map(repr, mixing.Mixture(df.coalesce(1), "size").taken().select(columns).collect()))
    other = sorted(map(repr, mixing.Mixture(df.orderBy(F.rand(1)).repartition(5), "size").taken().select(columns).collect()))
    assert one == other
    some = df.where("source != 'long'")
    seeds = [sorted(map(repr, mixing.Mixture(some, "size", seed=k).taken().select(columns).collect())) for k in (0, 1)]
    assert seeds[0] != seeds[1]


def test_order_is_random(spark):
    """What the cut takes is spread over the ids."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"), F.lit(10).alias("size"))
    taken = mixing.Mixture(df, "size", weights=(1, 3), share=1.0).taken().where("source = 'a' and epochs = 0")
    early, late = taken.where("id < 1000").agg(F.sum("taken")).first()[0], taken.where("id >= 1000").agg(F.sum("taken")).first()[0]
    assert 0.85 < early / late < 1.18


def test_empty_and_all_empty(spark):
    assert mixing.Mixture(spark.createDataFrame([], SCHEMA), "size").taken().count() == 0
    none = mixing.Mixture(spark.createDataFrame([(1, None, None, None, None), (1, "a", 0, None, None)], SCHEMA), "size")
    assert {(r.taken, r.target, r.source_size) for r in none.taken().collect()} == {(0, 0.0, 0)} and none.rows().count() == 0


def test_words(spark):
    texts = [None, "", " \t\n", "a", " a  b\x0bc\x0cd\re ", " x  ", "\x1c \x85", "w " * 300_000, "w" * 1_000_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    found = [r.n for r in df.select("i", mixing.words("text").alias("n")).orderBy("i").collect()]
    assert found == [len((t or "").encode().split()) for t in texts]


def test_query_against_sql(spark):
    found = queries()["op11_mixing"](spark, FOLDER)
    assert difference(found, duck(FOLDER), checks.SQL["op11_mixing"]) is None
