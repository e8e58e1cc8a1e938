"""Frequent-items states: merged ones equal the whole, within the stated error."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoploom.operators import frequent
from shoploom.operators.relational import most_common

TRACKED = 64


@pytest.fixture(scope="module")
def rows(spark):
    """Many more values than a state tracks, some far more common than others, over thirty days."""
    r = random.Random(4)
    values = [None if (v := int(r.paretovariate(0.7))) % 11 == 3 else f"v{v}" for _ in range(40_000)]
    return spark.createDataFrame([(f"k{i % 3}", i % 30, v) for i, v in enumerate(values)], "k string, day int, v string").cache()


@pytest.mark.parametrize("by_day", [False, True])
def test_counts_stay_within_the_bound(rows, by_day):
    true = {k: Counter(r.v for r in rows.where(F.col("k") == k).collect()) for k in ("k0", "k1", "k2")}
    held = frequent.states(rows, ["k", "day"] if by_day else ["k"], {"s": "v"}, TRACKED)
    if by_day:
        held = frequent.merged(held, ["k"], ["s"], TRACKED)
    for r in held.select("k", frequent.items("s", TRACKED).alias("s"), F.length("s.sketch").alias("bytes")).collect():
        counts, bound = true[r.k], frequent.error_bound(sum(true[r.k].values()), TRACKED)
        assert len(counts) > 5 * TRACKED and 0 < len(r.s) <= TRACKED and r.bytes < 50 * TRACKED
        assert all(abs(x["count"] - counts[x["item"]]) <= bound for x in r.s)
        assert {v for v, n in counts.items() if n > bound} <= {x["item"] for x in r.s}
        assert counts.most_common(1)[0][0] == r.s[0]["item"]


def test_exact_while_values_are_few(spark, rows):
    few = rows.withColumn("v", F.when(F.length("v") < 4, F.col("v"))).withColumn("w", (F.col("v") == "v1").cast("string"))
    columns, where = {"usual": "v", "other": "w", "none": "v"}, {"usual": "v IS NOT NULL", "none": "k = 'k1'"}
    exact = most_common(few, "k", columns, {c: F.expr(w) for c, w in where.items()})
    found = frequent.usual_values(few, "k", columns, where, step="day", max_items=128)
    assert few.select("v").distinct().count() <= 128
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.select(found.columns).collect()))


def test_ties_and_empty(spark):
    df = spark.createDataFrame([("a", 1, x) for x in ("c", "b", "c", "b", "d")] + [("n", 1, None), ("n", 2, "z")], "k string, day int, v string")
    assert dict(frequent.usual_values(df, "k", {"u": "v"}, step="day").collect()) == {"a": "b", "n": None}
    assert frequent.usual_values(df.limit(0), "k", {"u": "v"}, step="day").count() == 0


def test_states_are_merged_before_the_shuffle(rows):
    plan = frequent.states(rows, ["k"], {"s": "v"}, TRACKED)._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k_accumulate" in plan.split("Exchange", 1)[1]


def test_usual_values_need_one_state_per_key(spark):
    """One state per key and map task travels, not one per key and day, and the items of a state are listed once."""
    df = spark.createDataFrame([("a", d, None if d % 3 == 0 else f"v{d % 2}") for d in range(40)] + [(None, 1, "z")], "k string, order_date int, v string")
    found = frequent.usual_values(df, "k", {"u": "v", "n": "v"}, {"u": "v IS NOT NULL"})
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, most_common(df, "k", {"u": "v", "n": "v"}, {"u": F.expr("v IS NOT NULL")}).select("k", "u", "n").collect()), key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "approx_top_k_combine" not in plan
    assert plan.count("approx_top_k_estimate") == 2
