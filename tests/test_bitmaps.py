"""Distinct counts by bitmaps against counting values."""

import pytest
from pyspark.sql import functions as F

from shoploom.operators import bitmaps


@pytest.fixture(scope="module")
def rows(spark):
    """Two days hold most rows; values beyond one bitmap; some values and days are null."""
    i = F.col("id")
    day = F.when(i % 50 == 0, None).otherwise(F.date_add(F.lit("2024-01-27").cast("date"), F.when(i % 3 > 0, i % 2).otherwise(i % 40).cast("int")))
    return spark.range(120_000).select(day.alias("d"), F.when(i % 7 > 0, F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(70_000)))).alias("v"), (i % 13).alias("w"))


def test_dictionary_is_dense(rows):
    numbers = bitmaps.dictionary(rows, "v")
    found = numbers.agg(F.count("*"), F.count_distinct("number"), F.min("number"), F.max("number"), F.count_distinct("value")).first()
    n = rows.select("v").distinct().count() - 1
    assert n > 1.5 * 32_768 and tuple(found) == (n, n, 0, n - 1, n)


def test_days_merge_to_periods(rows):
    periods = {"day": "d", "month": "trunc(d, 'month')", "all": "CAST(NULL AS DATE)"}
    found = bitmaps.distinct_by_period(rows, "d", {"values": "v", "others": "w"}, periods).collect()
    for grain, start in periods.items():
        want = rows.groupBy(F.expr(start).alias("start")).agg(F.count_distinct("v").alias("values"), F.count_distinct("w").alias("others")).collect()
        assert {(r.start, r.values, r.others) for r in found if r.grain == grain} == {tuple(r) for r in want}


def test_states_are_small_and_facts_are_not_expanded(rows):
    daily = bitmaps.states(rows, ["d"], "v", bitmaps.dictionary(rows, "v"))
    sizes = daily.agg(F.count("*"), F.max(F.length("bits"))).first()
    assert sizes[0] <= 42 * 3 and sizes[1] == 4096
    plan = bitmaps.counts(daily, ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_empty(rows):
    none = rows.limit(0)
    assert bitmaps.dictionary(none, "v").count() == 0
    assert bitmaps.distinct_by_period(none, "d", {"v": "v"}, {"day": "d"}).count() == 0
    nulls = rows.withColumn("v", F.lit(None).cast("string"))
    assert bitmaps.distinct_by_period(nulls, "d", {"v": "v"}, {"day": "d"}).count() == 0
