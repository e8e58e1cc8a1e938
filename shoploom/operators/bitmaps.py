"""Exact distinct counts that merge: bitmaps per day, brought together to weeks, months or any other period.

Values get dense numbers once, from a dictionary found across ranges. A bitmap of 32,768 bits stands for one stretch of numbers,
so a day's values are a few binary rows. Periods are counted by joining these rows with OR: neither facts nor values are read again,
and a value seen on many days counts once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoploom.operators.ranges import Ranged
from shoploom.operators.relational import stack


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """value, number: a dense number from 0 for each distinct value that is not null, in the order of the values.

    Numbers come from counts per range: no task sees all values. Both tables are written on the way.
    """
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    return Ranged(values, [], ["value"]).running({"number": F.lit(1).cast("long")}).withColumn("number", F.col("number") - 1)


def states(df: DataFrame, keys: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """keys, bucket, bits: the values of `column` under each key, 32,768 numbers a row. Duplicates fall away before the shuffle."""
    pairs = df.select(*keys, F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    numbered = pairs.join(numbers, "value").withColumn("bucket", F.bitmap_bucket_number("number"))
    return numbered.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States under coarser keys."""
    return held.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(held: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """How many different values there are under each key; keys without any have no row."""
    return merged(held, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def distinct_by_period(df: DataFrame, day: str, columns: Mapping[str, str], periods: Mapping[str, str]) -> DataFrame:
    """grain, start and for each `{output: column}` the distinct values in each period; `periods`: {grain: SQL of its start}.

    States are made per day, once, and merged per period.
    """
    rows = []
    for output, column in columns.items():
        daily = states(df, [day], column, dictionary(df, column))
        for grain, start in periods.items():
            found = counts(daily.withColumn("start", F.expr(start)), ["start"])
            rows.append(found.select(F.lit(grain).alias("grain"), "start", F.lit(output).alias("output"), "n"))
    pick = [F.coalesce(F.sum(F.when(F.col("output") == o, F.col("n"))), F.lit(0)).alias(o) for o in columns]
    return stack(*rows).groupBy("grain", "start").agg(*pick)
