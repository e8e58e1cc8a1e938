"""Joins, unions and aggregates with the null and skew rules the plans need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 64


def union_stores(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Stack one feed per store, tagged with the store name; missing columns become NULL."""
    tagged = [df.withColumn("store", F.lit(name)) for name, df in feeds.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a frame lacks become NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def left_join_sparse(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that is often NULL on the left.

    NULL keys never match, yet would all land in one partition. They are spread over
    `NULL_SPREAD` values of a helper column that is 0 for every real key.
    """
    spare = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*left.columns), F.lit(NULL_SPREAD)).cast("int")).otherwise(0)
    # Always 0, but not a literal: a literal would be folded away and leave the key alone.
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
    return (
        left.withColumn("_spread", spare)
        .join(right.withColumn("_spread", zero), [key, "_spread"], "left")
        .drop("_spread")
    )


def most_common(df: DataFrame, key: str, columns: Mapping[str, str], where=None) -> DataFrame:
    """Most common value of each column per key (`{output: column}`); ties take the lowest, NULL counts.

    Values are counted per (key, column, value) before one value per column is picked, so a
    key with many rows is reduced in every map task and never gathered. `where` maps an output
    to a condition its rows must meet.
    """
    where = where or {}
    cells = [
        F.struct(F.lit(out).alias("output"), F.col(c).alias("value"), where.get(out, F.lit(True)).alias("keep"))
        for out, c in columns.items()
    ]
    counts = (
        df.select(key, F.explode(F.array(*cells)).alias("cell"))
        .filter("cell.keep")
        .groupBy(key, F.col("cell.output").alias("output"), F.col("cell.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    rank = F.struct(-F.col("n"), F.col("value"))
    return counts.groupBy(key).agg(
        *[F.min_by("value", F.when(F.col("output") == out, rank)).alias(out) for out in columns]
    )


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def distinct_counts(df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Exact distinct count per key of each value (`{output: value}`); NULLs are not counted.

    Only (key, output, value) travels, once per non-null value, instead of the whole row once per
    count; duplicates fall away before the shuffle, and a hot key is spread over its values.
    """
    cells = [F.struct(F.lit(i).alias("output"), v.cast("string").alias("value")) for i, v in enumerate(values.values())]
    seen = (
        df.select(*keys, F.explode(F.array(*cells)).alias("cell")).filter(F.col("cell.value").isNotNull())
        .select(*keys, "cell.output", "cell.value").distinct()
    )
    return seen.groupBy(*keys).agg(*[F.count_if(F.col("output") == i).alias(n) for i, n in enumerate(values)])
