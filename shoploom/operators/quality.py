"""Data checks. Each returns the violating rows or a small comparison table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null keys held by more than one row, with their count."""
    known = df.dropna(subset=list(columns))
    return known.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))


def relationship(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose non-null value has no parent."""
    child = df.filter(F.col(column).isNotNull())
    return child.join(parent.select(F.col(field).alias(column)).distinct(), column, "left_anti")


def violations(df: DataFrame, check: str, broken: Column) -> DataFrame:
    """One row: the check and how many rows break it."""
    return df.filter(broken).agg(F.count("*").alias("violations")).select(F.lit(check).alias("check_name"), "violations")


def compare(frames: Mapping[str, DataFrame], aggs: Sequence[Column], by: Sequence[Column] = ()) -> DataFrame:
    """The same aggregates for each named frame, stacked with its name in `source`."""
    parts = [df.groupBy(*by).agg(*aggs).withColumn("source", F.lit(name)) for name, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def within_tolerance(compared: DataFrame, metrics: Sequence[str], base: str, other: str, tolerance: float = 0.01) -> DataFrame:
    """Per metric: both values and whether they differ by less than `tolerance` of the base."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])).alias("m")
    wide = compared.select("source", pairs).groupBy("m.metric").agg(
        F.max(F.when(F.col("source") == base, F.col("m.value"))).alias("base_value"),
        F.max(F.when(F.col("source") == other, F.col("m.value"))).alias("other_value"),
    )
    gap = F.abs(F.col("base_value") - F.col("other_value"))
    return wide.withColumn("is_within", gap <= tolerance * F.abs("base_value"))
