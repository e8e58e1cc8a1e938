"""Window helpers: newest row, running totals that survive hot keys, lags and frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_per(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `newest_first`.

    A rank filter, so Spark keeps one row per key and map task before the shuffle and a key
    with many copies does not travel whole.
    """
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest_first])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def running_totals(
    df: DataFrame,
    key: str,
    step: str,
    order: Sequence[str],
    totals: Mapping[str, Column],
    first: Mapping[str, Column] | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Running sums per `key` in `order`, plus minima over the whole key (`first`).

    `step` must never decrease along `order` (here: the day of the time stamp). Sums per
    (key, step) are taken first and carried forward over steps; rows then only need a window
    inside their own (key, step). A key holding a large part of all rows is thus spread over
    its steps instead of being sorted in one task.

    `beside` holds further columns, one row per key: they are joined to the narrow carried sums,
    so the wide rows are never shuffled by the key alone.
    """
    names, first = list(totals), first or {}
    per_step = df.groupBy(key, step).agg(
        *[F.sum(c).alias(f"_step_{n}") for n, c in totals.items()],
        *[F.min(c).alias(f"_step_{n}") for n, c in first.items()],
    )
    before = W.partitionBy(key).orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    carried = per_step.select(
        key, step,
        *[F.sum(f"_step_{n}").over(before).alias(f"_before_{n}") for n in names],
        *[F.min(f"_step_{n}").over(W.partitionBy(key)).alias(n) for n in first],
    )
    if beside is not None:
        carried = carried.join(beside, key, "left")
    inside = W.partitionBy(key, step).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = df.join(carried, [key, step])
    return joined.withColumns(
        {n: F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + F.sum(c).over(inside) for n, c in totals.items()}
    ).drop(*[f"_before_{n}" for n in names])


def trailing(column: str, w, rows: int) -> Column:
    """Sum over the current row and the `rows - 1` before it."""
    return F.sum(column).over(w.rowsBetween(1 - rows, 0))


def prior(column: str, w, rows: int) -> Column:
    """Sum over the `rows` rows that precede the trailing frame of the same length."""
    return F.sum(column).over(w.rowsBetween(1 - 2 * rows, -rows))


def same_week_last_year(column: str) -> Column:
    """Value of the same ISO week one year earlier, on rows unique by (iso_year, iso_week).

    A lag over the years of one week number replaces the self-join.
    """
    w = W.partitionBy("iso_week").orderBy("iso_year")
    return F.when(F.lag("iso_year").over(w) == F.col("iso_year") - 1, F.lag(column).over(w))
