"""Most common values in bounded memory: mergeable frequent-items states next to the exact `relational.most_common`.

A state tracks at most `max_items` values of one column. States made per step (say, a day) are merged to weeks, months or the
whole without going back to the rows. While a state has seen no more than `max_items` different values its counts are exact;
beyond that each is off by `error_bound(rows, max_items)` at most, and every value more common than that is among them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ITEMS = 256


def error_bound(rows: int, max_items: int = MAX_ITEMS) -> float:
    """How far a count may be off after `rows` values: 3.5 rows over the size of the table, which is at least 4/3 of `max_items`."""
    return 3.5 * rows / (max_items * 4 / 3)


def states(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], max_items: int = MAX_ITEMS, where: Mapping[str, str] | None = None) -> DataFrame:
    """One state per key and output (`{output: column}`); partial states are merged in map tasks before the shuffle.

    `where` maps an output to a SQL condition that its rows must meet. Nulls are values like any other.
    """
    where = where or {}
    return df.groupBy(*keys).agg(*[
        F.expr(f"approx_top_k_accumulate(`{c}`, {max_items}) FILTER (WHERE {where.get(out, 'true')})").alias(out) for out, c in columns.items()
    ])


def merged(held: DataFrame, keys: Sequence[str], outputs: Sequence[str], max_items: int = MAX_ITEMS) -> DataFrame:
    """States brought together by coarser keys."""
    return held.groupBy(*keys).agg(*[F.expr(f"approx_top_k_combine(`{out}`, {max_items})").alias(out) for out in outputs])


def items(state: str, n: int = MAX_ITEMS) -> Column:
    """The `n` most common values of a state: an array of (item, count), highest counts first."""
    return F.expr(f"approx_top_k_estimate(`{state}`, {n})")


def top(state: str, max_items: int = MAX_ITEMS) -> Column:
    """The most common value and its count, as (item, count); of values with the same count the lowest, null before all."""
    return _best(items(state, max_items))


def _best(held: Column) -> Column:
    best = F.filter(held, lambda x: x["count"] == F.get(held, F.lit(0))["count"])
    return F.get(F.array_sort(best, lambda a, b: F.when(a["item"].isNull(), -1).when(b["item"].isNull(), 1).when(a["item"] < b["item"], -1).otherwise(1)), F.lit(0))


def usual_values(
    df: DataFrame, key: str, columns: Mapping[str, str], where: Mapping[str, str] | None = None, step: str | None = None, max_items: int = MAX_ITEMS
) -> DataFrame:
    """As `relational.most_common`, from one state per key and output, in memory that doesn't grow with the different values.

    A key with many rows sends one state per map task. With `step`, states are made per key and step and then merged: for steps
    with many rows each, as every state that is merged costs more than a row that is counted.
    """
    if step is None:
        held = states(df, [key], columns, max_items, where)
    else:
        held = merged(states(df, [key, step], columns, max_items, where), [key], list(columns), max_items)
    listed = held.select(key, *[items(out, max_items).alias(out) for out in columns])  # once per state, not once per item
    return listed.select(key, *[_best(F.col(out))["item"].alias(out) for out in columns])
