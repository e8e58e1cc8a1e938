"""Registered queries: a name, a Spark plan over a `Shop`, and the DuckDB statement that must agree."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import models as _results  # noqa: F401  (registers the named statements)
from oracle.sql import full, plain
from shoploom.catalog.shop import Shop

PLANS: dict[str, Callable[[Shop], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, so both engines show the same type."""
    exact = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df


def register(name: str, plan: Callable[[Shop], DataFrame], sql: str | None = None, exact: bool = False) -> None:
    """`exact`: the statement yields decimal columns, shown as DOUBLE."""
    if name in PLANS:
        raise ValueError(f"query registered twice: {name}")
    PLANS[name] = plan
    if sql is not None:
        CHECKS[name] = full(plain(sql, exact))


def runner(
    plan: Callable[[Shop], DataFrame], columns: Iterable[str] | None = None
) -> Callable[[SparkSession, str], DataFrame]:
    """`columns`: those of the order fact that the plan reads, if not all."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(plan(Shop(spark, sf_dir, columns)))

    return run
