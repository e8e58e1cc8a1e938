"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoploom.llm.common import written


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = pairs.union(pairs.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, are linked to the smallest of them."""
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node in `pairs` (a, b) reaches. Every step is written to the shared folder."""
    now = pairs.select("a", "b").where("a != b")
    before = None
    while True:
        stars = written(_small_star(_large_star(now)).distinct(), "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now, before = stars, state
