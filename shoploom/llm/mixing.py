"""Mixing sources to target weights.

Every row gets a hash-random key, rows are range-sorted within their source by it, and a distributed prefix sum of sizes
(`operators.ranges`: sums per range, then a scan inside each) tells where each source's budget ends. A budget above the
source's size repeats the source in whole epochs; the last, unfinished epoch is cut at the exact word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.llm.common import WORD, nested, unnested, written
from shoploom.operators.ranges import Ranged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

ADDED = ["size", "source_size", "target", "taken"]


def words(text: str) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(id: Column, seed: int) -> Column:
    """60 bits of the MD5 digest of seed and id, so that other engines find the same order."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`sizes` (source, source_size; one row per source) with each source's `target`.

    Sources by code point, null last, weigh `weights`, repeated. They share `share` of all sizes by weight; a target stops
    at `most` times its source's size and the excess is reshared by weight until none is above. The end of that resharing
    is found at once: with sources sorted by the level (size by weight) at which they stop, those stop that lie at or
    below the level that the rest would then get. Ranks and sums over sources are distributed, too.
    """
    if share > most:
        raise ValueError("the targets can't hold the whole share")
    hundredths = round(share * 100)
    named = sizes.withColumn("_none", F.col("source").isNull())
    ranked = Ranged(named, [], ["_none", "source"]).ranked("_rank").drop("_none")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("_rank") - 1, len(weights)) + 1)
    weighed = ranked.withColumn("weight", weight.cast("long")).withColumn("_level", F.col("source_size") / F.col("weight"))
    up_to = Ranged(weighed, [], ["_level", "_rank"]).running({"_size": F.col("source_size"), "_weight": F.col("weight")})
    up_to = written(up_to, "levels")
    whole = up_to.agg(F.sum("source_size").alias("_sizes"), F.sum("weight").alias("_weights"))

    wide = "decimal(38,0)"  # integers, so that no rounding decides which sources stop
    level = F.struct("_level", "_rank")
    left = F.col("_sizes").cast(wide) * hundredths - F.col("_before").cast(wide) * (100 * most)  # hundredths of words not yet given
    open_ = F.col("_weights") - F.col("_weight") + F.col("weight")  # weights of this source and those above
    rows = up_to.withColumn("_before", F.col("_size") - F.col("source_size")).join(F.broadcast(whole))  # one row
    rows = rows.withColumns({"_left": left, "_open": open_})
    stops = F.col("source_size").cast(wide) * (100 * most) * F.col("_open") <= F.col("weight").cast(wide) * F.col("_left")
    first = rows.where(~stops).agg(
        F.min_by("_left", level).alias("_left"), F.min_by("_open", level).alias("_open"), F.min(level).alias("_from")
    )
    capped = (F.col("source_size") * most).cast("double")
    shared = F.col("weight") * (F.col("_left").cast("double") / 100) / F.col("_open")
    reached = F.coalesce(level >= F.col("_from"), F.lit(False))
    found = up_to.join(F.broadcast(first)).withColumn("target", F.when(reached, F.least(shared, capped)).otherwise(capped))
    return found.select("source", "source_size", "weight", "target")


class Mixture:
    """How much of each row of `df` a mix of its sources takes.

    `size` names a column of whole numbers, for instance `words` of a text; null and negative sizes count as 0. `source` and `id` name the
    columns of source and id, of any type that can be sorted; null sources are one source, null ids hash as empty. Rows
    with the same id keep an order of their own, so repeated rows are taken or left one by one. An empty table gives an
    empty mix. `df` may have any other columns: those of `ADDED` are replaced. The seed picks the order; the same rows give
    the same mix, however they are dealt to partitions (rows equal in source, id and size may change places).
    """

    def __init__(
        self, df: DataFrame, size: str, source: str = "source", id: str = "doc_id", weights: Sequence[int] = WEIGHTS,
        share: float = SHARE, most: int = MOST, seed: int = 0,
    ):
        inner = nested(df)
        row = F.col("row")
        self.numbered = written(inner.select(
            "row", F.monotonically_increasing_id().alias("rid"), row.getField(source).alias("source"), row.getField(id).alias("id"),
            F.greatest(F.coalesce(row.getField(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"), hash_key(row.getField(id), seed).alias("key"),
        ), "mixed")
        thin = self.numbered.drop("row")
        sizes = written(thin.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
        self.targets = written(targets(sizes, weights, share, most), "targets")
        ordered = Ranged(thin, ["source"], ["key", "id", "size", "rid"])
        some, budget = F.col("source_size") > 0, F.floor("target").cast("long")
        plan = self.targets.select(
            "source", "source_size", "target", F.when(some, F.expr("floor(target) div source_size")).otherwise(0).alias("epochs"),
            F.when(some, budget % F.col("source_size")).otherwise(0).alias("rest"),
        )
        passed = ordered.running({"upto": F.col("size")}, beside=plan)
        last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - (F.col("upto") - F.col("size"))))
        self.shares = passed.select(
            "rid", "source", "id", "key", "size", "source_size", "target", "epochs", last.alias("cut"), (F.col("epochs") * F.col("size") + last).alias("taken")
        )

    def taken(self) -> DataFrame:
        """One row per row of `df`, without its other columns: source, id, size, source_size, target, epochs (how often it
        is taken whole), cut (units of it that the last epoch takes besides) and taken (all of them)."""
        return self.shares.drop("rid", "key")

    def rows(self) -> DataFrame:
        """The mix itself: the columns of `df` and, for each time a row is taken, `epoch` (from 0), `order_key` (sort by epoch
        and order_key for the mixed order) and `units`, how many of its units from the first on are taken then."""
        whole = F.transform(F.sequence(F.lit(0), F.col("epochs").cast("int")), lambda e: F.struct(
            e.alias("epoch"), F.when(e < F.col("epochs"), F.col("size")).otherwise(F.col("cut")).alias("units")))
        times = self.shares.select("rid", "key", F.explode(F.filter(whole, lambda t: t["units"] > 0)).alias("time"))
        chosen = times.select("rid", F.col("time.epoch").alias("epoch"), F.xxhash64("key", "time.epoch").alias("order_key"), F.col("time.units").alias("units"))
        return unnested(self.numbered.select("row", "rid").join(chosen, "rid"), "epoch", "order_key", "units")
