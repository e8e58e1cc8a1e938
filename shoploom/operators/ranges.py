"""Running sums, ranks and row frames within keys of any size.

A window over a key works on it in one task. Here the rows are dealt by (key, order) to ranges of about equal size, so that
a key with many rows fills many consecutive ranges. Each range is worked on by itself; what comes before it is known from one
small table of sums per key and range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.session import kept_path, write_files

RANGE = "_range"


def _sorted_by(order: Sequence[str], reverse: bool = False) -> list[Column]:
    return [F.desc(c.lstrip("-")) if c.startswith("-") != reverse else F.asc(c.lstrip("-")) for c in order]


def _attached(rows: DataFrame, table: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """`rows` with the further columns of `table`; a null key equals a null key."""
    other = table.withColumnsRenamed({n: f"_of_{n}" for n in names})
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names], F.lit(True))
    return rows.join(other, same, how).drop(*[f"_of_{n}" for n in names])


class Ranged:
    """`df` dealt to ranges by `keys` and `order`, and written once in the shared folder.

    `order` names columns, downwards with a minus before the name; nulls stand first upwards and last downwards.
    It is written because ranges are found by sampling: sums per range and rows must see the same ranges, also after an
    executor was lost. Rows equal in `keys` and `order` share a range. `df` may hold null keys (one group) and any
    columns but `_range`; an empty table gives empty results. `ranges` is their number, that of shuffle partitions if
    not given. The file goes with `session.release`.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None):
        spark = df.sparkSession
        self.keys, self.order = list(keys), _sorted_by(order)
        self.backwards = _sorted_by(order, reverse=True)
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = kept_path(spark, "ranged")
        dealt = df.repartitionByRange(n, *[F.col(k) for k in self.keys], *self.order)
        write_files(dealt.withColumn(RANGE, F.spark_partition_id()), path)
        self.rows = spark.read.parquet(path)

    def _before(self, values: Mapping[str, Column]) -> DataFrame:
        """Per key and range the sums over all earlier ranges of the key: as many rows as there are keys and ranges."""
        sums = self.rows.groupBy(*self.keys, RANGE).agg(*[F.sum(v).alias(n) for n, v in values.items()])
        earlier = W.partitionBy(*self.keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        return sums.select(*self.keys, RANGE, *[F.sum(n).over(earlier).alias(f"_before_{n}") for n in values])

    def running(self, values: Mapping[str, Column], peers: bool = False, beside: DataFrame | None = None) -> DataFrame:
        """The rows with a running sum of each value within its key. With `peers`, rows equal in `order` get the sum
        that includes all of them, as a window's default frame gives.

        `beside` holds further columns, one row per key. They are joined to the sums per range, so rows never meet by key.
        These sums stand as one more row at the head of each range, which spares the rows a shuffle of their own for a join.
        """
        before = self._before(values)
        heads = before if beside is None else _attached(before, beside, self.keys)
        rows = self.rows.withColumn("_head", F.lit(False)).unionByName(heads.withColumn("_head", F.lit(True)), allowMissingColumns=True)
        inside = W.partitionBy(*self.keys, RANGE).orderBy(F.desc("_head"), *self.order)
        if not peers:
            inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
        carried = {c: F.first(c).over(inside) for c in heads.columns if c not in (*self.keys, RANGE)}

        def running(n: str, v: Column) -> Column:
            own = F.sum(F.when(~F.col("_head"), v)).over(inside)
            return F.coalesce(carried[f"_before_{n}"], F.lit(0)) + F.coalesce(own, F.lit(0))

        further = {c: of for c, of in carried.items() if not c.startswith("_before_")}
        found = rows.withColumns(further | {n: running(n, v) for n, v in values.items()})
        return found.where("not _head").drop(RANGE, "_head", *[f"_before_{n}" for n in values])

    def ranked(self, name: str) -> DataFrame:
        """The rows with their place within their key, from 1. `order` should tell all rows of a key apart."""
        return self.running({name: F.lit(1).cast("int")}).withColumn(name, F.col(name).cast("int"))

    def framed(self, reach: int, columns: Callable[[WindowSpec], Mapping[str, Column]], beside: DataFrame | None = None) -> DataFrame:
        """The rows with `columns(window)`, where frames and lags over `window` reach at most `reach` rows back.

        Each range is worked on together with its halo, the `reach` rows of its key that stand right before it, which may
        come from several ranges. `beside` holds further columns, one row per key, for `columns` to use.
        """
        here = W.partitionBy(*self.keys, RANGE)
        counts = self.rows.groupBy(*self.keys, RANGE).agg(F.count("*").alias("_n"))
        earlier = W.partitionBy(*self.keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
        starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        # Only where a key goes on in another range do its rows have a range to be a halo of.
        upwards = W.partitionBy(*self.keys).orderBy(RANGE)
        going_on = starts.withColumn("_next", F.lead(RANGE).over(upwards)).where("_next is not null").drop("_next")
        ended = _attached(self.rows, going_on, [*self.keys, RANGE], "inner")
        tails = ended.withColumn("_back", F.row_number().over(here.orderBy(*self.backwards))).where(F.col("_back") <= reach)
        placed = tails.withColumn("_place", F.col("_start") + F.col("_n") - F.col("_back"))
        later = starts.select(*self.keys, F.col(RANGE).alias("_to"), F.col("_start").alias("_first"))
        wanted = (F.col(RANGE) < F.col("_to")) & (F.col("_place") >= F.col("_first") - reach)
        halo = _attached(placed, later, self.keys, "inner").where(wanted).withColumn(RANGE, F.col("_to")).select(
            *self.rows.columns, F.lit(True).alias("_halo")
        )
        own = self.rows if beside is None else _attached(self.rows, _attached(starts.select(*self.keys, RANGE), beside, self.keys), [*self.keys, RANGE])
        both = own.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
        found = both.withColumns(columns(here.orderBy(F.desc("_halo"), *self.order)))
        return found.where("not _halo").drop(RANGE, "_halo")
