"""Reading source tables and writing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoploom.session import CODEC, read_small, remove, replace_small, shuffles_freed

POINTER = "_current"  # Spark's readers pass over names that begin so
KEPT_VERSIONS = 2


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Full scan of one named Parquet table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shards_since(df: DataFrame, as_of: Column, days: int, shard: str = "event_date") -> DataFrame:
    """Rows of the daily shards of the last `days` days.

    `shard` holds `yyyyMMdd` text; as a partition column the filter prunes directories.
    """
    return df.filter(F.col(shard) >= F.date_format(F.date_sub(as_of, days), "yyyyMMdd"))


def read_shards(spark: SparkSession, path: str, schema, as_of: Column, days: int, shard: str = "event_date") -> DataFrame:
    """Partitioned table, only its recent shards. The schema keeps the shard key a string."""
    return shards_since(spark.read.schema(schema).parquet(current_version(spark, path)), as_of, days, shard)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Versions of the table that may be read, the newest first."""
    return (read_small(spark, f"{path}/{POINTER}") or "").split()


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows now; `path` itself for a plain folder of files."""
    found = _versions(spark, path.rstrip("/"))
    return f"{path.rstrip('/')}/{found[0]}" if found else path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table. What is read stays that version, whatever is written later."""
    return spark.read.parquet(current_version(spark, path))


BOUNDS_FROM = 20_000


def _stretches(df: DataFrame, layout: Sequence[str], n: int) -> list[DataFrame]:
    """`df` in up to `n` parts, consecutive in `layout` and of about equal size: bounds are taken from some of the rows. Rows equal in
    `layout` share a part."""
    rows = df.count() if n > 1 else 0
    if not rows:
        return [df]
    place = F.struct(*layout)
    some = df.select(place.alias("p")).sample(min(1.0, BOUNDS_FROM / rows), seed=1).orderBy("p").collect()
    bounds = sorted({len(some) * i // n for i in range(1, n)}) if some else []
    types = [df.schema[c].dataType for c in layout]
    # Structs compare field by field, a null before all else.
    at = [F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(layout, some[i]["p"], types, strict=True)]) for i in bounds]
    return [
        df.where((F.lit(True) if low is None else place >= low) & (F.lit(True) if high is None else place < high))
        for low, high in zip([None, *at], [*at, None], strict=True)
    ]


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    granularity: str = "day",
    cluster_by: Sequence[str] = (),
    keep: int = KEPT_VERSIONS,
    ranged: bool = False,
    runs: int = 1,
) -> DataFrame:
    """Replace a Parquet table at once and return it.

    Rows are written to a version folder of their own; only when all are there does a pointer file, replaced by one
    rename, name that version. Readers of the version before go on, a run that fails leaves the table as it was, and a table may
    be rebuilt from itself. `keep` versions stay, the newest included; older ones are removed. Of two writers at a time
    the last one to finish is read.

    `partition_by` is a date column, kept whole for day granularity and accompanied by
    `<column>_month` for month granularity. Rows are ranged over the partition and cluster
    columns and last over a hash of the whole row, so each task writes few directories, row
    groups carry narrow minima and maxima of the cluster columns, and a hot day, cluster value
    or NULL directory is dealt to as many tasks as its rows are worth. Ranges are found by a
    sampling run of the plan: pass a table that is written or cheap to compute. With `ranged` the rows of `df` are ranged
    over these columns already and are not shuffled again. With several `runs` each deals and writes the rows of one stretch of
    the layout, so that of wide rows only a part is on disk twice; each reads `df` anew.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    directory = partition_by
    if partition_by and granularity == "month":
        directory = f"{partition_by}_month"
        df = df.withColumn(directory, F.trunc(partition_by, "month"))
    layout = [c for c in (directory, *cluster_by) if c]

    def written(rows: DataFrame, to: str) -> None:
        if layout:
            dealt = rows if ranged else rows.repartitionByRange(*layout, F.xxhash64(*df.columns))
            rows = dealt.sortWithinPartitions(*layout)
        writer = rows.write.mode("append").option("compression", CODEC)
        with shuffles_freed(spark):
            (writer.partitionBy(directory) if directory else writer).parquet(to)

    version = f"version-{uuid.uuid4().hex}"
    try:
        for rows in _stretches(df, layout, runs if layout and not ranged else 1):
            written(rows, f"{path}/{version}")
    except BaseException:
        remove(spark, f"{path}/{version}")
        raise
    before = _versions(spark, path)
    replace_small(spark, f"{path}/{POINTER}", "\n".join([version, *before[: max(1, keep) - 1]]))
    for old in before[max(1, keep) - 1 :]:
        remove(spark, f"{path}/{old}")
    return spark.read.schema(df.schema).parquet(f"{path}/{version}")
