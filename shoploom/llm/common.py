"""What the operators of this package share: the shared folder, written tables, blocks of rows, small helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.session import kept_path

# Words are runs of anything but ASCII white space; bytes.split() cuts UTF-8 at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_BYTES = 8 << 20
MOST_BUCKETS = 50_000  # Spark refuses tables of more than 100,000
_POSITION_BITS = 33  # of monotonically_increasing_id: the partition's number stands above, the row's below


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: it survives lost executors and is not run twice.

    `session.release` removes it.
    """
    path = kept_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """Only A-Z are lower-cased."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus) == remainder


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` without its own columns of these names (in any case), which an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB at most, whatever the rows are like: a worker holds one batch and what it makes of it.

    The setting must hold when a result is run, not only while it is built, so it stays set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty; a field of `row` if the first column is that."""
    first = batch.column(0)
    column = first.field(name) if batch.schema.names[0] == "row" and name not in batch.schema.names else batch.column(name)
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def nested(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns of `df` inside one struct `row`, so that added columns clash with none of them."""
    bounded_batches(df.sparkSession)
    inner = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.struct(*inner).alias("row"), *[c.alias(k) for k, c in extra.items()])


def unnested(df: DataFrame, *extra: str) -> DataFrame:
    """The columns inside `row` again, and `extra`, which replace those of the same name."""
    taken = {n.lower() for n in extra}
    fields = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row").getField(n).alias(n) for n in fields], *extra)


class Blocks:
    """Rows written once, each with the block (the writing task) and its position there.

    The table is bucketed by block. A bitmap for each block can thus be joined to the rows while the rows, with
    their texts, stay where they are: only the bitmaps are shuffled. A block holds no more than one scan or
    shuffle partition, which bounds what is gathered for it; beyond MOST_BUCKETS blocks, several share a bucket.
    `session.release` removes the table.
    """

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self.buckets = min(MOST_BUCKETS, max(1, df.rdd.getNumPartitions()))
        number = F.monotonically_increasing_id()
        columns = [F.col(f"`{c}`") for c in df.columns]
        numbered = df.select(*columns, number.alias("rid")).withColumn("block", F.shiftright("rid", _POSITION_BITS))
        label = f"{name}_{uuid.uuid4().hex}"
        (
            numbered.write.bucketBy(self.buckets, "block").option("path", kept_path(spark, name, table=label))
            .format("parquet").saveAsTable(label)
        )
        self.rows = spark.table(label)

    def marked(self, marks: DataFrame, name: str) -> DataFrame:
        """The rows, and a boolean column that holds for those whose position is set in the `bits` of their block.

        `marks`: block, bits (array of longs, 64 positions each), one row per block at most.
        """
        position = F.col("rid").bitwiseAND((1 << _POSITION_BITS) - 1)
        word = F.get(F.col("bits"), F.shiftright(position, 6).cast("int"))
        bit = word.bitwiseAND(F.expr("shiftleft(1L, cast(rid & 63 as int))")) != 0
        columns = [F.col(c) for c in self.rows.columns]
        return self.rows.join(marks.hint("shuffle_hash"), "block", "left").select(*columns, F.coalesce(bit, F.lit(False)).alias(name))


MARKS = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.ArrayType(T.LongType()))])


def bit_words(positions: np.ndarray) -> list[int]:
    """Positions as 64-bit words, the form of `bits`."""
    if not len(positions):
        return []
    flags = np.zeros((int(positions.max()) // 64 + 1) * 64, dtype=np.uint8)
    flags[positions] = 1
    return np.packbits(flags, bitorder="little").view("<i8").tolist()


def marks_of(rids: DataFrame) -> DataFrame:
    """The bitmaps of the rows whose `rid` is given; a block's positions are bounded by its rows."""

    def one(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        at = group.column("rid").to_numpy() & ((1 << _POSITION_BITS) - 1)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bit_words(at)], pa.list_(pa.int64()))})

    thin = rids.select(F.shiftright("rid", _POSITION_BITS).alias("block"), "rid")
    return thin.groupBy("block").applyInArrow(one, MARKS)
