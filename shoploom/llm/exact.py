"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each block of rows sends, to the owners of the hash ranges, its sorted distinct 64-bit fingerprints as Golomb-coded
differences. An owner answers each message with a bitmap of those that some other block has sent too. Only rows whose
fingerprint is marked, or comes twice in their own block, are suspects; only their texts are shuffled, to be compared
byte for byte.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import MARKS, Blocks, ascii_lower, bit_words, marks_of, nested, texts_of, unnested, written

ROWS_PER_OWNER = 2_000_000

_MESSAGE = "owner long, block long, n long, rice int, first binary, coded binary"
_MESSAGE_ARROW = pa.schema(
    [("owner", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("rice", pa.int32()), ("first", pa.binary()), ("coded", pa.binary())]
)


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct uint64 values as (rice, first value, Golomb code of the differences less one).

    The divisor is a power of two near 0.69 of the mean difference: `rice` low bits are stored as they are, the rest in unary.
    """
    if not len(values):
        return 0, b"", b""
    gaps = np.diff(values) - np.uint64(1)
    mean = float(values[-1] - values[0]) / max(1, len(gaps))
    rice = max(0, math.floor(math.log2(max(1.0, 0.69 * mean))))
    high = (gaps >> np.uint64(rice)).astype(np.int64)
    unary = np.zeros(int(high.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(high + 1) - 1] = 1
    low = ((gaps[:, None] >> np.arange(rice, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    return rice, values[:1].tobytes(), np.packbits(np.concatenate([low, unary]), bitorder="little").tobytes()


def golomb_decode(n: int, rice: int, first: bytes, coded: bytes) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.uint64)
    bits = np.unpackbits(np.frombuffer(coded, dtype=np.uint8), bitorder="little")
    cut = (n - 1) * rice
    low = (bits[:cut].reshape(n - 1, rice).astype(np.uint64) << np.arange(rice, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    ends = np.flatnonzero(bits[cut:])[: n - 1]
    high = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    gaps = (high << np.uint64(rice)) + low + np.uint64(1)
    return np.concatenate([np.frombuffer(first, dtype=np.uint64), gaps]).cumsum(dtype=np.uint64)


def _owner_edges(owners: int) -> np.ndarray:
    """The least fingerprint of each owner's range but the first."""
    return np.array([(k << 64) // owners for k in range(1, owners)], dtype=np.uint64)


def _fingerprinted(df: DataFrame, text: str) -> DataFrame:
    """`row`, `text_sha256` of the normalised text, and `print`, its first 64 bits."""
    thin = nested(df)
    schema = T.StructType([thin.schema["row"], T.StructField("text_sha256", T.StringType()), T.StructField("print", T.LongType())])

    def run(batches):
        for batch in batches:
            digests = [hashlib.sha256(x.lower()).digest() for x in texts_of(batch, text)]
            prints = np.frombuffer(b"".join(x[:8] for x in digests), dtype="<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.hex() for x in digests], pa.string()), pa.array(prints, pa.int64())], names=["row", "text_sha256", "print"]
            )

    return thin.mapInArrow(run, schema)


def _messages(thin: DataFrame, owners: int) -> DataFrame:
    def send(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        prints = np.unique(group.column("print").to_numpy().view(np.uint64))
        parts = np.split(prints, np.searchsorted(prints, _owner_edges(owners)))
        rows = [(k, key[0].as_py(), len(p), *golomb_encode(p)) for k, p in enumerate(parts) if len(p)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _MESSAGE_ARROW, strict=True)], schema=_MESSAGE_ARROW)

    return thin.groupBy("block").applyInArrow(send, _MESSAGE)


def _replies(messages: DataFrame) -> DataFrame:
    """For each message the bitmap, over its sorted fingerprints, of those that another block sent too."""

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        columns = [group.column(c).to_pylist() for c in ("n", "rice", "first", "coded")]
        lists = [golomb_decode(*x) for x in zip(*columns, strict=True)]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[counts > 1]
        bits = [np.packbits(np.isin(x, shared), bitorder="little").tobytes() for x in lists]
        return pa.table({"block": group.column("block"), "owner": group.column("owner"), "bitmap": pa.array(bits, pa.binary())})

    return messages.groupBy("owner").applyInArrow(answer, "block long, owner long, bitmap binary")


def _suspects(thin: DataFrame, replies: DataFrame, owners: int) -> DataFrame:
    """The bitmap of each block's suspects, in the form that `Blocks.marked` takes."""

    def mark(key: tuple[pa.Scalar, ...], rows: pa.Table, got: pa.Table) -> pa.Table:
        prints = rows.column("print").to_numpy().view(np.uint64)
        values, inverse, counts = np.unique(prints, return_inverse=True, return_counts=True)
        hit = counts > 1
        starts = np.concatenate([[0], np.searchsorted(values, _owner_edges(owners)), [len(values)]])
        for owner, bitmap in zip(got.column("owner").to_pylist(), got.column("bitmap").to_pylist(), strict=True):
            a, b = starts[owner], starts[owner + 1]
            hit[a:b] |= np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), count=int(b - a), bitorder="little").astype(bool)
        at = rows.column("rid").to_numpy()[hit[inverse]] & ((1 << 33) - 1)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bit_words(at)], pa.list_(pa.int64()))})

    return thin.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(mark, MARKS)


class ExactDuplicates:
    """Which rows of `df` have equal texts.

    Texts are equal when identical after lower-casing A-Z; a null text equals the empty one. Of equal texts the row with
    the largest id stays. A null id is the smallest. Where several rows share both text and id, one of them stays. An
    empty table gives an empty result. `df` may have any other columns.
    """

    def __init__(self, df: DataFrame, text: str = "text", id: str = "doc_id", rows_per_owner: int = ROWS_PER_OWNER):
        self.blocks = Blocks(_fingerprinted(df, text), "exact")
        self.text, self.id = F.coalesce(F.col("row").getField(text), F.lit("")), F.col("row").getField(id)
        thin = self.blocks.rows.select("block", "rid", "print")
        owners = max(1, -(-thin.count() // rows_per_owner))
        self.suspects = written(_suspects(thin, _replies(_messages(thin, owners)), owners), "suspects")

    def verdicts(self) -> DataFrame:
        """One row for each row of `df`: rid, doc_id, keep_id, group_size, kept, text_sha256."""
        marked = self.blocks.marked(self.suspects, "suspect")
        suspects = marked.where("suspect")

        # Byte for byte: equal digests must stand for one text. Each task sums up its texts before they are shuffled.
        texts = suspects.groupBy("text_sha256", ascii_lower(self.text).alias("normal")).agg(F.count("*").alias("n"))
        checked = texts.groupBy("text_sha256").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
        best = F.max(F.struct(self.id.alias("doc"), (-F.col("rid")).alias("rid"))).alias("best")
        equal = F.when(F.col("texts") == 1, F.col("n")).otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long"))
        groups = checked.join(suspects.groupBy("text_sha256").agg(best), "text_sha256").select(
            "text_sha256", equal.alias("group_size"), F.col("best.doc").alias("keep_id"), (-F.col("best.rid")).alias("keep_rid")
        )
        groups = written(groups, "groups")  # so that the join below is of two plain shuffles, of which a hot group's can be split

        rows = ["text_sha256", "rid", self.id.alias("doc_id")]
        alone = marked.where("not suspect").select(*rows, F.lit(1).cast("long").alias("group_size"), self.id.alias("keep_id"), F.lit(True).alias("kept"))
        copies = suspects.select(*rows).join(groups, "text_sha256").withColumn("kept", F.col("rid") == F.col("keep_rid"))
        return alone.unionByName(copies.drop("keep_rid")).select("rid", "doc_id", "keep_id", "group_size", "kept", "text_sha256")

    def kept(self) -> DataFrame:
        """The rows of `df` that stay, with its columns. Texts are not shuffled again: blocks get bitmaps of what goes."""
        dropped = marks_of(self.verdicts().where("not kept").select("rid"))
        return unnested(self.blocks.marked(dropped, "dropped").where("not dropped"))
