"""Packing of token pieces into sequences by minimum bin slack.

How many pieces there are of each length is all that the search needs, and lengths are at most the capacity. For one
bin, the longest remaining length is set and a subset-sum over a bitset of reachable fillings finds the fullest
combination of the remaining lengths. That combination is repeated as long as the counts allow, then removed. The plan
names, for each length, which ranks of its pieces go to which sequences; pieces get their rank from counts per partition.
"""

from __future__ import annotations

import json
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import bounded_batches, nested, unnested, written

CAPACITY = 2048
# The vocabulary's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, how many) that fill `room` best. A count is split into powers of two, so that each bit shift is one item."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, many = min(int(counts[length]), room // length), 1
        while left:
            many = min(many, left)
            steps.append((reach, length, many))
            reach |= (reach << (length * many)) & mask
            if reach >> room & 1:
                break
            left -= many
            many *= 2
        if reach >> room & 1:
            break
    at, taken = reach.bit_length() - 1, {}
    for before, length, many in reversed(steps):
        if not before >> at & 1:
            at -= length * many
            taken[length] = taken.get(length, 0) + many
    return sorted(taken.items(), reverse=True)


def plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, how many in each, offset): every rank of every length, once.

    `counts[length]` pieces have that length; the last index is the capacity. A combination is used as often as its
    scarcest length allows, so each search uses up a length or nearly so, and their number follows from the capacity,
    not from the number of pieces.
    """
    counts, used = counts.copy(), np.zeros(len(counts), dtype=np.int64)
    capacity, sequence, out = len(counts) - 1, 0, []
    longest = capacity
    while longest > 0:
        if not counts[longest]:
            longest -= 1
            continue
        counts[longest] -= 1
        items = dict(fullest(counts, capacity - longest))
        counts[longest] += 1
        items[longest] = items.get(longest, 0) + 1
        times, offset = min(int(counts[k]) // n for k, n in items.items()), 0
        for length, n in sorted(items.items(), reverse=True):
            out.append((length, int(used[length]), int(used[length]) + n * times, sequence, n, offset))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
        sequence += times
    return out


def packed(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`. Lengths are from 1 to `capacity`; other rows (null, below, above) have no place:
    both are null.

    Pieces of equal length are interchangeable and ranked by partition and place. An empty table gives an empty result;
    columns named `sequence_id` or `offset` are replaced.
    """
    given = F.col(f"`{length}`")
    rows = written(
        nested(pieces, _length=F.when(given.between(1, capacity), given.cast("int")).otherwise(0)).withColumn("_place", F.monotonically_increasing_id()), "pieces"
    )
    part = F.shiftright("_place", 33)
    per_part = rows.groupBy(part.alias("_part"), "_length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(per_part.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "starts")
    totals = starts.groupBy("_length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in totals:
        counts[r["_length"]] = r["n"]
    counts[0] = 0
    steps = np.array(plan(counts) or [(0, 0, 0, 0, 1, 0)], dtype=np.int64)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]

    # The rank of a piece: what earlier partitions hold of its length, and its place among those of its own.
    starts = starts.groupBy("_part").agg(F.collect_list(F.struct("_length", "start")).alias("starts"))  # at most `capacity` each
    placed = T.StructType([rows.schema["row"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(key: tuple[pa.Scalar, ...], group: pa.Table, before: pa.Table) -> pa.Table:
        group = group.sort_by("_place")
        lengths = group.column("_length").to_numpy()
        first = np.zeros(capacity + 1, dtype=np.int64)
        for s in before.column("starts")[0].as_py() if len(before) else []:
            first[s["_length"]] = s["start"]
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        within = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
        rank = np.empty(len(lengths), dtype=np.int64)
        rank[order] = first[ordered] + within
        step = steps[_last_step(steps, lengths, rank)]
        nth, each = rank - step[:, 1], step[:, 4]
        return pa.table({
            "row": group.column("row"),
            "sequence_id": pa.array(step[:, 3] + nth // each, pa.int64(), mask=lengths == 0),
            "offset": pa.array(step[:, 5] + nth % each * lengths, pa.int64(), mask=lengths == 0),
        })

    both = rows.withColumn("_part", part).groupBy("_part").cogroup(starts.groupBy("_part"))
    return unnested(both.applyInArrow(place, placed), "sequence_id", "offset")


def _last_step(steps: np.ndarray, lengths: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each piece, the step of its length whose ranks hold its own."""
    top = int(steps[:, 2].max()) + 1
    return np.searchsorted(steps[:, 0] * top + steps[:, 1], lengths * top + rank, side="right") - 1


class Tokens:
    """The ids of texts under a byte-level BPE, as little-endian unsigned 32-bit numbers, with the end id.

    The vocabulary file is that of `tokenizers`; `tiktoken` gives the same ids from it several times faster, provided that the
    file merges in the order of its ids, changes no text before and splits it by the usual pattern, which is checked. Texts
    that its pattern engine refuses, such as very long runs of white space, go to `tokenizers`.
    """

    def __init__(self, path: str, end: int = 0):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        model, before = found["model"], found["pre_tokenizer"]
        order = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if found["normalizer"] or model["type"] != "BPE" or order != sorted(order) or any(before.get(k) != v for k, v in usual.items()):
            raise ValueError(f"{path} is not a byte-level vocabulary that merges in the order of its ids")
        self.path = path
        to_byte = _byte_alphabet()
        special = {t["content"]: t["id"] for t in found["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): rank for token, rank in found["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.end = np.uint32(end).tobytes()

    @cached_property
    def plain(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> bytes:
        try:
            found = self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            found = np.array(self.plain.encode(text, add_special_tokens=False).ids)
        return found.astype("<u4").tobytes() + self.end


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def tokens_of(path: str, end: int) -> Tokens:
    return Tokens(path, end)


def token_pieces(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", capacity: int = CAPACITY, end: int = 0, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if `ids`, the ids themselves as binary.

    A null text counts as empty: its only id is the end. Documents of more than `capacity` ids are cut into pieces of
    that many, the first of which holds what is over. Other columns are not kept; documents that share an id can't be told
    apart by it, their pieces are all there.
    """
    bounded_batches(docs.sparkSession)
    thin = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches):
        tokens = tokens_of(path, end)
        for batch in batches:
            rows: list[tuple] = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = tokens(value.as_py())
                n = len(found) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = found[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(part), part if ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)][: 6 if ids else 5]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    return thin.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    return packed(token_pieces(docs, path, capacity=capacity, ids=ids), capacity=capacity)
