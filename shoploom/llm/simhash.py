"""Near duplicates by SimHash and a byte-position inverted index with count filtering.

Fingerprints of 64 bits that differ in at most three bits touch at most three of their eight bytes, so they share at
least five positional bytes. The index posts each distinct fingerprint under sets of four positional bytes, chosen so
that any five shared positions contain one of the sets whole. Within a posting, the shared positional bytes of a pair are
tallied; pairs that reach the guaranteed minimum are verified by their differing bits. A posting yields a spanning
forest of its links, not all pairs, so large groups of near copies cost a number of links in line with their size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import Blocks, marks_of, nested, texts_of, unnested, written
from shoploom.llm.components import components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
_PART = 1 << 16  # hashes turned into bits at a time


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, repeats included, as an unsigned number; zero for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    ones, count = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for a in range(0, count, _PART):
        part = words[a : a + _PART + shingle - 1]
        runs = zip(*(part[k:] for k in range(shingle)), strict=False)
        ones += _bit_sums(np.array([digest(join(run), seed) for run in runs], dtype=np.uint64))
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """`df` with its columns in `row`, and `print`: the fingerprint of the text as a signed long."""
    thin = nested(df)
    schema = T.StructType([thin.schema["row"], T.StructField("print", T.LongType())])

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(x, shingle) for x in texts_of(batch, text)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64), pa.int64())], names=["row", "print"])

    return thin.mapInArrow(run, schema)


def posting_masks(shared: int, key_bytes: int = 4) -> list[int]:
    """Masks of `key_bytes` positional bytes such that every set of `shared` positions contains one of them, chosen greedily."""
    chosen: list[tuple[int, ...]] = []
    needed = {frozenset(c) for c in combinations(range(8), shared)}
    sets = [frozenset(c) for c in combinations(range(8), key_bytes)]
    while needed:
        best = max(sets, key=lambda s: sum(s <= n for n in needed))
        needed = {n for n in needed if not best <= n}
        chosen.append(tuple(sorted(best)))
    return [sum(0xFF << (8 * k) for k in c) for c in chosen]


def link_posting(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints of one posting.

    From each fingerprint reached, only those not reached yet are tallied: one scan links all of a dense group.
    """
    left, right = [], []
    rest = prints
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            differing = rest ^ one
            shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (shared >= 8 - max_bits) & (np.bitwise_count(differing) <= max_bits)
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), one))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    none = [np.empty(0, dtype=np.uint64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: links between distinct fingerprints (column `print`) that connect all within `max_bits` of each other."""
    masks = [m - (1 << 64) if m >> 63 else m for m in posting_masks(8 - max_bits)]
    posted = F.explode(F.array(*[F.struct(F.lit(k).alias("set"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)]))
    postings = (
        prints.select("print", posted.alias("at")).select("at.set", "at.key", "print")
        .repartition("set", "key").sortWithinPartitions("set", "key")
    )

    def run(batches):
        held = [np.empty(0, dtype=t) for t in (np.int32, np.int64, np.int64)]
        for batch in batches:
            rows = [np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate(held)]
            cut = _starts(rows)[-1]  # the last posting may go on in the next batch
            yield from _linked([x[:cut] for x in rows], max_bits)
            held = [x[cut:] for x in rows]
        yield from _linked(held, max_bits)

    return postings.mapInArrow(run, "a long, b long")


def _starts(rows: list[np.ndarray]) -> np.ndarray:
    """Where the postings (set, key) begin in sorted rows."""
    changes = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
    return np.concatenate([[0], np.flatnonzero(changes) + 1])


def _linked(rows: list[np.ndarray], max_bits: int):
    prints, starts = rows[2].view(np.uint64), _starts(rows)
    sizes = np.diff(starts, append=len(prints))
    a, b = [], []
    pairs = starts[sizes == 2]
    near = np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= max_bits
    a.append(prints[pairs][near])
    b.append(prints[pairs + 1][near])
    for k in np.flatnonzero(sizes > 2):
        x, y = link_posting(prints[starts[k] : starts[k] + sizes[k]], max_bits)
        a.append(x)
        b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (a, b)], names=["a", "b"])


class NearDuplicates:
    """Components of the rows of `df` whose fingerprints link at `max_bits` or fewer differing bits.

    A null text counts as empty; texts without words have the fingerprint zero, which links like any other. Rows with
    equal fingerprints are in one component. The component's id is its smallest row id (nulls aside; null where it has
    none but nulls). Of each component one row stays: of those with the smallest id, the first written. An empty table
    gives an empty result. `df` may have any other columns.
    """

    def __init__(self, df: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS):
        self.blocks = Blocks(fingerprints(df, text, shingle), "near")
        thin = self.blocks.rows.select("rid", F.col("row").getField(id).alias("doc_id"), "print")
        distinct = written(thin.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
        pairs = written(links(distinct.select("print"), max_bits).distinct(), "links")
        # Fingerprints without a link are their own root.
        roots = distinct.join(components(pairs).withColumnRenamed("node", "print"), "print", "left").select(
            "print", F.coalesce("root", "print").alias("root"), "least"
        )
        least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
        self.rows = thin.join(written(roots.join(least, "root"), "roots"), "print")

    def verdicts(self) -> DataFrame:
        """One row for each row of `df`: rid, doc_id, fingerprint (16 hex digits), component_id."""
        return self.rows.select("rid", "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

    def kept(self) -> DataFrame:
        """The rows of `df` that stay, one of each component, with its columns."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
        stays = written(self.rows.groupBy("root").agg(first), "stays")  # so that a hot component's side of the join can be split
        dropped = self.rows.join(stays, "root").where(F.col("rid") != F.col("first.rid")).select("rid")
        return unnested(self.blocks.marked(marks_of(dropped), "dropped").where("not dropped"))
