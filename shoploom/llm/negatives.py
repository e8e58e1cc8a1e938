"""Hard negatives by exact matrix products in a residue number system.

Quantised vectors are multiplied as float32 matrices modulo several small primes. Residues are kept balanced around zero, and
primes are small enough for every sum of products to stay an integer below 2^24, which float32 holds exactly. Chinese remaindering
with balanced mixed-radix digits gives back the exact signed scores; a bound by the vectors' lengths says how many primes that takes.

Anchors are a stated query set: blocks of them meet groups of rows, one pair of blocks at a time. Each pair of blocks gives only
its best few rows per anchor; a window picks from those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.llm.common import bounded_batches, written

EXACT = 1 << 24  # integers below are exact in float32
DEPTH = 256  # components multiplied at once
BLOCK_BYTES = 32 << 20  # of a block's components as doubles
MOST_ANCHORS, MOST_ROWS = 8192, 65536
SLAB = 256, 4096  # anchors and rows scored at once
FAR = 1 << 62

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, math.isqrt(n) + 1))


def primes_for(bound: int, dims: int) -> list[int]:
    """At least three primes whose product exceeds 2.2 times `bound`, near each other, each fit for sums over DEPTH components."""
    most = 2 * math.isqrt((EXACT - 1) // max(1, min(dims, DEPTH))) + 1
    need, n = int(2.2 * bound) + 10 if bound < 1 << 1000 else 3 * bound, 3
    while True:
        start = max(3, min(most, math.ceil(math.exp(math.log(need) / n))))
        found = [p for p in range(start, most + 1) if _prime(p)][:n]
        found += [p for p in range(start - 1, 2, -1) if _prime(p)][: n - len(found)]
        if len(found) < n:
            raise ValueError("vectors are too long for these primes")
        if math.prod(found) > need:
            return sorted(found)
        n += 1


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """`x` modulo `p`, near zero. In floats a digit may lie one beyond half of `p`, which the slack in the product of primes covers."""
    if x.dtype == object:
        return (x + p // 2) % p - p // 2
    return x - np.rint(x * x.dtype.type(1 / p)) * x.dtype.type(p)


def residues(q: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Whole-valued doubles as float32 residues, one matrix per prime."""
    return [(np.fmod(q, p) - p * np.rint(np.fmod(q, p) / p)).astype(np.float32) for p in primes]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact scores of all rows of `a` with all of `b`: float32 or float64 where these hold them, else 64-bit integers, which
    stop at their limits."""
    whole = math.prod(primes)
    kind = np.float32 if whole < EXACT else np.float64 if whole < 1 << 52 else object
    value, base = None, 1
    for x, y, p in zip(a, b, primes, strict=True):
        rest = np.zeros((len(x), len(y)), dtype=np.float32)
        for k in range(0, max(1, x.shape[1]), DEPTH):
            rest = _balanced(rest + _balanced(x[:, k : k + DEPTH] @ y[:, k : k + DEPTH].T, p), p)
        if kind is object:
            rest = rest.astype(np.int64).astype(object)
        if value is None:
            value = rest.astype(kind)
        else:
            inverse = pow(base, -1, p)
            inverse -= p if inverse > p // 2 else 0
            # digit of this place: what is left, modulo p, over the product of the primes before
            left = rest.astype(kind) - _balanced(value, p)
            digit = _balanced(_balanced(left, p) * (inverse if kind is object else kind(inverse)), p)
            value = value + digit * (base if kind is object else kind(base))
        base *= p
    if kind is object:
        return np.clip(value, -(1 << 63), (1 << 63) - 1).astype(np.int64)
    return value


class _Best:
    """The best `k` rows per anchor and band, `low` to `high`: higher scores first, then earlier rows. Rows come in order."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.need, self.high, self.k = low.copy(), high, k
        self.kept = [np.empty(0, np.int64) for _ in range(4)]
        self.new: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, first: int | np.ndarray, live: np.ndarray | None = None) -> None:
        """`first`: place of the first row of `scores`, or the places of all; `live`: which cells may be taken."""
        kind = scores.dtype
        cells = (scores >= self.need.min(axis=1).astype(kind)[:, None]) & (scores <= self.high.max(axis=1).astype(kind)[:, None])
        if live is not None:
            cells &= live
        a, r = np.nonzero(cells)
        s = scores[a, r].astype(np.int64)
        places = first[r] if isinstance(first, np.ndarray) else r + first
        for j in range(self.need.shape[1]):
            hit = (s >= self.need[a, j]) & (s <= self.high[a, j])
            self.new.append([a[hit], np.full(int(hit.sum()), j), s[hit], places[hit]])
            self.waiting += len(self.new[-1][0])
        if self.waiting > 20 * self.need.size:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        """anchor, band, score, row of what is best so far, in order."""
        a, j, s, r = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((r, -s, j, a))
        group = a[order] * self.need.shape[1] + j[order]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])[: len(group)])
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        chosen = order[rank < self.k]
        self.kept, self.new, self.waiting = [c[chosen] for c in (a, j, s, r)], [], 0
        last = order[rank == self.k - 1]
        self.need[a[last], j[last]] = np.maximum(self.need[a[last], j[last]], np.minimum(s[last], FAR - 1) + 1)
        return self.kept


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), dims))
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _order(t: pa.Table) -> pa.Table:
    """By id, unknown ids last, then by row."""
    ids, rids = t.column("r_id"), t.column("r_rid").to_numpy()
    return t.take(pa.array(np.lexsort((rids, ids.fill_null(FAR * 2 - 1).to_numpy(), ids.is_null().to_numpy()))))


class HardNegatives:
    """Rows of another label that score just below an anchor's positives.

    `df` has whole-numbered ids and labels, vectors of numbers, and a boolean `anchor`. Components become
    floor(scale * x); a score is the integer inner product. Rows with a null label, a null vector, a null or non-finite
    component (also once scaled or squared) take no part; a null anchor flag is false. Of vectors of unequal length the
    shorter one counts as ending in zeros; an empty one scores 0. Unknown ids come last in ties. Repeated rows are rows of their
    own, also beside an anchor. Scores outside 64 bits count as the nearest number inside. Further columns of `df` are not
    read. Empty tables and tables without anchors give an empty result. What is collected on the driver is one row of bounds.
    """

    def __init__(self, df: DataFrame, anchor: Column, id: str = "vec_id", label: Column | str = "label", vector: str = "embedding", scale: int = 256):
        spark = df.sparkSession
        bounded_batches(spark)
        label = F.col(f"`{label}`") if isinstance(label, str) else label
        thin = df.select(
            F.col(f"`{id}`").cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
            F.col(f"`{vector}`").cast("array<double>").alias("q"),
        )
        schema = "id long, label long, anchor boolean, q array<double>, norm2 double"

        def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("q")
                lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.repeat(np.arange(len(lengths)), lengths)
                with np.errstate(over="ignore", invalid="ignore"):
                    q = np.floor(lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                    norm2 = np.bincount(at, weights=q * q, minlength=len(lengths)).astype(np.float64)
                keep = lists.is_valid().to_numpy(zero_copy_only=False) & batch.column("label").is_valid().to_numpy(zero_copy_only=False) & np.isfinite(norm2)
                offsets = np.concatenate([[0], np.cumsum(lengths[keep])]).astype(np.int32)
                kept = batch.select(["id", "label", "anchor"]).filter(pa.array(keep))
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(q[keep[at]]))
                yield pa.RecordBatch.from_arrays([*kept.columns, values, pa.array(norm2[keep])], names=["id", "label", "anchor", "q", "norm2"])

        numbered = thin.mapInArrow(quantised, schema).withColumn("rid", F.monotonically_increasing_id())
        self.vectors = written(numbered, "vectors")
        only = F.when(F.col("anchor"), F.col("norm2"))
        n, anchors, dims, longest, own = self.vectors.agg(
            F.count("*"), F.count(only), F.max(F.size("q")), F.max("norm2"), F.max(only)
        ).first()
        self.dims = max(1, dims or 1)
        bound = math.isqrt(math.ceil(longest or 0) * math.ceil(own or 0)) + 1
        self.primes = primes_for(bound + bound // 10**6, self.dims)
        fit = max(64, BLOCK_BYTES // (8 * self.dims))
        self.n_anchor_blocks = -(-max(1, anchors) // min(MOST_ANCHORS, fit))
        share = -(-n // spark.sparkContext.defaultParallelism)
        self.n_row_blocks = -(-max(1, n) // min(MOST_ROWS, fit, max(1024, share)))
        self.tasks = min(4 * self.n_anchor_blocks * self.n_row_blocks, 50_000)
        self.small = bound < 1 << 30  # then each component fits 32 bits

    def _meet(self, anchors: DataFrame, work, schema: str) -> DataFrame:
        """`work` on every pair of an anchor block and a row block."""
        q = F.col("q").cast("array<int>" if self.small else "array<double>").alias("q")
        row_block = F.pmod(F.xxhash64("rid"), F.lit(self.n_row_blocks)).cast("int").alias("row_block")
        anchor_block = F.pmod(F.xxhash64("rid"), F.lit(self.n_anchor_blocks)).cast("int").alias("anchor_block")
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        rows = self.vectors.select(
            F.col("rid").alias("r_rid"), F.col("id").alias("r_id"), F.col("label").alias("r_label"), q.alias("r_q"), row_block,
            numbers(self.n_anchor_blocks).alias("anchor_block"),
        )
        mine = anchors.select("rid", "id", "label", q, *[c for c in ("positives",) if c in anchors.columns], anchor_block,
                              numbers(self.n_row_blocks).alias("row_block"))
        keys = ["anchor_block", "row_block"]
        left, right = (x.repartition(self.tasks, *keys).groupBy(*keys) for x in (mine, rows))
        return left.cogroup(right).applyInArrow(work, schema)

    def positives(self, k: int = 5) -> DataFrame:
        """For each anchor (rid, id) its best `k` other rows of the same label: positive_rid, positive_id, place, score."""
        dims, primes = self.dims, self.primes

        def work(_, anchors: pa.Table, rows: pa.Table) -> pa.Table:
            out = []
            if len(anchors) and len(rows):
                rows = _order(rows)
                a_rid, r_rid = anchors.column("rid").to_numpy(), rows.column("r_rid").to_numpy()
                a_label, r_label = anchors.column("label").to_numpy(), rows.column("r_label").to_numpy()
                a_q, r_q = _matrix(anchors.column("q"), dims), _matrix(rows.column("r_q"), dims)
                for value in np.unique(a_label):
                    mine, theirs = np.flatnonzero(a_label == value), np.flatnonzero(r_label == value)
                    for i in range(0, len(mine), SLAB[0]):
                        some = mine[i : i + SLAB[0]]
                        left = residues(a_q[some], primes)
                        best = _Best(np.full((len(some), 1), -FAR), np.full((len(some), 1), FAR), k)
                        for at in range(0, len(theirs), SLAB[1]):
                            part = theirs[at : at + SLAB[1]]
                            scores = products(left, residues(r_q[part], primes), primes)
                            best.add(scores, part, a_rid[some][:, None] != r_rid[part][None, :])
                        a, _, s, r = best.settle() if best.new else best.kept
                        out.append((some[a], s, r))
            a, s, r = (np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64) for c in zip(*out, strict=True)) if out else [np.empty(0, np.int64)] * 3
            return pa.table({
                "rid": anchors.column("rid").take(pa.array(a)), "id": anchors.column("id").take(pa.array(a)),
                "positive_rid": rows.column("r_rid").take(pa.array(r)), "positive_id": rows.column("r_id").take(pa.array(r)), "score": pa.array(s),
            })

        anchors = self.vectors.where("anchor")
        found = self._meet(anchors, work, "rid long, id long, positive_rid long, positive_id long, score long")
        first = W.partitionBy("rid").orderBy(F.desc("score"), F.col("positive_id").asc_nulls_last(), "positive_rid")
        return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)

    def mined(self, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
        """For each anchor and each of its positives the best `negatives` rows of another label that score from `low` to `high`
        hundredths of the positive's score, as `RESULT`."""
        dims, primes = self.dims, self.primes
        one = F.struct("place", F.col("positive_rid").alias("rid"), F.col("positive_id").alias("id"), "score")
        lists = self.positives(positives).groupBy("rid").agg(F.sort_array(F.collect_list(one)).alias("positives"))  # `positives` at most
        anchors = written(self.vectors.where("anchor").join(lists, "rid"), "anchors")
        schema = "rid long, anchor_id long, place int, positive_id long, positive_score long, negative_rid long, negative_id long, negative_score long"

        def work(_, anchors: pa.Table, rows: pa.Table) -> pa.Table:
            out = []
            if len(anchors) and len(rows):
                rows = _order(rows)
                a_label, r_label = anchors.column("label").to_numpy(), rows.column("r_label").to_numpy()
                lists = anchors.column("positives").to_pylist()
                a_q, r_q = residues(_matrix(anchors.column("q"), dims), primes), residues(_matrix(rows.column("r_q"), dims), primes)
                for i in range(0, len(anchors), SLAB[0]):
                    some = slice(i, min(i + SLAB[0], len(anchors)))
                    scored = np.full((some.stop - i, positives), -1, np.int64)  # no positive: an empty band
                    for n, found in enumerate(lists[some]):
                        scored[n, : len(found)] = [x["score"] for x in found]
                    hundreds, rest = scored // 100, scored % 100
                    best = _Best(low * hundreds - (-low * rest) // 100, high * hundreds + high * rest // 100, negatives)
                    for at in range(0, len(rows), SLAB[1]):
                        part = slice(at, at + SLAB[1])
                        scores = products([x[some] for x in a_q], [x[part] for x in r_q], primes)
                        best.add(scores, at, a_label[some][:, None] != r_label[part][None, :])
                    a, j, s, r = best.settle()
                    out.append((a + i, j, scored[a, j], s, r))
            a, j, p, s, r = (np.concatenate(c) for c in zip(*out, strict=True)) if out else [np.empty(0, np.int64)] * 5
            ids = [lists[x][y]["id"] for x, y in zip(a.tolist(), j.tolist(), strict=True)]
            return pa.table({
                "rid": anchors.column("rid").take(pa.array(a)), "anchor_id": anchors.column("id").take(pa.array(a)),
                "place": pa.array(j + 1, pa.int32()), "positive_id": pa.array(ids, pa.int64()), "positive_score": pa.array(p),
                "negative_rid": rows.column("r_rid").take(pa.array(r)), "negative_id": rows.column("r_id").take(pa.array(r)), "negative_score": pa.array(s),
            })

        found = self._meet(anchors, work, schema)
        best = W.partitionBy("rid", "place").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "negative_rid")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
        return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
