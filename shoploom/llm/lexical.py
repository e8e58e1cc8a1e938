"""Ranked lexical search with norm buckets.

Every document is a sparse vector of integer impacts over the terms of a block of queries. Vectors are ranged by length over
tasks, longest first, and cut into buckets of similar length. A query's score to beat prunes: whole buckets by Cauchy-Schwarz;
inside a bucket, documents by their partial product over the query's heaviest coordinates plus Cauchy-Schwarz on the others. Only
survivors are scored, exactly, in integers. The scores to beat start from the bucket of the longest vectors and rise as a task
goes on.

Queries are a stated set. They are worked on in blocks with a bounded number of terms, which is all that the driver holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.llm.common import ascii_lower, bounded_batches, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAPS = bytes(b for b in range(128) if not chr(b).isalnum())
_SPACED = bytes.maketrans(_GAPS, b" " * len(_GAPS))

BLOCK_TERMS = 200_000  # of a block of queries, each query's distinct terms counted; a longer query is a block of its own at worst
BUCKET_ROWS, LEAST_ROWS = 4096, 256
RATIO = 0.9  # shortest to longest vector of a bucket
PIECE = 1 << 20
SLACK = 1 + 1e-9  # bounds are doubles; scores are integers


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in pieces of about a megabyte."""
    text, at = text.lower().translate(_SPACED), 0
    while at < len(text):
        end = len(text) if at + PIECE >= len(text) else text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _lists(rows: list[list[int]], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _counted(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """For each document its number of terms, and which of the given terms it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = places.get
        for batch in batches:
            lengths, held, often = [], [], []
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                n, found = 0, Counter()
                for words in terms_of(text or b""):
                    n += len(words)
                    found.update(x for x in map(find, words) if x is not None)
                lengths.append(n)
                held.append(list(found))
                often.append(list(found.values()))
            columns = [batch.column("id"), pa.array(lengths, pa.int64()), _lists(held, pa.int32()), _lists(often, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tf"])

    return docs.mapInArrow(run, "id long, n long, terms array<int>, tf array<long>")


def _impacts(counted: DataFrame, n_docs: int, n_terms: int, heavy: np.ndarray) -> DataFrame:
    """Impacts of the terms that weigh something, and the vector's length; documents without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            term, tf = lists.flatten().to_numpy(), batch.column("tf").flatten().to_numpy()
            m = np.array([50 + 50 * n * n_docs // max(1, n_terms) for n in batch.column("n").to_pylist()], dtype=np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[at])
            keep = heavy[term] & (impact > 0)
            at, term, impact = at[keep], term[keep], impact[keep]
            sizes = np.bincount(at, minlength=len(sizes))
            length = np.sqrt(np.bincount(at, weights=impact.astype(np.float64) ** 2, minlength=len(sizes)).astype(np.float64))
            some = sizes > 0
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").filter(pa.array(some)), pa.array(length[some]),
                pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(impact.astype(np.int32))),
            ], names=["id", "length", "terms", "impacts"])

    return counted.mapInArrow(run, "id long, length double, terms array<int>, impacts array<int>")


class _Queries:
    """A block of queries, each with its terms, heaviest first, and its score to beat."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, beat: np.ndarray, k: int):
        self.terms = [t[np.argsort(-weights[t], kind="stable")] for t in terms]
        self.weights, self.beat, self.k = weights, beat.astype(np.int64), k
        # length of what stands from each coordinate on; the whole query's first
        self.tails = [np.sqrt(np.append(np.cumsum(weights[t[::-1]].astype(np.float64) ** 2)[::-1], 0.0)) for t in self.terms]
        self.lengths = np.array([x[0] for x in self.tails])
        self.best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def search(self, ids: np.ndarray, unknown: np.ndarray, length: np.ndarray, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """One bucket: rows in order of length, their vectors one after the other."""
        rows = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(term, kind="stable")
        by_term, by_row, by_impact = term[order], rows[order], impact[order].astype(np.float64)
        starts = np.searchsorted(by_term, np.arange(len(self.weights) + 1))
        ends, exact, squares = np.cumsum(sizes), np.zeros(len(self.weights), np.int64), length * length
        first = ends - sizes
        longest = length.max()
        for q in np.flatnonzero(self.lengths * longest * SLACK >= np.maximum(self.beat, 1)):
            terms, tails, beat = self.terms[q], self.tails[q], max(1, int(self.beat[q]))
            # Documents with none of the leading coordinates can't reach the score to beat.
            lead = int(np.argmax(tails * longest * SLACK < beat))
            cells = np.concatenate([np.arange(starts[t], starts[t + 1]) for t in terms[:lead]])
            if not len(cells):
                continue
            at, x = by_row[cells], by_impact[cells]
            w = np.repeat(self.weights[terms[:lead]], starts[terms[:lead] + 1] - starts[terms[:lead]])
            part, used = np.bincount(at, weights=x * w, minlength=len(sizes)), np.bincount(at, weights=x * x, minlength=len(sizes))
            left = np.sqrt(np.maximum(squares * SLACK - used, 0)) * tails[lead]
            alive = np.flatnonzero((part > 0) & ((part + left) * SLACK >= beat))
            if not len(alive):
                continue
            exact[terms] = self.weights[terms]
            take = np.concatenate([np.arange(first[r], ends[r]) for r in alive])
            scores = np.add.reduceat(exact[term[take]] * impact[take], np.concatenate([[0], np.cumsum(sizes[alive])[:-1]]))
            exact[terms] = 0
            good = scores >= beat
            if good.any():
                self._keep(int(q), scores[good], ids[alive[good]], unknown[alive[good]])

    def _keep(self, q: int, scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        if q in self.best:
            scores, ids, unknown = (np.concatenate(x) for x in zip(self.best[q], (scores, ids, unknown), strict=True))
        order = np.lexsort((ids, unknown, -scores))[: self.k]
        self.best[q] = scores[order], ids[order], unknown[order]
        if len(order) == self.k:
            self.beat[q] = max(int(self.beat[q]), int(scores[order[-1]]))


def _searched(impacts: DataFrame, numbers: list[int], terms: list[np.ndarray], weights: np.ndarray, beat: np.ndarray, k: int) -> DataFrame:
    """item, id, score: each task's best `k` documents per query; rows come in order of length, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(terms, weights, beat, k)
        for batch in batches:
            length = batch.column("length").to_numpy()
            sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            term, impact = batch.column("terms").flatten().to_numpy(), batch.column("impacts").flatten().to_numpy().astype(np.int64)
            ids, unknown = batch.column("id").fill_null(0).to_numpy(), batch.column("id").is_null().to_numpy(zero_copy_only=False)
            a = 0
            while a < len(length):
                b = a + max(LEAST_ROWS, min(BUCKET_ROWS, int(np.searchsorted(-length[a:], -RATIO * length[a], side="right"))))
                cut = slice(ends[a], ends[min(b, len(length))])
                queries.search(ids[a:b], unknown[a:b], length[a:b], sizes[a:b], term[cut], impact[cut])
                a = b
        for q, (scores, ids, unknown) in queries.best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), numbers[q]), pa.int64()), pa.array(ids, pa.int64(), mask=unknown), pa.array(scores, pa.int64())],
                names=["item", "id", "score"],
            )

    return impacts.mapInArrow(run, "item long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _longest(impacts: DataFrame) -> DataFrame:
    """About BUCKET_ROWS of the longest vectors, wherever they lie: any documents give scores that the best must reach. Of the level
    of length that is not needed whole, a share by hash."""
    level = F.floor(F.log(1 / RATIO, "length"))
    sizes = impacts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # some hundred levels at most
    above, last, share = 0, None, 1
    for r in sizes:
        last, share = r["level"], max(1, r["count"] // max(1, BUCKET_ROWS - above))
        above += r["count"]
        if above >= BUCKET_ROWS:
            break
    part = F.pmod(F.xxhash64("length", "id"), F.lit(share)) == 0
    return impacts.where((level > last) | ((level == last) & part)) if sizes else impacts


def _search_block(docs: DataFrame, pairs: list[tuple[int, str]], k: int) -> DataFrame:
    """The best of `docs` for the items in `pairs` (item, term)."""
    spark = docs.sparkSession
    numbers = sorted({q for q, _ in pairs})
    places = {t.encode(): i for i, t in enumerate(sorted({t for _, t in pairs}))}
    held: dict[int, list[int]] = {q: [] for q in numbers}
    for q, t in pairs:
        held[q].append(places[t.encode()])

    counted = written(_counted(docs, places), "terms")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # one row per term of the block
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(places))], dtype=np.int64)
    terms = [np.array([t for t in held[q] if weights[t] > 0 and t in df], dtype=np.int64) for q in numbers]

    impacts = written(_impacts(counted, n_docs, n_terms, weights > 0), "impacts")
    longest = _longest(impacts).sortWithinPartitions(F.desc("length"))
    first = _best(_searched(longest, numbers, terms, weights, np.zeros(len(numbers)), k), k).where(F.col("rank") == k)
    known = dict(first.select("item", "score").collect())  # one row per item of the block
    beat = np.array([known.get(q, 0) for q in numbers])
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = impacts.repartitionByRange(ranges, F.desc("length"), "id").sortWithinPartitions(F.desc("length"))
    return _best(_searched(ranged, numbers, terms, weights, beat, k), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The `k` documents of highest score for each row of `items`: item_id, rank (from 1), doc_id, score (above 0).

    Terms are runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased; null texts have none. Weights,
    impacts and scores as in the module's formulas, over all of `docs`. Equal scores go by ascending document id, unknown ids last;
    repeated documents are ranked one by one; a repeated item has its rows repeated. Document ids are whole numbers. Items and
    documents without terms have no rows; empty tables give an empty result. Further columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    thin = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    numbered = written(items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"), F.monotonically_increasing_id().alias("item")), "items")
    split = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({TERM})"), F.lit(1)))
    pairs = written(numbered.select("item", F.explode(split).alias("term")), "queries")
    blocks = -(-max(1, pairs.count()) // BLOCK_TERMS)
    mine = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = [_search_block(thin, [tuple(r) for r in pairs.where(mine == b).collect()], k) for b in range(blocks)]
    found = reduce(DataFrame.unionByName, parts).withColumnRenamed("id", "doc_id")
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
