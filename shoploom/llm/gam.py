"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text are cut into bins. Cyclic boosting visits the features in turn and adds a shallow tree over the
bins of one feature to its lookup table; then it does the same for the pairs that promise the largest gain on what is
left. A text's score is the sum of the looked-up values.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import bounded_batches, nested, texts_of, unnested

#: Labelled rows that the model is fitted on at most: those whose hashed id is smallest.
TRAIN_ROWS = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, RIDGE = 32, 80, 30, 8, 0.15, 2.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "shouts", "stops", "non_ascii",
    "lines_per_word", "distinct_words", "distinct_pairs", "copied_lines", "short_words",
)


def _class(chars: bytes) -> np.ndarray:
    flags = np.zeros(256)
    flags[list(chars)] = 1
    return flags


_CLASSES = np.stack(
    [
        _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b"#*$%&|<>@^~_=+\\{}[]"), _class(b"!?"), _class(b".,;:"),
        _class(bytes(range(128, 256))),
    ],
    axis=1,
)


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text. A text without words has zeros for all ratios."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in zip(out, texts, strict=True):
        words = text.split()
        size, n = len(text), len(words)
        row[:2] = np.log1p(size), np.log1p(n)
        if not n:
            continue
        lines = [x for x in text.split(b"\n") if x.strip()]
        row[2] = sum(map(len, words)) / n
        row[3:9] = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _CLASSES / size
        row[9] = len(lines) / n
        row[10] = len(set(words)) / n
        row[11] = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
        row[12] = 1 - len(set(lines)) / len(lines)
        row[13] = sum(len(w) < 2 for w in words) / n
    return out


@dataclass(frozen=True)
class Model:
    edges: tuple[np.ndarray, ...]
    intercept: float
    tables: np.ndarray  # feature, bin
    pairs: tuple[tuple[int, int], ...]
    pair_tables: np.ndarray  # pair, bin, bin

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v, side="right") for e, v in zip(self.edges, values.T, strict=True)], axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        """The probability of label 1: bins are looked up and added for all rows at once."""
        bins = self.bins(values)
        total = self.intercept + self.tables[np.arange(bins.shape[1]), bins].sum(axis=1)
        for (a, b), looked_up in zip(self.pairs, self.pair_tables, strict=True):
            total += looked_up[bins[:, a], bins[:, b]]
        return 1 / (1 + np.exp(-total))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best place to cut a run of bins with these sums of gradients and curvatures, and its gain."""
    left_g, left_h = g.cumsum()[:-1], h.cumsum()[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    if not len(gain):
        return 0.0, 0
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values of a tree of this depth, per bin."""
    gain, at = _cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _two_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each row of sums per bin, what its best cut in two explains."""
    left_g, left_h = g.cumsum(axis=1), h.cumsum(axis=1)
    right_g, right_h = left_g[:, -1:] - left_g, left_h[:, -1:] - left_h
    return (left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE)).max(axis=1)


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts the first feature once and then the second on each side: its gain, and its values per pair of bins.

    Every first cut is tried with the best second cuts, as a pure interaction shows in no single feature.
    """
    above_g, above_h = g.cumsum(axis=0)[:-1], h.cumsum(axis=0)[:-1]
    explained = _two_leaves(above_g, above_h) + _two_leaves(g.sum(axis=0) - above_g, h.sum(axis=0) - above_h)
    at = int(explained.argmax()) + 1
    values = [np.tile(_tree(g[part].sum(axis=0), h[part].sum(axis=0), 1), (g[part].shape[0], 1)) for part in (slice(0, at), slice(at, None))]
    return float(explained.max() - g.sum() ** 2 / (h.sum() + RIDGE)), np.concatenate(values)


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Fitted by cyclic boosting. Without both labels the score is the smoothed share of label 1, 1/2 without rows."""
    n = len(labels)
    edges = tuple(np.unique(np.quantile(v, np.arange(1, BINS) / BINS)) if n else np.empty(0) for v in values.T)
    mean = (labels.sum() + 1) / (n + 2)
    empty = Model(edges, float(np.log(mean / (1 - mean))), np.zeros((len(FEATURES), BINS)), (), np.zeros((0, BINS, BINS)))
    if not 0 < labels.sum() < n:
        return empty
    bins, tables, total = empty.bins(values), empty.tables.copy(), np.full(n, empty.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(bins.shape[1]):
            g, h = (np.bincount(bins[:, f], weights=x, minlength=BINS) for x in slopes())
            step = RATE * _tree(g, h)
            tables[f] += step
            total += step[bins[:, f]]

    cells = {(a, b): bins[:, a] * BINS + bins[:, b] for a, b in combinations(range(bins.shape[1]), 2)}

    def sums(pair: tuple[int, int]) -> list[np.ndarray]:
        return [np.bincount(cells[pair], weights=x, minlength=BINS * BINS).reshape(BINS, BINS) for x in slopes()]

    pairs = sorted(cells, key=lambda p: -_pair_tree(*sums(p))[0])[:PAIRS]
    pair_tables = np.zeros((len(pairs), BINS, BINS))
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(pairs):
            step = RATE * _pair_tree(*sums(pair))[1]
            pair_tables[k] += step
            total += step.ravel()[cells[pair]]
    return Model(edges, empty.intercept, tables, tuple(pairs), pair_tables)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", id: str = "doc_id", label: str = "quality") -> Model:
    """Fitted on the documents of at most `rows` labels (0 or 1; others are left out), those with the smallest hashed id.

    Only these few features and labels come to the driver. Of documents with the same id one counts, by the hash of its text.
    """
    bounded_batches(docs.sparkSession)
    usable = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1) and _id is not null")
    chosen = usable.orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows)
    texts = docs.select(F.col(f"`{id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    schema = T.StructType([T.StructField("y", T.IntegerType()), *[T.StructField(f, T.DoubleType()) for f in FEATURES]])

    def measure(batches):
        for batch in batches:
            found = features(texts_of(batch, "_text"))
            columns = [pa.array(np.ascontiguousarray(c), pa.float64()) for c in found.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["y", *FEATURES])

    one = Window.partitionBy("_id").orderBy(F.xxhash64("_text"), "_text")
    named = texts.join(F.broadcast(chosen.select("_id").distinct()), "_id", "left_semi").withColumn("_nth", F.row_number().over(one)).where("_nth = 1")
    table = named.join(F.broadcast(chosen), "_id").select("_label", "_text").mapInArrow(measure, schema).toPandas()
    table = table.sort_values(list(table.columns))  # sums don't depend on the order in which tasks end
    return fit(table[list(FEATURES)].to_numpy(), table["y"].to_numpy(dtype=float))


def scored(docs: DataFrame, model: Model, text: str = "text", carried: dict[str, Column] | None = None) -> DataFrame:
    """`row` (all columns of `docs`), `carried`, `score` (higher: label 1 likelier) and `predicted`.

    A null text counts as empty and is scored like any other; repeated rows are scored alike.
    """
    thin = nested(docs, **(carried or {}))
    keep = thin.columns
    schema = T.StructType([*[thin.schema[c] for c in keep], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            score = model.score(features(texts_of(batch, text)))
            columns = [*batch.columns, pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    return thin.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` that the model predicts to have label 1, with their columns."""
    return unnested(scored(docs, model, text).where("predicted = 1"))
