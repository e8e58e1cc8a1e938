import numpy as np
import pytest
from pyspark.sql import functions as F

from shoploom.llm import gam
from shoploom.llm.common import in_fold
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"


def test_tables_learn_a_pair(spark):
    rng = np.random.default_rng(0)
    values = rng.random((4000, len(gam.FEATURES)))
    labels = ((values[:, 3] > 0.5) ^ (values[:, 5] > 0.5)).astype(float)
    model = gam.fit(values, labels)
    assert (3, 5) in model.pairs
    assert ((model.score(values) >= 0.5) == labels).mean() > 0.97


def test_score_is_a_sum_of_looked_up_values():
    rng = np.random.default_rng(1)
    values = rng.random((500, len(gam.FEATURES)))
    model = gam.fit(values, (values[:, 0] + values[:, 1] * values[:, 2] > 0.8).astype(float))
    bins = model.bins(values)
    for row, score in zip(bins[:20], model.score(values), strict=False):
        total = model.intercept + sum(model.tables[f, b] for f, b in enumerate(row))
        total += sum(t[row[a], row[b]] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("labels, expected", [([], 0.5), ([1.0] * 8, 0.9), ([0.0] * 8, 0.1)])
def test_few_labels(labels, expected):
    assert gam.fit(np.zeros((len(labels), len(gam.FEATURES))), np.array(labels)).score(np.zeros((1, len(gam.FEATURES))))[0] == pytest.approx(expected, abs=0.09)


def test_odd_rows(spark):
    rows = [(1, None, "s"), (1, None, "s"), (None, "", "s"), (2, " ", None), (3, "x" * 200_000, "s"), (4, "of the word", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = gam.train(docs, spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (3, 7)], "doc_id long, quality int"))
    found = gam.scored(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert gam.accepted(docs, model).columns == docs.columns
    assert gam.scored(docs.limit(0), gam.train(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int"))).count() == 0


def test_training_rows_are_bounded(spark, monkeypatch):
    """Thousands of documents with the id of the one label that is used count as one."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(3000)] + [(2, "other")], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(gam, "fit", lambda x, y: seen.append(len(y)))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    for n in (1, 2):
        gam.train(docs, labels, rows=n)
    assert seen == [1, 2]


def test_held_out_accuracy(spark):
    found = queries()["op2_quality_classifier"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found.count() == docs.count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(in_fold(F.col("doc_id"), 3, 1))
    held = found.where("held_out").join(labels, "doc_id")
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[1] > 80 and right[0] > 0.97
