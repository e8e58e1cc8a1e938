import hashlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from shoploom.llm.exact import ExactDuplicates, golomb_decode, golomb_encode

SCHEMA = "doc_id long, text string, keep_id string, rid int"


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_golomb_round_trip(values):
    values = np.array(sorted(values), dtype=np.uint64)
    assert np.array_equal(golomb_decode(len(values), *golomb_encode(values)), values)


def test_golomb_is_smaller():
    values = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    assert len(golomb_encode(values)[2]) < 0.85 * 8 * len(values)


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("parts, owner_rows", [(1, 1000), (5, 3)])
def test_against_brute_force(spark, parts, owner_rows):
    texts = ["a b", "A B", None, "", " ", "É", "é", "x" * 300_000, "X" * 300_000, "a b", "only"]
    rows = [(i, t, "own", 7) for i, t in enumerate(texts)] + [(None, "a b", None, None), (3, "", "own", 1), (20, "only two", None, 0), (20, "only two", None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = ExactDuplicates(df, rows_per_owner=owner_rows)
    verdicts = found.verdicts().collect()
    assert len(verdicts) == len(rows)
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc)
    expected = sorted(
        (str(doc), max(d for d in groups[lower(text)] if d is not None), len(groups[lower(text)]), hashlib.sha256(lower(text)).hexdigest())
        for doc, text, *_ in rows
    )
    assert sorted((str(v.doc_id), v.keep_id, v.group_size, v.text_sha256) for v in verdicts) == expected
    assert all(v.doc_id == v.keep_id for v in verdicts if v.kept)
    assert sum(v.kept for v in verdicts) == len(groups)
    kept = found.kept()
    assert kept.columns == df.columns
    assert sorted(lower(r.text) for r in kept.collect()) == sorted(groups)


def test_empty(spark):
    found = ExactDuplicates(spark.createDataFrame([], SCHEMA))
    assert found.verdicts().count() == 0 and found.kept().count() == 0
