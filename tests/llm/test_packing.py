import bisect
import itertools
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shoploom.llm.packing import fullest, pack_documents, packed, plan, token_pieces, tokens_of
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


def ids(text):
    return np.frombuffer(tokens_of(PATH, 0)(text), dtype="<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["the", "a's", "'s", " ", "  ", "\n", " ", "\x1c", "é", "x1,", "😀", "<|endoftext|>", "\t", "Straße", "don't", "12"])).map(" ".join) | st.text())
def test_ids_are_those_of_the_tokenizer(text):
    assert ids(text) == plain_ids(text)


@pytest.mark.parametrize("text", ["", " ", " a", "a ", "a\n b", "x" * 50_000, " <|endoftext|> b", "é " * 5000])
def test_ids_of_odd_texts(text):
    assert ids(text) == plain_ids(text)


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 600_000 + "b", "<|endoftext|>" + "\t " * 500_000])
def test_long_runs_of_white_space(text):
    assert ids(text) == plain_ids(text)


def test_other_vocabularies_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        found = json.load(file)
    for part, value in (("normalizer", {"type": "NFC"}), ("pre_tokenizer", found["pre_tokenizer"] | {"add_prefix_space": True}),
                        ("model", found["model"] | {"merges": found["model"]["merges"][::-1]})):
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps(found | {part: value}))
        with pytest.raises(ValueError, match="byte-level"):
            tokens_of(str(path), 0)


def test_lengths_without_a_place(spark):
    rows = [(None,), (0,), (-1,), (11,), (10,), (4,), (4,), (2,)]
    found = packed(spark.createDataFrame(rows, "length int"), capacity=10).collect()
    assert len(found) == len(rows)
    assert {r.length for r in found if r.sequence_id is None and r.offset is None} == {None, 0, -1, 11}
    assert len({r.sequence_id for r in found if r.sequence_id is not None}) == 2
    assert packed(spark.createDataFrame([(None,)], "length int")).first().sequence_id is None


@given(st.lists(st.integers(1, 30), max_size=9), st.integers(0, 40))
def test_fullest_against_all_subsets(lengths, room):
    counts = np.bincount(np.array(lengths, dtype=int), minlength=41)
    found = fullest(counts, room)
    best = max(sum(c) for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if sum(c) <= room)
    assert sum(a * n for a, n in found) == best and all(counts[a] >= n for a, n in found)


@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_places_all(lengths):
    counts = np.bincount(np.array(lengths, dtype=int), minlength=21)
    bins, ranks = defaultdict(list), defaultdict(list)
    for length, a, b, first, each, offset in plan(counts):
        for r in range(a, b):
            ranks[length].append(r)
            bins[first + (r - a) // each].append((offset + (r - a) % each * length, length))
    assert all(sorted(ranks[k]) == list(range(n)) for k, n in enumerate(counts) if n)
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 20


def check_layout(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, x)
        bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else capacity) - x)
    return len(rooms)


def test_few_bins_on_random_lengths(spark):
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(3000)]
    df = spark.createDataFrame([(x, "o") for x in lengths], "length int, offset string").repartition(7)
    rows = packed(df, capacity=100).collect()
    assert len(rows) == 3000 and check_layout(rows, 100) <= best_fit_decreasing(lengths, 100) + 1


def test_one_length_for_all(spark):
    rows = packed(spark.range(2001).selectExpr("id", "40 AS length").repartition(5), capacity=100).collect()
    assert check_layout(rows, 100) == 1001


def test_rows(spark):
    docs = [(1, None), (1, None), (None, ""), (2, "word " * 5000), (3, "x" * 60_000), (4, "a")]
    found = pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), PATH, ids=True).collect()
    check_layout(found, 2048)
    by_doc = defaultdict(list)
    for r in found:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id].append(r)
    assert [r.length for r in by_doc[1]] == [1, 1]
    for doc, text in docs[3:]:
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == plain_ids(text)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        assert all(r.length == 2048 for r in pieces[1:])


def test_empty(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark):
    found = queries()["op6_best_fit_packing"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    total = {d.doc_id: plain_ids(d.text) for d in docs}
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == total.keys()
    for doc, ids in total.items():
        assert sum(r.length for r in pieces[doc]) == len(ids) and (len(ids) > 2048 or len(pieces[doc]) == 1)
        for r in pieces[doc]:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert check_layout(found, 2048) <= -(-sum(map(len, total.values())) // 2048) + 2
