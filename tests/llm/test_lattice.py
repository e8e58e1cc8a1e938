import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoploom.llm.lattice import SPACE_MARK, Memory, Pieces, _ids, _paths, decode, decoded, lattice, piece_counts, processor, sample, sampled
from shoploom.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = Pieces(PATH, np.arange(processor(PATH).vocab_size(), dtype=float)[::-1] ** 2)


def all_segmentations(text, pieces=PIECES):
    """Every way to write the text in pieces, with its probability among all."""
    known = {n: k for k, n in enumerate(pieces.names) if not (processor(PATH).is_byte(k) or processor(PATH).is_control(k) or processor(PATH).is_unknown(k))}

    def ways(chars):  # None stands for a space
        if not chars:
            return [((), 0.0)]
        out = []
        for n in range(1, len(chars) + 1):
            name = "".join(c or SPACE_MARK for c in chars[:n]) if SPACE_MARK not in chars[:n] else None
            ids = (known[name],) if name in known else tuple(pieces.spelled(chars[0])) if n == 1 else None
            if ids:
                out += [(ids + rest, pieces.logs[list(ids)].sum() + log) for rest, log in ways(chars[n:])]
        return out

    found = ways([None if c == " " else c for c in " " + text]) if text else [((), 0.0)]
    total = math.log(sum(math.exp(x) for _, x in found))
    return {ids: x - total for ids, x in found}


@pytest.mark.parametrize("text", ["the", "a b", "they are", "é☃", "", " ", "x  y", "a   ", "\u2581 \u2581a"])
def test_probabilities_against_all_segmentations(text):
    expected = all_segmentations(text)
    found = sample([text], [1], PIECES, samples=len(expected) + 3)[0]
    assert len(found) == len(expected) and {tuple(f[0]) for f in found} == set(expected)
    for ids, log, _, log_inclusion in found:
        assert log == pytest.approx(expected[tuple(ids)], abs=1e-6) and log_inclusion == 0
    assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)


def test_samples_follow_the_distribution():
    """Over many keys the first sample is drawn by probability, and the first two as without replacement."""
    text, n = "the an", 20_000
    expected = all_segmentations(text)
    found = sample([text] * n, list(range(n)), PIECES, samples=2)
    first = Counter(tuple(f[0][0]) for f in found)
    both = Counter((tuple(f[0][0]), tuple(f[1][0])) for f in found)
    for ids, log in expected.items():
        p = math.exp(log)
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4
        for other, other_log in expected.items():
            if other != ids:
                q = p * math.exp(other_log) / (1 - p)
                assert abs(both[ids, other] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-4


def test_inclusion_scores_estimate_without_bias():
    """The sum of probability over inclusion score of the samples has mean 1."""
    n = 20_000
    found = sample(["the an"] * n, list(range(n)), PIECES, samples=2)
    sums = [sum(math.exp(log - inclusion) for _, log, _, inclusion in own) for own in found]
    assert np.mean(sums) == pytest.approx(1, abs=5 * np.std(sums) / math.sqrt(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_round_trip_and_distinct(texts):
    for text, own in zip(texts, sample(texts, list(range(len(texts))), PIECES), strict=True):
        assert len({tuple(f[0]) for f in own}) == len(own) >= 1
        assert all(decode(f[0], PIECES) == text for f in own)


def test_row_key_alone_decides():
    alone = sample(["some words here"], [5], PIECES)[0]
    assert sample(["other", "some words here"], [9, 5], PIECES)[1] == alone
    assert sample(["some words here"], [6], PIECES)[0] != alone


def test_ways_of_hardly_any_probability_come_too():
    """A piece of nearly all weight leaves the other ways of its word a share of 1e-14 and less."""
    counts = np.zeros(processor(PATH).vocab_size())
    counts[processor(PATH).piece_to_id(SPACE_MARK + "the")] = 1e15
    pieces = Pieces(PATH, counts)
    expected = all_segmentations("the", pieces)
    assert sorted(expected.values())[-2] < math.log(1e-12)
    found = sample(["the"], [3], pieces, samples=len(expected) + 2)[0]
    assert {tuple(f[0]) for f in found} == set(expected)
    for ids, log, _, _ in found:
        assert log == pytest.approx(expected[tuple(ids)], abs=1e-6)


def test_shares_sum_to_one():
    found = lattice(["the", "  Straße☃"], PIECES)
    share = np.exp(found.log)
    assert np.add.reduceat(share, found.first[:-1]) == pytest.approx(1)
    assert np.exp(found.others) + share == pytest.approx(1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ab\n☃▁é"), max_size=20), max_size=6))
def test_counts_are_those_of_the_plain_encoding(spark, texts):
    plain = Counter(i for t in texts for i in processor(PATH).encode(t))
    found = piece_counts(spark.createDataFrame([(t,) for t in texts], "text string"), PATH)
    assert {k: n for k, n in enumerate(found.tolist()) if n} == plain


def test_decoded(spark):
    """Sampled ids give whole texts back; other columns stay, one of the new name is replaced."""
    rows = [(1, "a  b \u2581☃"), (2, ""), (3, None), (4, " \n\n lead"), (4, " \n\n lead")]
    found = sampled(spark.createDataFrame(rows, "doc_id long, text string"), PATH, np.ones(processor(PATH).vocab_size()))
    back = decoded(found.withColumn("Text", found["sample"]), PATH)
    assert back.columns == [*found.columns, "text"]
    assert {(r.doc_id, r.text) for r in back.collect()} == {(k, t or "") for k, t in rows}
    odd = spark.createDataFrame([(1, None), (2, []), (3, processor(PATH).encode("more words"))], "k int, pieces array<int>")
    assert {r.k: r.out for r in decoded(odd, PATH, "pieces", "out").collect()} == {1: None, 2: "", 3: "more words"}
    assert decoded(odd.limit(0), PATH, "pieces", "out").count() == 0
    with pytest.raises(Exception, match="outside the vocabulary"):
        decoded(spark.createDataFrame([([10**6],)], "ids array<int>"), PATH).collect()


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "x" * 20_000), (3, "a word " * 5000), (4, "\n\t ")]
    found = sampled(spark.createDataFrame(rows, "doc_id long, text string"), PATH, np.ones(processor(PATH).vocab_size())).collect()
    by_doc = Counter(r.doc_id for r in found)
    assert by_doc[1] == 2 and by_doc[None] == 1 and by_doc[2] == by_doc[3] == 3
    for r in found:
        assert decode(r.ids, PIECES) == (dict(rows)[r.doc_id] or "")
    assert sampled(spark.createDataFrame([], "doc_id long, text string"), PATH, np.ones(processor(PATH).vocab_size())).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = piece_counts(docs, PATH)
    plain = Counter(i for d in docs.collect() for i in processor(PATH).encode(d.text))
    assert {k: n for k, n in enumerate(counts.tolist()) if n} == plain
    found = queries()["op10_sentencepiece_sampling"](spark, FOLDER).collect()
    pieces, texts = Pieces(PATH, counts), {d.doc_id: d.text for d in docs.collect()}
    expected = {k: sample([t], [k], pieces)[0] for k, t in texts.items()}
    assert len(found) == sum(map(len, expected.values()))
    for r in found:
        ids, log, value, inclusion = expected[r.doc_id][r.sample - 1]
        assert (r.ids, r.log_prob, r.perturbed, r.log_inclusion) == (ids, log, value, inclusion)
        assert r.n_pieces == len(ids) and r.round_trip


def test_memory_from_part_to_part_changes_nothing(monkeypatch):
    texts = ["some words", "Straße ☃ words", "  ☃é☂ more", "some ☂ more words", "", "last"]
    expected = sample(texts, list(range(6)), PIECES)
    for most in (10, 10**6):
        monkeypatch.setattr("shoploom.llm.lattice._MEMORY_EDGES", most)
        memory = Memory(PIECES)
        for k, text in enumerate(texts):
            found, paths, left = _paths([text], [k], memory, 3, 42)
            ids, ends = _ids(found, [p.edge for p in paths[0]])
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == [e[0] for e in expected[k]]
            assert [(p.log, p.value) for p in paths[0]] == [(e[1], e[2]) for e in expected[k]]


def test_recurring_units_stay_in_memory(monkeypatch):
    """Units that come once don't push out one of every part: it is built when met and when met again, no more."""
    built = Counter()

    def counting(words, pieces):
        built.update(words)
        return lattice(words, pieces)

    monkeypatch.setattr("shoploom.llm.lattice.lattice", counting)
    monkeypatch.setattr("shoploom.llm.lattice._MEMORY_EDGES", 1500)
    memory = Memory(PIECES)
    for part in range(12):
        memory.units(["often " + " ".join(f"{part}x{k}" for k in range(40))])
    assert built["often"] <= 2 and built["3x7"] == 1


def test_units_longer_than_sums_reach():
    """Behind `depth` characters masses are taken in logs: the same shares and sums."""
    words, near = ["the", "x" * 300, "  Straße☃", ""], Pieces(PATH, np.ones(len(PIECES.logs)))
    expected, near.depth = lattice(words, near), 2
    found = lattice(words, near)
    for name in ("log", "others", "share"):
        assert getattr(found, name) == pytest.approx(getattr(expected, name), abs=1e-9)
    assert expected.ids.tolist() == found.ids.tolist()


@pytest.mark.parametrize("texts", [["a b a c d e f g", "b"], ["", None, " ", "x  y x"], ["a " * 9 + "b"] * 3])
def test_counts_of_words_that_come_equally_often(spark, texts):
    plain = Counter(i for t in texts for i in processor(PATH).encode(t or ""))
    found = piece_counts(spark.createDataFrame([(t,) for t in texts], "text string"), PATH)
    assert {k: n for k, n in enumerate(found.tolist()) if n} == plain
