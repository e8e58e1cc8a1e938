import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shoploom.llm.components import components
from shoploom.llm.queries import queries
from shoploom.llm.simhash import NearDuplicates, fingerprint, link_posting, links, posting_masks

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(prints))]


TEXTS = ["", None, " \n", "One", "ONE two", "one two three", "É one Two three four", "a b c " * 70_000, "x" * 200_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert value % 2**64 == fingerprint(b"one two three")


def test_every_close_pair_shares_a_posting():
    masks = posting_masks(5)
    for away in combinations(range(8), 3):
        assert any(all(not m >> (8 * k) & 0xFF for k in away) for m in masks)


def test_posting_forest_connects_what_links():
    rng = random.Random(3)
    prints = np.unique(np.array([rng.getrandbits(6) << 8 for _ in range(40)], dtype=np.uint64))
    a, b = link_posting(prints, 3)
    assert len(a) < len(prints)
    assert all(int(x ^ y).bit_count() <= 3 for x, y in zip(a, b, strict=True))


def test_links_against_all_pairs(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(300):
        one = rng.choice(prints)
        for _ in range(rng.choice((1, 3, 4))):
            one ^= 1 << rng.randrange(64)
        prints.append(one)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = components(links(spark.createDataFrame(signed, "print long"))).collect()
    root = {r.node % 2**64: r.root for r in found}
    by_root = {}
    for p, c in zip(prints, plain_components(prints), strict=True):
        by_root.setdefault(c, set()).add(root.get(p, f"alone {p}"))
    assert all(len(x) == 1 for x in by_root.values())
    assert len({next(iter(x)) for x in by_root.values()}) == len(by_root)


def test_long_chain_is_one_component(spark):
    pairs = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components(pairs).collect()} == {(k, 0) for k in range(201)}


def test_rows(spark):
    rows = [(k, t, "r", "f") for k, t in enumerate(TEXTS)] + [(None, "lone words here", "r", None), (3, "One", None, "f"), (3, "One", None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string, fingerprint string").repartition(3)
    near = NearDuplicates(df)
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = plain_components(prints)
    least = {g: min((rows[k][0] for k in range(len(rows)) if groups[k] == g and rows[k][0] is not None), default=None) for g in groups}
    expected = sorted((str(r[0]), f"{p:016x}", str(least[g])) for r, p, g in zip(rows, prints, groups, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in near.verdicts().collect()) == expected
    kept = near.kept()
    assert kept.columns == df.columns and kept.count() == len(set(groups))


def test_empty(spark):
    near = NearDuplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert near.verdicts().count() == 0 and near.kept().count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    least = plain_components(prints)
    expected = sorted((d.doc_id, f"{p:016x}", min(docs[k].doc_id for k in range(len(docs)) if least[k] == g)) for d, p, g in zip(docs, prints, least, strict=True))
    assert sorted(map(tuple, queries()["op8_simhash_near_dedup"](spark, FOLDER).collect())) == expected
