"""Fingerprint64 against published values and a plain version that hashes one text at a time."""

import random

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoploom.functions.farm import farm_fingerprint, fingerprints

# Published fingerprints, of the hash's own test suite and of the SQL function's documentation.
PUBLISHED = {
    "": 0x9AE16A3B2F90404F, "a": 0xB3454265B6DF75E3, "ab": 0xAA8D6E5242ADA51E, "abc": 0x24A5B3A074E7F369, "abcd": 0x1A5502DE4A1F8101,
    "abcde": 0xC22F4663E54E04D4, "abcdef": 0xC329379E6A03C2CD, "abcdefg": 0x3C40C92B1CCB7355, "abcdefgh": 0xFEE9D22990C82909,
    "abcdefghi": 0x332C8ED4DAE5BA42, "abcdefghij": 0x8A3ABB6A5F3FB7FB, "Discard medicine more than two years old.": 0xE8F89AB6DF9BDD25,
    "He who has a shady past knows that nice guys finish last.": 0x786D7E1987023CA9, "I wouldn't marry him with a ten foot pole.": 0xA9961670CE2A46D9,
    "1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312,
}

K0, K1, K2, M = 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, (1 << 64) - 1


def rot(x, n):
    return ((x >> n) | (x << (64 - n))) & M


def mix(x):
    return x ^ (x >> 47)


def hash16(u, v, mul):
    return mix((v ^ mix((u ^ v) * mul & M)) * mul & M) * mul & M


def weak(s, i, a, b):
    w, x, y, z = (int.from_bytes(s[i + k : i + k + 8], "little") for k in (0, 8, 16, 24))
    a += w
    b = rot((b + a + z) & M, 21)
    c = a
    a += x + y
    b += rot(a & M, 44)
    return (a + z) & M, (b + c) & M


def plain(s):
    n = len(s)

    def at(i, size=8):
        i = i if i >= 0 else n + i
        return int.from_bytes(s[i : i + size], "little")

    if n == 0:
        return K2
    if n < 4:
        return mix(((s[0] + (s[n >> 1] << 8)) * K2 ^ (n + (s[-1] << 2)) * K0) & M) * K2 & M
    mul = (K2 + 2 * n) & M
    if n < 8:
        return hash16(n + (at(0, 4) << 3), at(-4, 4), mul)
    if n <= 16:
        a, b = (at(0) + K2) & M, at(-8)
        return hash16((rot(b, 37) * mul + a) & M, (rot(a, 25) + b) * mul & M, mul)
    if n <= 64:
        a, b, c, d = at(0) * (K1 if n <= 32 else K2) & M, at(8), at(-8) * mul & M, at(-16) * K2 & M
        y, v = (rot((a + b) & M, 43) + rot(c, 30) + d) & M, (a + rot((b + K2) & M, 18) + c) & M
        z = hash16(y, v, mul)
        if n <= 32:
            return z
        e, f, g, h = at(16) * mul & M, at(24), (y + at(-32)) * mul & M, (z + at(-24)) * mul & M
        return hash16((rot((e + f) & M, 43) + rot(g, 30) + h) & M, (e + rot((f + a) & M, 18) + g) & M, mul)
    x, y = 81, (81 * K1 + 113) & M
    z = mix((y * K2 + 113) & M) * K2 & M
    v, w = (0, 0), (0, 0)
    x = (x * K2 + at(0)) & M
    for i in range(0, (n - 1) // 64 * 64, 64):
        x, y = rot((x + y + v[0] + at(i + 8)) & M, 37) * K1 & M, rot((y + v[1] + at(i + 48)) & M, 42) * K1 & M
        x, y, z = x ^ w[1], (y + v[0] + at(i + 40)) & M, rot((z + w[0]) & M, 33) * K1 & M
        v, w = weak(s, i, v[1] * K1 & M, (x + w[0]) & M), weak(s, i + 32, (z + w[1]) & M, (y + at(i + 16)) & M)
        z, x = x, z
    mul, i = (K1 + ((z & 0xFF) << 1)) & M, n - 64
    w = ((w[0] + ((n - 1) & 63)) & M, w[1])
    v = ((v[0] + w[0]) & M, v[1])
    w = ((w[0] + v[0]) & M, w[1])
    x, y = rot((x + y + v[0] + at(i + 8)) & M, 37) * mul & M, rot((y + v[1] + at(i + 48)) & M, 42) * mul & M
    x, y, z = x ^ (w[1] * 9 & M), (y + v[0] * 9 + at(i + 40)) & M, rot((z + w[0]) & M, 33) * mul & M
    v, w = weak(s, i, v[1] * mul & M, (x + w[0]) & M), weak(s, i + 32, (z + w[1]) & M, (y + at(i + 16)) & M)
    z, x = x, z
    return hash16((hash16(v[0], w[0], mul) + mix(y) * K0 + z) & M, (hash16(v[1], w[1], mul) + x) & M, mul)


def test_published_values():
    found = fingerprints(pa.array(list(PUBLISHED)))
    assert [int(x) & M for x in found] == [x & M for x in PUBLISHED.values()]
    assert [plain(t.encode()) for t in PUBLISHED] == [x & M for x in PUBLISHED.values()]


def test_every_length():
    """All classes of length in one batch, also a slice of it."""
    r = random.Random(1)
    texts = ["".join(r.choices("abc|é 1", k=n)) for n in [*range(300), 1000, 5000, 64, 65, 128, 129]]
    r.shuffle(texts)
    want = [plain(t.encode()) for t in texts]
    assert [int(x) & M for x in fingerprints(pa.array(texts))] == want
    assert [int(x) & M for x in fingerprints(pa.array(texts).slice(100, 50))] == want[100:150]


@given(st.lists(st.one_of(st.none(), st.text())))
def test_any_texts(texts):
    assert [int(x) & M for x in fingerprints(pa.array(texts, pa.string()))] == [plain((t or "").encode()) for t in texts]


def test_column(spark):
    texts = [None, "", "1footrue", "x" * 1_000_000, "ü|1"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.f for r in df.select("t", farm_fingerprint("t").alias("f")).collect()}
    assert found[None] is None and all(found[t] & M == plain(t.encode()) for t in texts if t is not None)
    assert df.limit(0).select(farm_fingerprint(F.col("t"))).count() == 0


def test_sql_statement_agrees():
    """The check statement's own steps, for keys up to 64 bytes."""
    duckdb = pytest.importorskip("duckdb")
    import oracle.models  # noqa: F401
    from oracle.sql import CTES

    r = random.Random(2)
    keys = sorted({"".join(r.choices("abc|é 1", k=1 + i % 60)) for i in range(300)})
    keys = [k for k in keys if len(k.encode()) <= 64]
    con = duckdb.connect()
    con.execute("CREATE TABLE k12_rows (household_key VARCHAR)")
    con.executemany("INSERT INTO k12_rows VALUES (?)", [(k,) for k in keys])
    found = dict(con.execute(f"WITH farm_keys AS ({CTES['farm_keys']}) SELECT * FROM ({CTES['farm_ids']})").fetchall())
    assert found == dict(zip(keys, map(int, fingerprints(pa.array(keys))), strict=True))
