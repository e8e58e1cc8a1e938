"""FarmHash Fingerprint64, the hash behind a warehouse's `farm_fingerprint`: ids made there and here are the same.

The algorithm has a formula per class of length (0 to 16 bytes in three steps, to 32, to 64, longer ones in rounds of 64 bytes).
It multiplies and adds modulo 2^64, which Spark's checked long arithmetic can't express, so a batch of texts is hashed at
once with unsigned numpy arrays, one class of length after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

U = np.uint64
# Fixed values of the algorithm.
K0, K1, K2 = U(0xC3A5C85C97CB3127), U(0xB492B66FBE98F273), U(0x9AE16A3B2F90404F)


def _rotate(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> U(n)) | (x << U(64 - n))


def _mix(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> U(47))


def _join(u: np.ndarray, v: np.ndarray, mul: np.ndarray) -> np.ndarray:
    a = _mix((u ^ v) * mul)
    return _mix((v ^ a) * mul) * mul


class _Batch:
    """Texts laid end to end; words are read at any byte."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        n = len(data) + 1
        self.words = np.ndarray((n,), "<u8", self.data, strides=(1,))
        self.halves = np.ndarray((n,), "<u4", self.data, strides=(1,))

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.words[at]

    def tiny(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """1 to 3 bytes."""
        first, middle, last = (self.data[x].astype(U) for x in (at, at + n // 2, at + n - 1))
        return _mix(((first + (middle << U(8))) * K2) ^ ((n.astype(U) + (last << U(2))) * K0)) * K2

    def small(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """4 to 7 bytes."""
        first, last = self.halves[at].astype(U), self.halves[at + n - 4].astype(U)
        return _join(n.astype(U) + (first << U(3)), last, K2 + n.astype(U) * U(2))

    def short(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """8 to 16 bytes."""
        mul = K2 + n.astype(U) * U(2)
        a, b = self.word(at) + K2, self.word(at + n - 8)
        return _join(_rotate(b, 37) * mul + a, (_rotate(a, 25) + b) * mul, mul)

    def _ends(self, at: np.ndarray, n: np.ndarray, times: np.uint64) -> tuple[np.ndarray, ...]:
        mul = K2 + n.astype(U) * U(2)
        a, b = self.word(at) * times, self.word(at + 8)
        c, d = self.word(at + n - 8) * mul, self.word(at + n - 16) * K2
        return mul, a, _rotate(a + b, 43) + _rotate(c, 30) + d, a + _rotate(b + K2, 18) + c

    def medium(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """17 to 32 bytes."""
        mul, _, u, v = self._ends(at, n, K1)
        return _join(u, v, mul)

    def long(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """33 to 64 bytes."""
        mul, a, y, v = self._ends(at, n, K2)
        z = _join(y, v, mul)
        e, f = self.word(at + 16) * mul, self.word(at + 24)
        g, h = (y + self.word(at + n - 32)) * mul, (z + self.word(at + n - 24)) * mul
        return _join(_rotate(e + f, 43) + _rotate(g, 30) + h, e + _rotate(f + a, 18) + g, mul)

    def _weak(self, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, x, y, z = (self.word(at + k) for k in (0, 8, 16, 24))
        a = a + w
        b = _rotate(b + a + z, 21)
        both = a + x + y
        return both + z, b + _rotate(both, 44) + a

    def _round(self, at, state, mul, nines):
        x, y, z, v, w = state
        x = _rotate(x + y + v[0] + self.word(at + 8), 37) * mul
        y = _rotate(y + v[1] + self.word(at + 48), 42) * mul
        x = x ^ (w[1] * nines)
        y = y + v[0] * nines + self.word(at + 40)
        z = _rotate(z + w[0], 33) * mul
        v = self._weak(at, v[1] * mul, x + w[0])
        w = self._weak(at + 32, z + w[1], y + self.word(at + 16))
        return z, y, x, v, w

    def longer(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Over 64 bytes. Texts drop out of the rounds as they end."""
        seed = U(81)
        y = np.full(len(at), seed * K1 + U(113))
        z = _mix(y * K2 + U(113)) * K2
        none = np.zeros(len(at), U)
        state = np.stack([np.full(len(at), seed * K2) + self.word(at), y, z, none, none, none, none])
        rounds = (n - 1) // 64
        for k in range(int(rounds.max())):
            on = np.flatnonzero(rounds > k)
            s = state[:, on]
            x, y, z, v, w = self._round(at[on] + 64 * k, (s[0], s[1], s[2], (s[3], s[4]), (s[5], s[6])), K1, U(1))
            state[:, on] = np.stack([x, y, z, *v, *w])
        x, y, z, v0, v1, w0, w1 = state
        mul = K1 + ((z & U(0xFF)) << U(1))
        w0 = w0 + ((n - 1) & 63).astype(U)
        v0 = v0 + w0
        w0 = w0 + v0
        x, y, z, v, w = self._round(at + n - 64, (x, y, z, (v0, v1), (w0, w1)), mul, U(9))
        return _join(_join(v[0], w[0], mul) + _mix(y) * K0 + z, _join(v[1], w[1], mul) + x, mul)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """Fingerprint64 of each text's UTF-8 bytes as signed 64-bit integers; nulls count as empty."""
    kept = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(kept.buffers()[1], dtype=np.int64)[kept.offset : kept.offset + len(kept) + 1]
    at, n = offsets[:-1] - offsets[0], np.diff(offsets)
    held = kept.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.empty(0, np.uint8)
    batch = _Batch(data)
    out = np.full(len(n), K2)
    classes = ((1, 3, batch.tiny), (4, 7, batch.small), (8, 16, batch.short), (17, 32, batch.medium), (33, 64, batch.long), (65, None, batch.longer))
    with np.errstate(over="ignore"):
        for low, high, formula in classes:
            some = np.flatnonzero((n >= low) & ((n <= high) if high else True))
            if len(some):
                out[some] = formula(at[some], n[some])
    return out.view(np.int64)


def farm_fingerprint(text: Column | str) -> Column:
    """`farm_fingerprint` of a text column as a long; null for null."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(fingerprints(pa.array(batch, pa.large_string())))

    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.isNotNull(), hashed(F.coalesce(column, F.lit(""))))
