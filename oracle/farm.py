"""Fingerprint64 in SQL, step by step on 128-bit integers, for comparing household ids.

Keys up to 64 bytes; a longer one gets no id here and so would show as a difference.
"""

from __future__ import annotations

from oracle.sql import cte

M = "18446744073709551616::UHUGEINT"
K0, K1, K2 = (f"{k}::UHUGEINT" for k in (14097894508562428199, 13011662864482103923, 11160318154034397263))


def _add(*terms: str) -> str:
    return f"(({' + '.join(terms)}) % {M})"


def _mul(a: str, b: str) -> str:
    return f"(({a} * {b}) % {M})"


def _rotate(x: str, n: int) -> str:
    return f"({x} // {2**n}::UHUGEINT + ({x} % {2**n}::UHUGEINT) * {2**(64 - n)}::UHUGEINT)"


def _xor(a: str, b: str) -> str:
    return f"xor({a}::UBIGINT, {b}::UBIGINT)::UHUGEINT"


def _read(at: str, size: int) -> str:
    """Little-endian number of `size` bytes from byte `at` of the hex text `h`."""
    return f"('0x' || {' || '.join(f'substr(h, (2 * ({at} + {k}) + 1)::BIGINT, 2)' for k in reversed(range(size)))})::UBIGINT::UHUGEINT"


def _steps(source: str, steps: list[tuple[str, str]]) -> str:
    for name, value in steps:
        source = f"(SELECT *, {value} AS {name} FROM {source})"
    return source


def _joined(u: str, v: str, out: str) -> list[tuple[str, str]]:
    shifted = lambda x: _xor(x, f"({x} // {2**47}::UHUGEINT)")
    return [
        (f"{out}_1", _mul(_xor(u, v), "mul")), (f"{out}_2", shifted(f"{out}_1")), (f"{out}_3", _mul(_xor(v, f"{out}_2"), "mul")),
        (f"{out}_4", shifted(f"{out}_3")), (out, _mul(f"{out}_4", "mul")),
    ]


def _class(low: int, high: int, steps: list[tuple[str, str]]) -> str:
    keys = f"(SELECT k, h, n, {_add(K2, '2 * n')} AS mul FROM farm_keys WHERE n BETWEEN {low} AND {high})"
    return f"SELECT k, found FROM {_steps(keys, steps)}"


_ENDS = [
    ("b", _read("8", 8)), ("c", _mul(_read("n - 8", 8), "mul")), ("d", _mul(_read("n - 16", 8), K2)), ("ab", _add("a", "b")),
    ("u", _add(_rotate("ab", 43), _rotate("c", 30), "d")), ("bk", _add("b", K2)), ("v", _add("a", _rotate("bk", 18), "c")),
]
_TINY = [
    ("y", f"{_read('0', 1)} + {_read('n // 2', 1)} * 256"), ("z", f"n + {_read('n - 1', 1)} * 4"), ("x", _xor(_mul("y", K2), _mul("z", K0))),
    ("found", _mul(_xor("x", f"(x // {2**47}::UHUGEINT)"), K2)),
]
_SMALL = [("u", f"n + {_read('0', 4)} * 8"), ("v", _read("n - 4", 4)), *_joined("u", "v", "found")]
_SHORT = [
    ("a", _add(_read("0", 8), K2)), ("b", _read("n - 8", 8)), ("u", _add(_mul(_rotate("b", 37), "mul"), "a")),
    ("v", _mul(_add(_rotate("a", 25), "b"), "mul")), *_joined("u", "v", "found"),
]
_MEDIUM = [("a", _mul(_read("0", 8), K1)), *_ENDS, *_joined("u", "v", "found")]
_LONG = [
    ("a", _mul(_read("0", 8), K2)), *_ENDS, *_joined("u", "v", "z"), ("e", _mul(_read("16", 8), "mul")), ("f", _read("24", 8)),
    ("g", _mul(_add("u", _read("n - 32", 8)), "mul")), ("hh", _mul(_add("z", _read("n - 24", 8)), "mul")), ("ef", _add("e", "f")), ("fa", _add("f", "a")),
    ("p", _add(_rotate("ef", 43), _rotate("g", 30), "hh")), ("q", _add("e", _rotate("fa", 18), "g")), *_joined("p", "q", "found"),
]

cte("farm_keys", "SELECT k, hex(encode(k)) AS h, strlen(k)::UHUGEINT AS n FROM (SELECT DISTINCT household_key AS k FROM k12_rows)")
cte("farm_ids", f"""
SELECT k, CASE WHEN found >= {2**63}::UHUGEINT THEN (found::HUGEINT - {2**64}::HUGEINT)::BIGINT ELSE found::BIGINT END AS household_id
FROM ({" UNION ALL ".join(_class(a, b, s) for a, b, s in ((1, 3, _TINY), (4, 7, _SMALL), (8, 16, _SHORT), (17, 32, _MEDIUM), (33, 64, _LONG)))})
""")
