"""Run registered queries on Spark and DuckDB and compare rows, columns and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else (float(f"{value:.12g}") if value else 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=key)


def loose_types(con, sql: str) -> list[str]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return [f"{r[0]}:{r[1]}" for r in described if r[1].startswith(("DECIMAL", "HUGEINT", "TIMESTAMP WITH"))]


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    names, got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_names, want = rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != want_names:
        return f"columns: only Spark {sorted(set(names) - set(want_names))}, only SQL {sorted(set(want_names) - set(names))}"
    if len(got) != len(want):
        return f"rows: Spark {len(got)}, SQL {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows, first: {cells[:6]}"
    loose = loose_types(con, sql)
    return f"types: {loose}" if loose else None


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from conftest import make_session

    spark, con, failed = make_session(), duck(folder), 0
    checks = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            result = difference(df, con, checks[name]) if name in checks else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:700]}"
        ok = result is None or result.startswith("no SQL")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path[:0] = [__file__.rsplit("/tests/", 1)[0], __file__.rsplit("/", 1)[0]]
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
