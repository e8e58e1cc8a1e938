"""Registered queries against their DuckDB statements, over whole tables.

Every query of the shop runs by default; SHOPLOOM_TEST_QUERIES, a comma-separated list of name prefixes, picks some.
The training-data queries have their own tests in `tests/llm`.
"""

import os

import pytest

import __spark_entry__ as entry
from shoploom import catalog
from compare import difference, duck

FOLDER = os.environ.get("SHOPLOOM_TEST_DIR", "/root/testdata/sf0.001")
PREFIXES = tuple(os.environ.get("SHOPLOOM_TEST_QUERIES", "").split(","))
QUERIES, CHECKS = catalog.queries(), catalog.oracle_sql()
CHOSEN = [n for n in sorted(QUERIES) if n.startswith(PREFIXES)]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(CHECKS) and len(QUERIES) > 200
    assert QUERIES.keys() <= entry.queries().keys() and CHECKS.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert "net_sales" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, CHECKS[name]) is None
