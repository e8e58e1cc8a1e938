import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import day, frame, ts
from shoploom.functions import exprs as x


def column(spark, ddl, rows, expr):
    """Values of an expression over rows, in row order."""
    names = T.StructType.fromDDL(ddl).names
    df = frame(spark, "i int, " + ddl, [dict(zip(names, r), i=i) for i, r in enumerate(rows)])
    return [r[0] for r in df.orderBy("i").select(expr.alias("v")).collect()]


def test_rounded_ratio_conventions(spark):
    rows = [(1, 8), (1, 0), (1, None), (None, 4), (-1, 8), (5, 1000)]
    assert column(spark, "a bigint, b bigint", rows, x.percent("a", "b")) == [12.5, None, None, None, -12.5, 0.5]
    assert column(spark, "a bigint, b bigint", rows, x.percent("a", "b", otherwise=0)) == [12.5, 0, 0, None, -12.5, 0.5]


def test_ties_round_away_from_zero(spark):
    rows = [("100.01", 2), ("-100.01", 2), ("1.005", 1)]
    got = column(spark, "a decimal(18,3), b bigint", rows, x.rounded_ratio("a", "b"))
    assert got == [50.01, -50.01, 1.01]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_rounded_ratio_matches_integers(spark, pairs):
    got = column(spark, "a bigint, b bigint", pairs, x.rounded_ratio("a", "b"))
    want = [math.copysign((2 * abs(a) * 100 + b) // (2 * b), a) / 100 for a, b in pairs]
    assert [g or 0.0 for g in got] == [w or 0.0 for w in want]


def test_safe_divide_and_change(spark):
    rows = [(3.0, 2.0), (3.0, 0.0), (3.0, None), (1.0, -2.0)]
    assert column(spark, "a double, b double", rows, x.safe_divide("a", "b")) == [1.5, None, None, -0.5]
    assert column(spark, "a double, b double", rows, x.relative_change("a", "b")) == [0.5, None, None, 1.5]


def test_first_group_is_null_without_match(spark):
    tags = [("a, Salesperson: Jo Lee, b",), ("Salesperson: Jo",), ("",), (None,), ("Salesperson: ,",)]
    got = column(spark, "t string", tags, x.first_group("t", "Salesperson: (.*?),"))
    assert got == ["Jo Lee", None, None, None, ""]


def test_civil_time_across_daylight_saving(spark):
    times = [ts("2024-01-01 05:00"), ts("2024-07-01 05:00"), ts("2024-03-10 09:59"), ts("2024-03-10 10:00"), None]
    got = column(spark, "t timestamp_ntz", [(t,) for t in times], x.civil_time("t", "America/Los_Angeles"))
    assert got == [ts("2023-12-31 21:00"), ts("2024-06-30 22:00"), ts("2024-03-10 01:59"), ts("2024-03-10 03:00"), None]


@pytest.mark.parametrize("text", [
    "2024-12-29", "2024-12-30", "2024-12-31", "2025-01-01", "2025-01-04", "2025-01-05", "2023-01-01", "2020-12-31",
    "2021-01-03", "2024-02-29", "2024-03-31", "2022-01-02", "2023-12-31",
])
def test_weeks_match_the_calendar(spark, text):
    d = day(text)
    row = spark.range(1).select(
        x.iso_year(F.lit(d)).alias("y"), x.iso_week(F.lit(d)).alias("w"), x.iso_week_start(F.lit(d)).alias("monday"),
        x.sunday_week_start(F.lit(d)).alias("sunday"), x.sunday_week_number(F.lit(d)).alias("u"),
    ).first()
    iso = d.isocalendar()
    assert (row.y, row.w) == (iso[0], iso[1])
    assert row.monday == d - dt.timedelta(days=d.weekday())
    assert row.sunday == d - dt.timedelta(days=d.isoweekday() % 7)
    assert row.u == int(d.strftime("%U"))


def test_month_and_second_gaps_count_boundaries(spark):
    days = [(day("2024-03-01"), day("2024-02-29")), (day("2024-03-31"), day("2024-03-01")), (day("2024-01-31"), day("2024-03-01"))]
    assert column(spark, "a date, b date", days, x.month_gap("a", "b")) == [1, 0, -2]
    times = [(ts("2024-01-01 00:00:01"), ts("2024-01-01 00:00:00.999")), (ts("2024-01-01 00:01:59"), ts("2024-01-01 00:00:00"))]
    assert column(spark, "a timestamp_ntz, b timestamp_ntz", times, x.second_gap("a", "b")) == [1, 119]
    assert column(spark, "a timestamp_ntz, b timestamp_ntz", times, x.minutes_elapsed("a", "b")) == [0, 1]


def test_param_value_is_typed(spark):
    ddl = "p array<struct<key: string, value: struct<string_value: string, int_value: bigint, double_value: double>>>"
    rows = [([("price", (None, 5, None)), ("value", (None, None, 2.5))],), ([],), (None,)]
    assert column(spark, ddl, rows, x.param_value("p", "value", "double")) == [2.5, None, None]
    assert column(spark, ddl, rows, x.param_value("p", "price", "double")) == [None, None, None]
    assert column(spark, ddl, rows, x.param_value("p", "price", "int")) == [5, None, None]


def test_address_forms(spark):
    lines = [("12  Main St., #4",), ("12 main st 4",), ("5 North-West Street Apartment 2",), (None,)]
    assert column(spark, "a string", lines, x.normalised_address("a")) == [
        "12 main st 4", "12 main st 4", "5 northwest street apartment 2", None]
    assert column(spark, "a string", lines, x.normalised_address("a", abbreviations=True))[2] == "5 northwest st apt 2"
    zips = [("94110-1234", "US"), ("9411 0", "United States"), ("V6B 1A1", "CA"), ("94110", None)]
    assert column(spark, "z string, c string", zips, x.normalised_zip("z", "c")) == ["94110", "94110", "v6b1a1", "94110"]


def test_bucket_edges(spark):
    edges = ((15, "a"), (30, "b"))
    got = column(spark, "n int", [(15,), (16,), (30,), (31,), (-4,), (None,)], x.bucket("n", edges, "more", "none"))
    assert got == ["a", "b", "b", "more", "a", "none"]
