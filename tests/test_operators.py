"""Relational helpers, data checks, sources and sinks, and the shape of the plans."""

import datetime as dt
import os
import re
import shutil
from functools import cached_property

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import by, day, frame, ts
from shoploom import catalog, session
from shoploom.catalog.shop import Shop
from shoploom.operators import quality as q
from shoploom.operators.relational import distinct_counts, left_join_sparse, most_common
from shoploom.operators.windows import newest_per, prior, same_week_last_year, trailing
from shoploom.plans import customers as c
from shoploom.sources import schemas
from shoploom.sources.tables import as_view, current_version, read_shards, write_table

SMOKE = "/root/testdata/sf0.001"


def test_sparse_left_join(spark):
    left = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 10 END AS k")
    right = spark.range(5).selectExpr("id AS k", "id * 100 AS v")
    right_with_null = right.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, CAST(-1 AS BIGINT) AS v"))
    got, want = left_join_sparse(left, right_with_null, "k"), left.join(right, "k", "left")
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).isEmpty() and got.count() == 1000


def test_sparse_left_join_shuffles_nulls_apart(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id END AS k")
        plan = physical(left_join_sparse(left, spark.range(9).selectExpr("id AS k", "1 AS v"), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"hashpartitioning\(k#\d+L?, _spread", plan)) == 2


def test_most_common(spark):
    df = frame(spark, "e string, v string", [dict(e="a", v=v) for v in ("x", "y", "y", None, None)] + [dict(e="b", v="q"), dict(e="c")])
    assert by(most_common(df, "e", {"top": "v"}), "e")["a"]["top"] is None  # a tie: NULL sorts first
    only = by(most_common(df, "e", {"top": "v", "any": "v"}, {"top": F.col("v").isNotNull()}), "e")
    assert only["a"]["top"] == "y" and only["b"]["top"] == "q" and only["c"]["top"] is None


def test_distinct_counts(spark):
    df = spark.range(500).selectExpr("id % 3 AS k", "id % 7 AS a", "CASE WHEN id % 2 = 0 THEN id % 11 END AS b", "CAST(NULL AS INT) AS c")
    got = distinct_counts(df, ["k"], {"a": F.col("a"), "b": F.col("b"), "c": F.col("c")})
    want = df.groupBy("k").agg(*[F.count_distinct(c).alias(c) for c in "abc"])
    assert got.exceptAll(want).isEmpty() and got.count() == 3


def test_newest_nulls_last(spark):
    df = frame(spark, "k string, a timestamp_ntz, b int", [dict(k="x", b=9), dict(k="x", a=ts("2024-01-01 00:00"), b=1), dict(k="x", a=ts("2024-01-01 00:00"), b=2)])
    assert newest_per(df, ["k"], ["a", "b"]).collect()[0].b == 2


def test_frames(spark):
    from pyspark.sql import Window as W
    w = W.orderBy("id")
    rows = spark.range(14).select("id", trailing("id", w, 6).alias("t"), prior("id", w, 6).alias("p")).collect()
    assert [r.t for r in rows][:7] == [0, 1, 3, 6, 10, 15, 21] and [r.p for r in rows][5:8] == [None, 0, 1] and rows[13].p == sum(range(2, 8))
    years = frame(spark, "iso_year int, iso_week int, v int", [dict(iso_year=y, iso_week=1, v=y) for y in (2020, 2021, 2023)])
    assert {r.iso_year: r.p for r in years.select("iso_year", same_week_last_year("v").alias("p")).collect()} == {2020: None, 2021: 2020, 2023: None}


def test_checks(spark):
    df = frame(spark, "k int, v string", [dict(k=1, v="a"), dict(k=1, v="b"), dict(k=2), dict(v="c"), dict(v="c")])
    assert q.not_null(df, "v").count() == 1 and [tuple(r) for r in q.unique(df, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in q.accepted_values(df, "v", ["a", "b"]).collect()] == [("c", 2)]
    parent = frame(spark, "id int", [dict(id=1), dict(id=1), dict()])
    assert [r.k for r in q.relationship(df, "k", parent, "id").collect()] == [2]
    both = q.compare({"x": df, "y": df.filter("k = 1")}, [F.count("*").alias("n")])
    assert {r.metric: r.is_within for r in q.within_tolerance(both, ["n"], "x", "y").collect()} == {"n": False}
    assert q.violations(df, "no value", F.col("v").isNull()).first().violations == 1


def test_conform(spark):
    df = frame(spark, "b string, a string", [dict(a="1", b="x")])
    assert schemas.conform(df, "a int, b string").dtypes == [("a", "int"), ("b", "string")]
    with pytest.raises(ValueError, match="c"):
        schemas.conform(df, "a int, c string")


def test_tables(spark, tmp_path):
    df = frame(spark, "d date, k string, n int", [dict(d=day(f"2024-0{m}-15"), k=k, n=m) for m in (1, 2) for k in "ab"] + [dict(k="c", n=0)])
    path = str(tmp_path / "t")
    write_table(df, path, "d")
    back = write_table(df, path, "d")  # a second write replaces the first
    assert back.count() == 5 and back.schema["d"].dataType.simpleString() == "date"
    assert {r.n for r in back.filter("d = DATE '2024-02-15'").collect()} == {2}
    monthly = write_table(df, str(tmp_path / "m"), "d", "month", ["k"])
    assert {str(r.d_month) for r in monthly.select("d_month").distinct().collect()} == {"2024-01-01", "2024-02-01", "None"}
    assert os.path.isdir(f"{current_version(spark, str(tmp_path / 'm'))}/d_month=2024-01-01")
    assert as_view(df, "some_view").filter("n = 0").count() == 1 and write_table(df, str(tmp_path / "p")).count() == 5


def test_shards_are_pruned(spark, tmp_path):
    df = frame(spark, "event_date string, n int", [dict(event_date=f"202401{d:02d}", n=d) for d in range(1, 31)])
    write_table(df, str(tmp_path / "e"), "event_date")
    recent = read_shards(spark, str(tmp_path / "e"), df.schema, F.lit("2024-01-31").cast("date"), 7)
    assert sorted(r.n for r in recent.collect()) == list(range(24, 31))
    assert "PartitionFilters: [isnotnull(event_date" in physical(recent) and recent.schema["event_date"].dataType.simpleString() == "string"


def test_cut_is_written_once_per_state_to_the_named_folder(spark):
    named, made = spark.conf.get("spark.checkpoint.dir"), []

    def make():
        made.append(1)
        return spark.range(10)

    out, path = session.cut(spark, "ten", "a", make)
    assert path.startswith(f"{named}/cut-ten-") and out.count() == 10
    assert session.cut(spark, "ten", "a", make)[1] == path and len(made) == 1
    assert session.cut(spark, "ten", "b", make)[1] != path and len(made) == 2
    session.remove(spark, path)
    assert session.cut(spark, "ten", "a", make)[0].count() == 10 and len(made) == 3


def physical(df) -> str:
    df.sparkSession.sparkContext  # a classic session
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    """Plans of all results with broadcasting off, as on large inputs."""
    shop = Shop(spark, SMOKE)
    names = [n for n, v in vars(Shop).items() if isinstance(v, cached_property) and n != "state"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return {n: physical(getattr(shop, n)) for n in names}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plans_have_no_cross_joins_or_python(plans):
    assert len(plans) > 30
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        # Only the household id is hashed outside the JVM, once per household or household order.
        evaluated = re.findall(r"EvalPython \[(\w+)\(.*household_key#", plan)
        assert evaluated == ["hashed"] * (name in ("households", "funnel", "sample_conversions")), name
        assert plan.count("EvalPython") == len(evaluated) and "InPandas" not in plan and "InArrow" not in plan, name
        assert "BroadcastExchange" not in plan, name  # no forced broadcasts


def test_single_partition_only_after_weekly_totals(plans):
    assert {n for n, p in plans.items() if "Exchange SinglePartition" in p} <= {"net_sales", "sample_orders"}


def test_deduplication_reduces_before_the_shuffle(plans):
    for name in ("orders", "customers"):
        above, below = plans[name].split("Exchange hashpartitioning", 1)
        assert "WindowGroupLimit" in above and "WindowGroupLimit" in below, name


def test_lifetime_windows_never_gather_a_customer(plans):
    """Wide orders are shuffled by customer and day; only sums per day are shuffled by customer."""
    plan = plans["fct_orders_plan"]
    windows = [re.findall(r"\[([^\[\]]*)\]", line) for line in plan.splitlines() if "Window [" in line]  # results, partition, order
    wide = [set(re.findall(r"(\w+)#", lists[1])) for lists in windows if len(lists) > 2 and "processed_at#" in lists[2]]
    assert wide and all({"email", "order_date"} <= keys for keys in wide)
    assert len(re.findall(r"hashpartitioning\(email#\d+, order_date#\d+", plan)) >= 2


def test_scans_read_only_needed_columns(plans):
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plans["sessions"])]
    assert read and all(columns <= {"event_id", "ts", "user_id", "event_type", "value", "props"} for columns in read)
    read = [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plans["net_sales"])]
    assert read and all(columns == {"order_date", "order_id", "email", "net_sales", "cancel_reason"} for columns in read)
    net = plans["net_sales"]
    assert "billing_state" not in net and "shipping_state" not in net


def test_classification_reads_lines_once(spark):
    shop = Shop(spark, SMOKE)
    plan = physical(c.classify_orders(shop.orders, shop.lines))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    assert not [line for line in plan.splitlines() if "Generate" in line and "l_orderkey" in line]


def test_reports_read_facts_once(spark):
    """Once run, no report scans the order fact twice or expands its rows; equal shuffles are reused."""
    shop = Shop(spark, SMOKE)
    for name in ("channel_mix", "net_sales"):
        df = getattr(shop, name)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1, name
        assert "Expand" not in plan, name


def test_sink_splits_a_hot_value(spark, tmp_path):
    """A day with nine tenths of the rows, and rows without a day, are written by several tasks."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 20 == 0, None).when(F.col("id") % 10 == 1, F.date_add(F.lit("2024-01-01"), (F.col("id") % 7).cast("int")))
        .otherwise(F.lit("2024-02-01").cast("date")).alias("day"), F.col("id"), F.lit("same").alias("store"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    try:
        written = write_table(rows, f"{tmp_path}/t", "day", "day", ["store"])
        months = write_table(rows.filter("day is null"), f"{tmp_path}/m", "day", "month", ["store"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert written.count() == 20_000 and written.filter("day is null").count() == 1000
    files = written.select("day", F.input_file_name().alias("file")).distinct().groupBy("day").count()
    assert {r["day"]: r["count"] for r in files.collect()}[dt.date(2024, 2, 1)] > 1
    assert months.select(F.input_file_name()).distinct().count() > 1


def test_replaced_input_is_seen(spark, tmp_path):
    """No result of a former input is served after a table was replaced."""
    for name in os.listdir(SMOKE):
        shutil.copyfile(f"{SMOKE}/{name}", f"{tmp_path}/{name}")
    query = catalog.queries()["a04_model_reference"]
    before = sum(r["n"] for r in query(spark, str(tmp_path)).collect())
    orders = pq.read_table(f"{SMOKE}/orders.parquet")
    pq.write_table(orders.slice(0, orders.num_rows // 2), f"{tmp_path}/orders.parquet")
    spark.catalog.refreshByPath(f"{tmp_path}/orders.parquet")
    after = sum(r["n"] for r in query(spark, str(tmp_path)).collect())
    assert 0 < after < 0.7 * before


def test_tables_are_built_from_tables(spark, tmp_path):
    shop, plain = Shop(spark, SMOKE), Shop(spark, SMOKE)
    names = ["funnel", "dim_customers", "monthly_cohorts"]
    built = shop.materialise(f"{tmp_path}/marts", names)
    assert list(built) == names
    for name in names:
        mine, other = getattr(shop, name), getattr(plain, name)
        assert mine.columns == other.columns and mine.count() == other.count()
        assert all(f"marts/{name}/" in f for f in mine.inputFiles())
    assert any("marts/funnel/" in f for f in shop.sample_conversions.inputFiles())
    shop.release()
    assert not os.path.exists(f"{tmp_path}/marts/funnel")
