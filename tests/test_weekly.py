"""Weekly product sales: distinct counts inside orders and groups, the shuffles they take, and the table in their ranges."""

import re

from helpers import by, day, frame
from pyspark.sql import functions as F
from shoploom.catalog import reads
from shoploom.catalog.shop import Shop
from shoploom.plans import marts as m
from shoploom.sources.tables import write_table
from test_operators import SMOKE, physical

LINES = (
    "order_line_id string, order_id bigint, store string, email string, sku string, title string, color string, line_item_type string, "
    "order_date date, quantity bigint, line_total decimal(18,2), total_discount decimal(18,2), price decimal(18,2), "
    "is_converted_purchase int, days_from_sample_to_purchase int, is_new_customer int, is_returning_customer int"
)


def sold(line, order, email, **more):
    return dict(
        order_line_id=line, order_id=order, email=email, store="regular", sku="FL-1", title="Oak", color="Oak", line_item_type="Product",
        order_date=day("2024-01-03"), quantity=2, line_total=10, total_discount=1, price=5, is_converted_purchase=0, is_new_customer=0,
        is_returning_customer=0,
    ) | more


def test_counts_with_repeated_and_missing_ids(spark):
    lines = frame(spark, LINES, [
        sold("a", 1, "x", is_new_customer=1), sold("a", 1, "x"),  # a line that came twice
        sold("b", 1, "x"), sold(None, 1, "x"), sold(None, 1, "x"),  # lines without an id are not counted
        sold("c", 2, "x", is_returning_customer=1), sold("a", 3, "y", price=None),  # an id of another order's line
        sold("d", 4, None, is_new_customer=1), sold("e", None, "y"), sold("f", 5, "z", order_date=day("2024-01-07")),
        sold("a", 1, "x", store="commercial"),
    ])
    for layout in ((), ("sku", "store", "line_item_type")):
        got = by(m.weekly_product_sales(lines, layout), "week_start_date", "store")
        assert len(got) == 3
        one = got[day("2023-12-31"), "regular"]
        assert (one["order_count"], one["line_item_count"], one["unique_customers"]) == (4, 6, 2)
        assert (one["new_customers"], one["returning_customers"], one["total_quantity"]) == (1, 1, 18)
        assert float(one["total_revenue"]) == 90 and one["average_price"] == 5 and one["avg_days_from_sample"] is None
        assert got[day("2023-12-31"), "commercial"]["order_count"] == got[day("2024-01-07"), "regular"]["line_item_count"] == 1


def test_lines_are_shuffled_once_after_their_join(spark):
    """Before, lines with all their ids were shuffled by group and customer, and their sums by group again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shop = Shop(spark, SMOKE, reads.RESULTS["weekly_product_sales"])
        by_group = re.findall(r"hashpartitioning\(([^)]*week_start_date#[^)]*)\)", physical(shop.weekly_product_sales))
        by_order = re.findall(r"hashpartitioning\(order_id#\d+L?, store#\d+, \d+\)", physical(shop.weekly_product_sales))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(by_group) == 1 and "email" not in by_group[0] and len(by_order) == 2


def test_the_table_is_grouped_in_its_ranges(spark):
    """Before, the finished rows were shuffled again to be laid out."""
    clusters = ("sku", "store", "line_item_type")
    shop = Shop(spark, SMOKE, reads.RESULTS["weekly_product_sales"])
    plan = physical(m.weekly_product_sales(shop.fct_order_lines, clusters))
    assert plan.count("rangepartitioning(") == 1 and not re.search(r"hashpartitioning\([^)]*week_start_date#", plan)
    table, whole = shop.table_of("weekly_product_sales"), shop.weekly_product_sales
    assert table.count() == whole.count() > 0 and table.dtypes == whole.dtypes
    assert table.exceptAll(whole).isEmpty()


def test_ranged_rows_are_not_shuffled_again(spark, tmp_path):
    """A file holds a range of the clusters."""
    lines = frame(spark, LINES, [sold(f"{i}-{n}", i, f"e{i}", sku=f"FL-{n:03d}") for i in range(20) for n in range(50)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = write_table(m.weekly_product_sales(lines, ("sku",)), str(tmp_path / "t"), cluster_by=("sku",), ranged=True)
        files = out.groupBy(F.input_file_name()).agg(F.min("sku").alias("low"), F.max("sku").alias("high")).orderBy("low").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 1 and all(a.high < b.low for a, b in zip(files, files[1:]))
