"""Order facts with only the columns that a query reads."""

import datetime as dt
import re

import pytest

from helpers import frame, ts
from shoploom import catalog
from shoploom.catalog import reads, registry
from shoploom.catalog import shop as catalog_shop
from shoploom.catalog.shop import Shop
from shoploom.plans import customers as c
from shoploom.session import configure, shared_folder

TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


@pytest.fixture
def folder(spark, tmp_path):
    """Three customers, of whom the first holds most orders; order 9 has no customer record, order 100 was synced twice."""
    day = ts("1997-03-05")
    placed = {100: 1, 101: 1, 102: 1, 103: 1, 105: 2, 106: 2, 110: 3, 9: 77}
    rows = {
        "customer": [dict(c_custkey=k, c_name="n", c_nationkey=k, c_acctbal=1.0, c_mktsegment="BUILDING") for k in (1, 2, 3)],
        "part": [
            dict(p_partkey=k, p_name=f"oak {k}", p_brand="b", p_type=kind, p_size=k, p_retailprice=1000.0)
            for k, kind in ((1, "PROMO"), (2, "STANDARD"), (3, "ECONOMY"))
        ],
        "orders": [
            dict(o_orderkey=k, o_custkey=cust, o_orderstatus="O", o_totalprice=150000.0 + k, o_orderdate=day + dt.timedelta(days=k % 4),
                 o_orderpriority="1-URGENT") for k, cust in placed.items()
        ],
        "lineitem": [
            dict(l_orderkey=k, l_partkey=1 + k * n % 3, l_suppkey=1, l_linenumber=n, l_quantity=2.0, l_extendedprice=500.0 * n, l_discount=0.1,
                 l_tax=0.0, l_returnflag="N", l_linestatus="O", l_shipdate=day) for k in placed for n in (1, 2)
        ],
    }
    for name, ddl in TABLES.items():
        frame(spark, ddl, rows[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _sorted(df):
    return sorted(df.select(*sorted(df.columns)).collect(), key=repr)


def test_only_columns_that_are_read_are_made(spark, folder):
    narrow = Shop(spark, folder, ["customer_status", "store"])
    assert narrow.fct_orders.columns == ["store", "customer_status"]
    written = spark.read.parquet(narrow.paths[-1]).columns, spark.read.parquet(narrow.paths[0]).columns
    assert written[0] == ["store", "customer_status"] and set(written[1]) == set(c.ORDER_CORE)
    whole = Shop(spark, folder)
    assert _sorted(narrow.fct_orders) == _sorted(whole.fct_orders.select("store", "customer_status")) != []
    assert len(whole.fct_orders.columns) == len(c.FCT_ORDERS)
    with pytest.raises(ValueError, match="price"):
        Shop(spark, folder, ["price"])


@pytest.mark.parametrize("result", ["fct_order_lines", "daily_performance", "sample_conversions", "weekly_product_sales", "net_sales", "launch_sampling"])
def test_results_are_those_of_the_whole_fact(spark, folder, result):
    def made(shop):
        shop.__dict__["ad_performance"] = spark.createDataFrame([], "date_day date, channel string, spend decimal(18,2), conversions bigint, "
                                                                    "conversions_value decimal(18,2), clicks bigint, impressions bigint")
        return getattr(shop, result)

    columns = reads.RESULTS[result]
    if result == "fct_order_lines":  # fewer than it has, as its readers ask for
        narrow, whole = made(Shop(spark, folder, reads.QUERIES["e09_lag"])), made(Shop(spark, folder))
        whole = whole.select(*narrow.columns)
    else:
        narrow, whole = made(Shop(spark, folder, columns)), made(Shop(spark, folder))
    assert _sorted(narrow) == _sorted(whole)


def test_a_query_writes_few_columns(spark, folder):
    """The files a query leaves behind: before, each held all columns of orders."""
    assert catalog.queries()["c08_full_outer"](spark, folder).columns == ["order_date", "store", "sample_orders", "accessory_orders"]
    shop = Shop(spark, folder, reads.QUERIES["c08_full_outer"])
    assert shop.fct_orders.columns == ["order_date", "store", "is_sample_order", "is_accessory_only"]
    assert spark.read.parquet(shop.paths[-1]).columns == shop.fct_orders.columns
    assert shared_folder(spark) in shop.paths[-1]


def test_named_columns_and_queries_exist():
    assert set(reads.QUERIES) <= set(catalog.queries())
    for columns in (*reads.QUERIES.values(), *reads.RESULTS.values()):
        assert set(columns) <= set(c.FCT_ORDERS)
    assert reads.columns_of("k20_daily_performance") == reads.columns_of("n08_kpis_daily_performance") == reads.RESULTS["daily_performance"]
    assert reads.columns_of("k17_fct_orders") is None and reads.columns_of("a10_table_fct_orders") is None


def test_tasks_take_on_little(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    configure(session)
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "2m"


@pytest.mark.parametrize("query", ["l08_compare_lifetime", "l06_compare_metrics", "l05_compare_counts", "e16_trailing_sum", "e13_lag_of_rank"])
def test_comparisons_and_windows_write_few_columns(spark, folder, query):
    """Before, these queries had the whole order fact written, and all columns of classified orders."""
    columns = reads.columns_of(query)
    assert columns is not None and len(columns) < len(c.FCT_ORDERS) / 2
    found = _sorted(catalog.queries()[query](spark, folder))
    assert found == _sorted(registry.comparable(registry.PLANS[query](Shop(spark, folder))))


def test_queries_that_share_a_step_write_the_same_columns():
    of = reads.columns_of
    assert of("l07_compare_distribution") == of("l06_compare_metrics_tolerance") == of("l06_compare_metrics")
    assert {tuple(of(f"e{n}")) for n in ("09_lag", "11_lag_n", "12_days_since_last", "14_moving_average", "15_moving_stddev")} == {tuple(of("e16_trailing_sum"))}


def _around_the_first_join(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above, kind, below = re.split(r"\bJoin (\w+)", plan, maxsplit=1)
    return above, kind, below


def test_lines_are_typed_behind_the_join(spark, folder):
    """Before, types and the amounts split by them were shuffled with each line."""
    columns = ["line_item_type", "sample_type", "color", "accessories_revenue"]
    above, _, below = _around_the_first_join(Shop(spark, folder).fct_order_lines.select(*columns))
    for made in columns:
        assert f"AS {made}#" in above and f"AS {made}#" not in below


def test_skus_are_looked_up_before_lines_carry_their_order(spark, folder):
    """Before, lines with the whole context of their order were shuffled by sku."""
    shop = Shop(spark, folder)
    _, kind, below = _around_the_first_join(shop.enriched_lines)
    assert kind == "Inner" and "Join LeftOuter" not in below
    written = next(p for p in shop.paths if "looked_up_lines" in p)
    assert {"sku", "product_line", "order_line_id"} < set(spark.read.parquet(written).columns)
    assert shop.enriched_lines.columns == shop.report_lines.columns
    assert _sorted(shop.enriched_lines) == _sorted(shop.report_lines) != []
    narrow = Shop(spark, folder, reads.columns_of("b19_lookup_with_fallback"))
    assert narrow.enriched_lines is narrow.report_lines


def test_the_line_table_is_dealt_in_runs(spark, folder, monkeypatch):
    monkeypatch.setattr(catalog_shop, "DEALT_AT_ONCE", 1500)
    shop = Shop(spark, folder)
    table = shop.table_of("fct_order_lines")
    assert _sorted(table.select(*shop.fct_order_lines.columns)) == _sorted(shop.fct_order_lines) != []
