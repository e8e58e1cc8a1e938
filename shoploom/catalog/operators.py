"""A-H: sources and sinks, relational operators, windows and scalar functions, each on whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oracle.sql import arms, change, div, flag, local, monday, month, pct, ratio, safe, sunday
from shoploom.catalog.registry import register
from shoploom.functions import exprs as x
from shoploom.functions import rules
from shoploom.operators import bitmaps, frequent
from shoploom.operators.relational import left_join_sparse, most_common, stack, union_stores, zero_fill
from shoploom.operators.windows import newest_per, prior, running_totals, same_week_last_year, trailing
from shoploom.plans import customers as c
from shoploom.plans import marts as m
from shoploom.plans import reports as r
from shoploom.plans import staging as s
from shoploom.session import unique_path
from shoploom.sources import sample_shop as feed
from shoploom.sources.tables import as_view, read_shards, read_table, write_table

col = F.col


def _path(t, name: str) -> str:
    return unique_path(t.spark, f"table-{name}")


def _money(name: str):
    return col(name).cast("decimal(18,2)")


# --- A: sources and sinks --------------------------------------------------------


def _sharded(t):
    path = _path(t, "events")
    shards = write_table(t.events_feed, path, partition_by="event_date")
    recent = read_shards(t.spark, path, shards.schema, t.events_as_of, days=14)
    return recent.select("event_date", "event_bundle_sequence_id", "event_name")


def _overwritten(t):
    path = _path(t, "customers")
    write_table(t.customers, path)
    return write_table(read_table(t.spark, path), path).select("email", "customer_id", "customer_group", "customer_type")


def _view(t):
    as_view(t.lines, "staged_lines")
    return t.spark.sql(
        "SELECT line_item_type, store, count(*) AS n, sum(quantity) AS units FROM staged_lines GROUP BY ALL"
    )


register("a01_table_scan", lambda t: t.table("lineitem"), "SELECT * FROM lineitem")
register(
    "a02_sharded_scan", _sharded,
    "SELECT event_date, event_bundle_sequence_id, event_name FROM k04 WHERE event_date >= '20240117'",
)
register("a03_seed_lookup", lambda t: t.sku_lookup, "SELECT * FROM feed_lookup")
register(
    "a04_model_reference",
    lambda t: t.fct_orders.groupBy("store", "order_type").agg(F.count("*").alias("n")),
    "SELECT store, order_type, count(*) AS n FROM k17 GROUP BY ALL",
)
register(
    "a05_view_sink", _view,
    "SELECT line_item_type, store, count(*) AS n, sum(quantity)::BIGINT AS units FROM k02 GROUP BY ALL",
)
register(
    "a06_table_sink_overwrite", _overwritten, "SELECT email, customer_id, customer_group, customer_type FROM k03"
)
register(
    "a07_table_sink_by_day",
    lambda t: t.table_of("web_funnel").select(
        "session_date", "deepest_funnel_stage", "total_sessions", "converted_sessions"
    ),
    "SELECT session_date, deepest_funnel_stage, total_sessions, converted_sessions FROM k27",
)
register(
    "a08_table_sink_by_month",
    lambda t: t.table_of("sample_conversions").select(
        "email", "first_sample_order_date", "first_sample_order_date_month", "sample_order_type", "conversion_ind"
    ),
    """SELECT email, first_sample_order_date, CAST(date_trunc('month', first_sample_order_date) AS DATE) AS first_sample_order_date_month,
    sample_order_type, conversion_ind FROM k19""",
)
register(
    "a09_table_sink_clustered",
    lambda t: t.table_of("fct_order_lines").select(
        "order_line_id", "order_id", "store", "sku", "color", "line_item_type", "quantity"
    ),
    "SELECT order_line_id, order_id, store, sku, color, line_item_type, quantity FROM k18",
)
# The other results that are kept as tables, each written with its own layout: all columns but the hash id.
_SINKS = {
    "funnel": "k13", "fct_orders": "k17", "dim_customers": "k16", "ad_performance": "k25", "daily_performance": "k20",
    "weekly_product_sales": "k21", "monthly_cohorts": "k22", "unit_economics": "k23", "email_performance": "k26",
    "fct_shipments": "k28",
}
for _name, _cte in _SINKS.items():
    register(
        f"a10_table_{_name}",
        lambda t, name=_name: t.table_of(name).select(*getattr(t, name).columns),
        f"SELECT * FROM {_cte}", exact=_name != "funnel",
    )

# --- B: projections, filters, predicates ---------------------------------------------

register(
    "b01_rename",
    lambda t: t.table("customer").select(
        col("c_custkey").alias("customer_id"), col("c_name").alias("name"), col("c_mktsegment").alias("segment")
    ),
    "SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment FROM customer",
)
register(
    "b02_star_plus",
    lambda t: t.table("lineitem").withColumns({
        "line_total": _money("l_extendedprice"), "is_big": x.flag(col("l_quantity") > 25)
    }),
    f"SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total, {flag('l_quantity > 25')} AS is_big FROM lineitem",
    exact=True,
)
register("b03_star_minus", lambda t: t.table("customer").drop("c_acctbal"), "SELECT * EXCLUDE (c_acctbal) FROM customer")
register(
    "b04_qualified_star",
    lambda t: t.table("orders").alias("o").join(t.table("customer").alias("c"), col("o_custkey") == col("c_custkey"))
    .select("o.*", col("c.c_mktsegment")),
    "SELECT o.*, c.c_mktsegment FROM orders o JOIN customer c ON o_custkey = c_custkey",
)
register(
    "b05_literal_columns",
    lambda t: t.orders.select("order_id", "store", "product_price_threshold", "default_salesperson", F.lit("shop").alias("origin")),
    "SELECT order_id, store, product_price_threshold, default_salesperson, 'shop' AS origin FROM k01",
)
register(
    "b06_typed_null_padding",
    lambda t: t.table("part").select(
        "p_partkey", F.lit(None).cast("bigint").alias("bounced"), F.lit(None).cast("date").alias("sent_date"),
        F.lit(None).cast("string").alias("subject"), F.lit(None).cast("double").alias("change"),
    ),
    "SELECT p_partkey, NULL::BIGINT AS bounced, NULL::DATE AS sent_date, NULL::VARCHAR AS subject, NULL::DOUBLE AS change FROM part",
)
register(
    "b07_struct_access",
    lambda t: t.events_feed.groupBy(
        col("device.web_info.browser").alias("browser"), col("device.category").alias("category"), col("geo.country").alias("country")
    ).agg(F.count("*").alias("n")),
    "SELECT browser, device_category AS category, geo_country AS country, count(*) AS n FROM k04 GROUP BY ALL",
)
register(
    "b08_equality_filter",
    lambda t: feed.email_campaigns(t.spark, t.folder).filter((col("status") == "sent") & (col("is_archived") == F.lit(False)))
    .select("campaign_id", "campaign_name"),
    "SELECT p_partkey AS campaign_id, mail_name AS campaign_name FROM feed_mail WHERE NOT is_flow AND is_live AND NOT is_archived",
)
register(
    "b09_null_filter",
    lambda t: t.orders.filter(col("cancel_reason").isNull() & col("tags").isNotNull()).select("order_id", "store", "tags"),
    "SELECT order_id, store, tags FROM k01 WHERE cancel_reason IS NULL AND tags IS NOT NULL",
)
register(
    "b10_not_like_filter",
    lambda t: t.orders.filter(~col("email").like(rules.MARKETPLACE_EMAIL)).select("order_id", "store", "email"),
    "SELECT order_id, store, email FROM k01 WHERE email NOT LIKE '%amazon%'",
)
register(
    "b11_or_of_flags",
    lambda t: t.fct_orders.filter((col("is_first_sample_order") == 1) | (col("is_first_product_order") == 1))
    .select("order_id", "store", "email", "order_type"),
    "SELECT order_id, store, email, order_type FROM k17 WHERE is_first_sample_order = 1 OR is_first_product_order = 1",
)
register(
    "b12_null_or_before",
    lambda t: t.classified.filter("is_sample_order = 1").select("order_id", "store", "email", "order_date")
    .join(t.funnel.select("email", "first_product_order_date"), "email")
    .filter(col("first_product_order_date").isNull() | (col("order_date") < col("first_product_order_date"))),
    """SELECT order_id, store, email, order_date, first_product_order_date FROM k10 JOIN k13 USING (email)
    WHERE is_sample_order = 1 AND coalesce(order_date < first_product_order_date, true)""",
)
register(
    "b13_in_list",
    lambda t: t.fct_orders.filter(col("customer_status").isin("New Customer", "New Customer Sample"))
    .select("order_id", "store", "customer_status"),
    "SELECT order_id, store, customer_status FROM k17 WHERE customer_status IN ('New Customer', 'New Customer Sample')",
)
register(
    "b14_between",
    lambda t: t.orders.filter((F.month("order_date") == 11) & F.dayofmonth("order_date").between(22, 28)).select("order_id", "store", "order_date"),
    "SELECT order_id, store, order_date FROM k01 WHERE month(order_date) = 11 AND day(order_date) BETWEEN 22 AND 28",
)
register(
    "b15_qualify",
    lambda t: newest_per(t.orders.filter(col("email").isNotNull()), ["email"], ["processed_at", "order_id"])
    .select("email", "order_id", "processed_at"),
    """SELECT email, order_id, processed_at FROM k01 WHERE email IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY email ORDER BY processed_at DESC, order_id DESC) = 1""",
)
register(
    "b16_ranked_subquery",
    lambda t: t.customers_feed.filter(col("email").isNotNull())
    .withColumn("rank", F.row_number().over(W.partitionBy(F.lower("email")).orderBy(F.desc("updated_timestamp"))))
    .filter("rank = 1").select("customer_id", "store", "updated_timestamp"),
    """SELECT customer_id, store, updated_timestamp FROM (SELECT customer_id, store, made + to_days(copy + 1) AS updated_timestamp,
    row_number() OVER (PARTITION BY lower(email) ORDER BY copy DESC) AS rk FROM feed_customers WHERE email IS NOT NULL) WHERE rk = 1""",
)
register(
    "b17_rule_ladder",
    lambda t: t.lines.groupBy("line_item_type", "sample_type").agg(F.count("*").alias("n")),
    "SELECT line_item_type, sample_type, count(*) AS n FROM k02 GROUP BY ALL",
)
register(
    "b18_flags",
    lambda t: t.orders.select(
        "order_id", "store", x.flag(col("refund_subtotal") > 0).alias("is_refunded"),
        x.flag(col("tags").like("%Retail%")).alias("is_retail"),
    ),
    f"SELECT order_id, store, {flag('refund_subtotal > 0')} AS is_refunded, " + flag("tags LIKE '%Retail%'") + " AS is_retail FROM k01",
)
register(
    "b19_lookup_with_fallback",
    lambda t: t.enriched_lines.groupBy("product_line", "wbr_product_subline").agg(F.count("*").alias("n")),
    "SELECT product_line, wbr_product_subline, count(*) AS n FROM k15 GROUP BY ALL",
)
register(
    "b20_three_valued_flags",
    lambda t: t.shipments.select(
        "shipment_id", "is_on_time", x.flag(col("is_on_time")).alias("on_time"), x.flag(~col("is_on_time")).alias("late")
    ),
    f"SELECT shipment_id, is_on_time, {flag('is_on_time')} AS on_time, {flag('is_on_time = false')} AS late FROM k09",
)
register(
    "b21_range_buckets",
    lambda t: t.funnel.select(
        "email", "days_to_order",
        x.bucket("days_to_order", rules.CONVERSION_BUCKETS, rules.BUCKET_ABOVE, rules.BUCKET_NONE).alias("bucket"),
    ),
    "SELECT email, days_to_order, "
    + arms(
        [("days_to_order IS NULL", "'No Conversion'"), ("days_to_order <= 15", "'0-15 days'"), ("days_to_order <= 30", "'16-30 days'"),
         ("days_to_order <= 60", "'31-60 days'"), ("days_to_order <= 120", "'61-120 days'")], "'120+ days'")
    + " AS bucket FROM k13",
)

# --- C: joins -------------------------------------------------------------------------

_line = ["order_line_id", "order_id", "store", "sku"]
register(
    "c01_inner_composite",
    lambda t: t.lines.select(*_line).join(t.orders.select("order_id", "store", "email", "order_date"), ["order_id", "store"]),
    "SELECT order_line_id, order_id, store, sku, email, order_date FROM k02 JOIN k01 USING (order_id, store)",
)
register(
    "c02_inner_to_window_result",
    lambda t: t.lifetime.select("order_id", "store", "email", "order_sequence_number"),
    """SELECT order_id, store, email, n AS order_sequence_number FROM k10 JOIN (SELECT order_id, store,
    row_number() OVER (PARTITION BY email ORDER BY processed_at, order_id, store) AS n FROM k10 WHERE email IS NOT NULL) USING (order_id, store)""",
)
register(
    "c03_left_zero_fill",
    lambda t: zero_fill(
        t.orders.select("order_id", "store").join(
            t.lines.groupBy("order_id", "store").agg(F.sum("quantity").alias("units"), F.count("*").alias("n")), ["order_id", "store"], "left"
        ), ["units", "n"],
    ),
    """SELECT order_id, store, coalesce(units, 0)::BIGINT AS units, coalesce(n, 0) AS n FROM k01
    LEFT JOIN (SELECT order_id, store, sum(quantity) AS units, count(*) AS n FROM k02 GROUP BY ALL) USING (order_id, store)""",
)
register(
    "c04_left_lookup",
    lambda t: t.lines.select(*_line).join(t.sku_lookup, "sku", "left"),
    "SELECT order_line_id, order_id, store, k02.sku, s.* EXCLUDE (sku) FROM k02 LEFT JOIN feed_lookup s ON s.sku = k02.sku",
)
register(
    "c05_left_star",
    lambda t: t.customers.select("email", "customer_group")
    .join(t.funnel.select("email", "conversion_ind"), "email", "left")
    .join(t.fct_orders.groupBy("email").agg(F.max("lifetime_total_orders").alias("orders")), "email", "left")
    .join(t.classified.groupBy("email").agg(F.max("order_date").alias("latest")), "email", "left"),
    """SELECT email, customer_group, conversion_ind, orders, latest FROM k03 LEFT JOIN k13 USING (email)
    LEFT JOIN (SELECT email, count(*) AS orders FROM k17 GROUP BY email) USING (email)
    LEFT JOIN (SELECT email, max(order_date) AS latest FROM k10 GROUP BY email) USING (email)""",
)
register(
    "c06_mixed_joins_then_filter",
    lambda t: t.funnel.select("email", "first_sample_order_date", "sample_order_type")
    .join(t.customers.select("email", "customer_type"), "email")
    .join(t.fct_orders.filter("is_first_product_order = 1").select("email", "product_revenue"), "email", "left")
    .filter(col("first_sample_order_date").isNotNull()),
    """SELECT email, f.first_sample_order_date, f.sample_order_type, customer_type, product_revenue FROM k13 f JOIN k03 USING (email)
    LEFT JOIN (SELECT email, product_revenue FROM k17 WHERE is_first_product_order = 1) USING (email) WHERE f.first_sample_order_date IS NOT NULL""",
    exact=True,
)


def _weeks(t):
    return r.with_iso_week(t.fct_orders.filter(col("cancel_reason").isNull())).groupBy(*r.WEEK).agg(
        F.sum("net_sales").alias("net_sales"), F.count_distinct("order_id").alias("total_orders")
    )


register(
    "c07_year_over_year",
    lambda t: _weeks(t).withColumn("prior_year_net_sales", same_week_last_year("net_sales")).drop("total_orders"),
    """SELECT a.iso_year, a.iso_week, a.week_start, a.net_sales, b.net_sales AS prior_year_net_sales FROM sales_weeks a
    LEFT JOIN sales_weeks b ON a.iso_week = b.iso_week AND a.iso_year = b.iso_year + 1""",
    exact=True,
)
register(
    "c08_full_outer",
    lambda t: t.fct_orders.filter("is_sample_order = 1").groupBy("order_date", "store").agg(F.count("*").alias("sample_orders"))
    .join(t.fct_orders.filter("is_accessory_only = 1").groupBy("order_date", "store").agg(F.count("*").alias("accessory_orders")),
          ["order_date", "store"], "full").na.fill(0, ["sample_orders", "accessory_orders"]),
    """SELECT order_date, store, count(*) FILTER (is_sample_order = 1) AS sample_orders, count(*) FILTER (is_accessory_only = 1) AS accessory_orders
    FROM k17 WHERE is_sample_order + is_accessory_only > 0 GROUP BY ALL""",
)
register(
    "c09_share_of_total",
    lambda t: t.fct_orders.groupBy("order_year", "store").agg(F.sum("net_sales").alias("net_sales"))
    .withColumn("share", x.safe_divide("net_sales", F.sum("net_sales").over(W.partitionBy("order_year")))),
    f"""SELECT s.*, {safe('net_sales', 'total')} AS share FROM (SELECT order_year, store, sum(net_sales) AS net_sales FROM k17 GROUP BY ALL) s
    JOIN (SELECT order_year, sum(net_sales) AS total FROM k17 GROUP BY ALL) USING (order_year)""",
    exact=True,
)
register(
    "c10_child_with_parent",
    lambda t: t.lines.groupBy("line_item_type", "sku").agg(F.sum("quantity").alias("units"))
    .withColumn("type_units", F.sum("units").over(W.partitionBy("line_item_type"))),
    """SELECT c.*, type_units FROM (SELECT line_item_type, sku, sum(quantity)::BIGINT AS units FROM k02 GROUP BY ALL) c
    JOIN (SELECT line_item_type, sum(quantity)::BIGINT AS type_units FROM k02 GROUP BY ALL) USING (line_item_type)""",
)


def _two_rollups(t):
    fine = t.fct_orders.groupBy("order_date", "store", "order_type").agg(F.count("*").alias("n"))
    per_store = fine.groupBy("order_date", "store").agg(F.sum("n").alias("store_n"))
    per_day = fine.groupBy("order_date").agg(F.sum("n").alias("day_n"))
    return fine.join(per_store, ["order_date", "store"], "left").join(per_day, "order_date", "left")


register(
    "c11_detail_with_two_rollups", _two_rollups,
    """SELECT order_date, store, order_type, n, (sum(n) OVER (PARTITION BY order_date, store))::BIGINT AS store_n,
    (sum(n) OVER (PARTITION BY order_date))::BIGINT AS day_n FROM (SELECT order_date, store, order_type, count(*) AS n FROM k17 GROUP BY ALL)""",
)
register(
    "c12_cross_mart",
    lambda t: t.fct_orders.select("order_id", "store", col("order_date").alias("date_day"))
    .join(t.daily_performance.select("date_day", "store", "total_ad_spend", "new_customers"), ["date_day", "store"], "left"),
    "SELECT order_id, o.store, order_date AS date_day, d.total_ad_spend, d.new_customers FROM k17 o LEFT JOIN k20 d ON d.date_day = order_date AND d.store = o.store",
    exact=True,
)
register(
    "c13_coarser_grain",
    lambda t: t.fct_orders.groupBy(col("order_date").alias("date_day"), "store").agg(F.count("*").alias("n"))
    .join(t.ad_performance.groupBy("date_day").agg(F.sum("spend").alias("spend")), "date_day", "left"),
    """SELECT date_day, store, n, spend FROM (SELECT order_date AS date_day, store, count(*) AS n FROM k17 GROUP BY ALL)
    LEFT JOIN (SELECT date_day, sum(spend) AS spend FROM k25 GROUP BY ALL) USING (date_day)""",
    exact=True,
)
register(
    "c14_three_way_then_aggregate",
    lambda t: t.classified.filter("is_sample_order = 1").select("order_id", "store", "email", "order_date")
    .join(c.roll_up_lines(t.lines).select("order_id", "store", "sampled_base", "sampled_signature"), ["order_id", "store"])
    .join(t.funnel.select("email", "conversion_ind"), "email")
    .groupBy("email", "conversion_ind").agg(F.sum("sampled_base").alias("base_orders"), F.sum("sampled_signature").alias("signature_orders")),
    """SELECT email, conversion_ind, (count(*) FILTER (l.s_base)) AS base_orders, (count(*) FILTER (l.s_signature)) AS signature_orders
    FROM k10 o JOIN line_sums l USING (order_id, store) JOIN k13 USING (email) WHERE is_sample_order = 1 GROUP BY ALL""",
)
register(
    "c15_left_anti",
    lambda t: t.orders.select("order_id", "store").join(t.lines.select("order_id", "store"), ["order_id", "store"], "left_anti"),
    "SELECT order_id, store FROM k01 LEFT JOIN (SELECT DISTINCT order_id, store, 1 AS hit FROM k02) USING (order_id, store) WHERE hit IS NULL",
)
register(
    "c16_left_sparse_key",
    lambda t: left_join_sparse(
        t.classified.select("order_id", "store", "household_key"),
        t.classified.filter(col("household_key").isNotNull()).groupBy("household_key").agg(F.count("*").alias("house_orders")),
        "household_key",
    ),
    """SELECT order_id, store, house AS household_key, house_orders FROM (SELECT o.order_id, o.store, household_key AS house FROM k10 o LEFT JOIN k12 USING (order_id, store))
    LEFT JOIN (SELECT household_key AS house, count(*) AS house_orders FROM k12 GROUP BY ALL) USING (house)""",
)

# --- D: aggregations ------------------------------------------------------------------

register(
    "d01_sum", lambda t: t.lines.groupBy("order_id", "store").agg(F.sum("line_total").alias("line_total"), F.sum("quantity").alias("units")),
    "SELECT order_id, store, sum(line_total) AS line_total, sum(quantity)::BIGINT AS units FROM k02 GROUP BY ALL", exact=True,
)
register(
    "d02_count", lambda t: t.lines.groupBy("sku").agg(F.count("*").alias("n")), "SELECT sku, count(*) AS n FROM k02 GROUP BY sku"
)
register(
    "d03_count_distinct", lambda t: t.fct_order_lines.groupBy("sku", "store").agg(F.count_distinct("email").alias("customers")),
    "SELECT sku, store, count(DISTINCT email) AS customers FROM k18 GROUP BY ALL",
)
PERIODS = {"weekly": "date_trunc('week', order_date)::date", "monthly": "trunc(order_date, 'month')"}


def _by_period(*counts):
    return " UNION ALL ".join(
        f"SELECT '{grain}' AS grain, {start} AS start, {', '.join(counts)} FROM k17 WHERE order_date IS NOT NULL GROUP BY ALL"
        for grain, start in (("weekly", "date_trunc('week', order_date)::DATE"), ("monthly", month("order_date")))
    )


register(  # states per day, merged to weeks and months
    "d03_bitmaps_by_period",
    lambda t: bitmaps.distinct_by_period(
        t.fct_orders.filter("order_date IS NOT NULL"), "order_date", {"orders": "order_id", "customers": "email"}, PERIODS
    ),
    _by_period("count(DISTINCT order_id) AS orders", "count(DISTINCT email) AS customers"),
)
register(
    "d04_conditional_bitmaps",
    lambda t: bitmaps.distinct_by_period(
        t.fct_orders.filter("order_date IS NOT NULL").select(
            "order_date", "email", F.when(col("is_sample_order") == 1, col("email")).alias("sampler"),
            F.when(col("is_product_order") == 1, col("email")).alias("buyer"),
        ),
        "order_date", {"customers": "email", "samplers": "sampler", "buyers": "buyer"}, PERIODS,
    ),
    f"""SELECT * FROM ({_by_period('count(DISTINCT email) AS customers', 'count(DISTINCT email) FILTER (is_sample_order = 1) AS samplers',
      'count(DISTINCT email) FILTER (is_product_order = 1) AS buyers')}) WHERE customers > 0""",
)
register(
    "d04_conditional_distinct",
    lambda t: t.lines.groupBy("store", "vendor").agg(
        F.count_distinct(F.when(col("sample_quantity") > 0, col("color"))).alias("sample_colors"),
        F.count_distinct(F.when(col("product_quantity") > 0, col("color"))).alias("product_colors"),
    ),
    """SELECT store, vendor, count(DISTINCT color) FILTER (sample_quantity > 0) AS sample_colors,
    count(DISTINCT CASE WHEN line_item_type = 'Product' THEN color END) AS product_colors FROM k02 GROUP BY ALL""",
)
register(
    "d05_existence_flag",
    lambda t: c.roll_up_lines(t.lines).select("order_id", "store", *[f"sampled_{n}" for n, _, _ in rules.CATEGORIES]),
    "SELECT order_id, store, "
    + ", ".join(f"count(DISTINCT CASE WHEN line_item_type = 'Sample' AND {cond} THEN 1 END) AS sampled_{n}" for n, cond in (
        ("signature", "(sku LIKE '%-S-%' OR sku LIKE '%-7210-%')"), ("base", "(sku LIKE '%-B-%' OR sku LIKE '%-4805-%')"),
        ("craftsman", "sku LIKE '%-C-%'"), ("silvan", "(sku LIKE '%-7-%' OR sku LIKE '%-7T-%')")))
    + " FROM k02 GROUP BY ALL",
)
register(
    "d06_conditional_sum",
    lambda t: t.fct_orders.groupBy("order_year").agg(
        F.sum(F.when(col("is_product_order") == 1, col("net_sales")).otherwise(0)).alias("product_revenue"),
        F.sum(F.when(col("is_sample_order") == 1, col("net_sales")).otherwise(0)).alias("sample_revenue"),
    ),
    """SELECT order_year, sum(CASE is_product_order WHEN 1 THEN net_sales ELSE 0 END) AS product_revenue,
    sum(CASE is_sample_order WHEN 1 THEN net_sales ELSE 0 END) AS sample_revenue FROM k17 GROUP BY ALL""",
    exact=True,
)
register(
    "d07_conditional_count",
    lambda t: t.events.groupBy("user_pseudo_id").agg(
        F.count_if(col("page_type") == "homepage").alias("homepage_views"), F.count_if(col("page_type") == "cart").alias("cart_views")
    ),
    """SELECT user_pseudo_id, count(CASE WHEN page_type = 'homepage' THEN 1 END) AS homepage_views,
    count(CASE WHEN page_type = 'cart' THEN 1 END) AS cart_views FROM k04_full GROUP BY ALL""",
)
register(
    "d08_first_of_kind",
    lambda t: t.classified.groupBy("email").agg(
        F.min(F.when(col("is_sample_order") == 1, col("order_date"))).alias("first_sample"),
        F.min(F.when(col("has_plank_samples") == 1, col("order_date"))).alias("first_plank"),
    ),
    """SELECT email, min(CASE is_sample_order WHEN 1 THEN order_date END) AS first_sample,
    min(CASE has_plank_samples WHEN 1 THEN order_date END) AS first_plank FROM k10 GROUP BY ALL""",
)
register(
    "d09_ever",
    lambda t: t.classified.groupBy("email").agg(F.max("is_product_order").alias("ever_product"), F.max("has_cut_samples").alias("ever_cut")),
    "SELECT email, max(is_product_order) AS ever_product, max(has_cut_samples) AS ever_cut FROM k10 GROUP BY ALL",
)
register(
    "d10_attribute_pick",
    lambda t: t.fct_orders.groupBy("email").agg(
        F.max(F.when(col("is_first_sample_order") == 1, col("order_id"))).alias("first_sample_order_id"),
        F.max(F.when(col("is_first_product_order") == 1, col("salesperson"))).alias("first_product_salesperson"),
    ),
    """SELECT email, max(CASE is_first_sample_order WHEN 1 THEN order_id END) AS first_sample_order_id,
    max(CASE is_first_product_order WHEN 1 THEN salesperson END) AS first_product_salesperson FROM k17 GROUP BY ALL""",
)
register(
    "d11_conditional_average",
    lambda t: t.fct_orders.groupBy("order_year", "store").agg(
        F.avg("line_item_count").alias("avg_lines"), F.avg(F.when(col("is_product_order") == 1, col("line_item_count"))).alias("avg_product_lines")
    ),
    """SELECT order_year, store, avg(line_item_count) AS avg_lines, avg(CASE is_product_order WHEN 1 THEN line_item_count END) AS avg_product_lines
    FROM k17 GROUP BY ALL""",
)
register(
    "d12_mode",
    lambda t: most_common(t.fct_orders, "email", {"usual_state": "shipping_state", "usual_store": "store"}),
    """SELECT * FROM (SELECT email, shipping_state AS usual_state FROM (SELECT email, shipping_state, count(*) AS n FROM k17 GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY email ORDER BY n DESC, shipping_state NULLS FIRST) = 1)
    JOIN (SELECT email, store AS usual_store FROM (SELECT email, store, count(*) AS n FROM k17 GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY email ORDER BY n DESC, store) = 1) USING (email)""",
)
def _states_by_month(t):
    """States per day, merged to months."""
    known = t.fct_orders.filter("shipping_state IS NOT NULL")
    daily = frequent.states(known, ["store", "order_date"], {"state": "shipping_state"})
    months = frequent.merged(daily.withColumn("month", x.month_start("order_date")), ["store", "month"], ["state"])
    best = frequent.top("state")
    return months.select("store", "month", best["item"].alias("usual_state"), best["count"].alias("orders"))


register(  # fewer values than a state holds, so counts are exact
    "d12_merged_states", _states_by_month,
    f"""SELECT store, month, shipping_state AS usual_state, n AS orders
    FROM (SELECT store, {month('order_date')} AS month, shipping_state, count(*) AS n FROM k17 WHERE shipping_state IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY store, month ORDER BY n DESC, shipping_state) = 1""",
)
register(
    "d12_customers_approximate",
    lambda t: c.dim_customers(t.customers, t.funnel, t.fct_orders, t.as_of, feed.SEGMENTS, approximate=True),
    "SELECT * FROM k16", True,
)
register(
    "d13_group_by_expression",
    lambda t: t.orders.groupBy(x.month_start("order_date").alias("month_start"), F.upper("store").alias("shop")).agg(F.count("*").alias("n")),
    f"SELECT {month('order_date')} AS month_start, upper(store) AS shop, count(*) AS n FROM k01 GROUP BY ALL",
)
register(
    "d14_aggregate_of_aggregate",
    lambda t: t.fct_order_lines.groupBy("order_date", "sku").agg(F.count_distinct("order_id").alias("orders"))
    .groupBy("order_date").agg(F.sum("orders").alias("sku_orders"), F.max("orders").alias("top")),
    """SELECT order_date, sum(n)::BIGINT AS sku_orders, max(n) AS top FROM (SELECT order_date, sku, count(DISTINCT order_id) AS n FROM k18 GROUP BY ALL) GROUP BY ALL""",
)
register(
    "d15_having",
    lambda t: t.households.groupBy("household_key").agg(F.count_distinct("email").alias("emails")).filter("emails > 1"),
    "SELECT household_key, count(DISTINCT email) AS emails FROM k12 GROUP BY ALL HAVING count(DISTINCT email) > 1",
)
register(
    "d16_string_agg_distinct",
    lambda t: t.households.select("household_key", "email").distinct().groupBy("household_key")
    .agg(F.array_join(F.sort_array(F.collect_list("email")), ", ").alias("emails")),
    "SELECT household_key, string_agg(DISTINCT email, ', ' ORDER BY email) AS emails FROM k12 GROUP BY ALL",
)
register(
    "d17_arg_min",
    lambda t: t.orders.filter(col("email").isNotNull()).groupBy("email")
    .agg(F.min_by("order_id", F.struct("processed_at", "order_id")).alias("first_order_id")),
    """SELECT email, list(order_id ORDER BY processed_at, order_id)[1] AS first_order_id FROM k01 WHERE email IS NOT NULL GROUP BY ALL""",
)
register(
    "d18_global_aggregate",
    lambda t: t.fct_orders.agg(
        F.count("*").alias("orders"), F.count_distinct("email").alias("customers"), F.sum("net_sales").alias("net_sales"),
        F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"),
    ),
    """SELECT count(*) AS orders, count(DISTINCT email) AS customers, sum(net_sales) AS net_sales, min(order_date) AS first_day,
    max(order_date) AS last_day FROM k17""",
    exact=True,
)
register(
    "d19_ratio_of_aggregates",
    lambda t: t.fct_orders.groupBy("order_year", "store").agg(F.sum("net_sales").alias("_net"), F.sum("subtotal_price").alias("_gross"))
    .select("order_year", "store", x.relative_change("_net", "_gross").alias("refund_effect")),
    f"SELECT order_year, store, {change('sum(net_sales)', 'sum(subtotal_price)')} AS refund_effect FROM k17 GROUP BY ALL",
)

# --- E: windows ------------------------------------------------------------------------

register(
    "e01_newest_row",
    lambda t: newest_per(t.orders_feed, ["order_id", "store"], ["_fivetran_synced"]).select("order_id", "store", "note", "_fivetran_synced"),
    """SELECT order_id, store, CASE WHEN copy = 1 THEN 'resync' END AS note, placed + to_days(copy) AS _fivetran_synced FROM feed_orders
    QUALIFY row_number() OVER (PARTITION BY order_id, store ORDER BY copy DESC) = 1""",
)
_seq = "PARTITION BY email ORDER BY processed_at, order_id, store"
_up = "ROWS UNBOUNDED PRECEDING"
register(
    "e02_sequence",
    lambda t: t.lifetime.select("order_id", "store", "order_sequence_number"),
    f"SELECT order_id, store, row_number() OVER ({_seq}) AS order_sequence_number FROM k10 WHERE email IS NOT NULL",
)
register(
    "e03_sequence_by_flag",
    lambda t: t.lifetime.select("order_id", "store", "product_order_sequence_number", "sample_order_sequence_number"),
    """SELECT order_id, store, row_number() OVER (PARTITION BY email, is_product_order ORDER BY processed_at, order_id, store) AS product_order_sequence_number,
    row_number() OVER (PARTITION BY email, is_sample_order ORDER BY processed_at, order_id, store) AS sample_order_sequence_number
    FROM k10 WHERE email IS NOT NULL""",
)
register(
    "e04_rank_in_period",
    lambda t: t.fct_orders.groupBy("order_year", "order_month", "salesperson").agg(F.sum("net_sales").alias("net_sales"))
    .withColumn("rank", F.row_number().over(W.partitionBy("order_year", "order_month").orderBy(F.desc("net_sales"), "salesperson"))),
    """SELECT *, row_number() OVER (PARTITION BY order_year, order_month ORDER BY net_sales DESC, salesperson) AS rank
    FROM (SELECT order_year, order_month, salesperson, sum(net_sales) AS net_sales FROM k17 GROUP BY ALL)""",
    exact=True,
)
register(
    "e05_running_sum",
    lambda t: running_totals(
        t.classified.filter(col("email").isNotNull()).select("order_id", "store", "email", "order_date", "processed_at", "net_sales"),
        "email", "order_date", ["processed_at", "order_id", "store"], {"lifetime_total_revenue": col("net_sales")},
    ).select("order_id", "store", "lifetime_total_revenue"),
    f"SELECT order_id, store, sum(net_sales) OVER ({_seq} {_up}) AS lifetime_total_revenue FROM k10 WHERE email IS NOT NULL",
    exact=True,
)
register(
    "e06_running_count",
    lambda t: running_totals(
        t.classified.filter(col("email").isNotNull()).select("order_id", "store", "email", "order_date", "processed_at"),
        "email", "order_date", ["processed_at", "order_id", "store"], {"orders_so_far": F.lit(1)},
    ).select("order_id", "store", "orders_so_far"),
    f"SELECT order_id, store, count(*) OVER ({_seq} {_up}) AS orders_so_far FROM k10 WHERE email IS NOT NULL",
)


def _daily_type(t):
    return t.fct_orders.groupBy("store", "order_type", "order_date").agg(F.count("*").alias("n"))


register(
    "e07_running_sum_with_peers",
    lambda t: _daily_type(t).withColumn("so_far", F.sum("n").over(W.partitionBy("store").orderBy("order_date"))),
    """SELECT store, order_type, order_date, n, (sum(n) OVER (PARTITION BY store ORDER BY order_date))::BIGINT AS so_far
    FROM (SELECT store, order_type, order_date, count(*) AS n FROM k17 GROUP BY ALL)""",
)
register(
    "e08_cumulative_of_aggregate",
    lambda t: t.monthly_cohorts.select("cohort_month", "primary_store", "months_since_first_order", "cumulative_ltv"),
    """SELECT cohort_month, primary_store, months_since_first_order, sum(cohort_revenue) OVER (PARTITION BY cohort_month, primary_store
    ORDER BY months_since_first_order ROWS UNBOUNDED PRECEDING) AS cumulative_ltv FROM k22""",
    exact=True,
)
_sku_days = "(SELECT store, sku, order_date, sum(quantity)::BIGINT AS units FROM k18 GROUP BY ALL)"


def _sku_day(t):
    return t.fct_order_lines.groupBy("store", "sku", "order_date").agg(F.sum("quantity").alias("units"))




def _sw():
    return W.partitionBy("store", "sku").orderBy("order_date")


_so = "PARTITION BY store, sku ORDER BY order_date"
register(
    "e09_lag", lambda t: _sku_day(t).withColumn("before", F.lag("units").over(_sw())),
    f"SELECT *, lag(units) OVER ({_so}) AS before FROM {_sku_days}",
)
register(
    "e10_global_lag",
    lambda t: _weeks(t).withColumn("prev_week_net_sales", F.lag("net_sales").over(W.orderBy("week_start"))).drop("total_orders"),
    "SELECT iso_year, iso_week, week_start, net_sales, lag(net_sales) OVER (ORDER BY week_start) AS prev_week_net_sales FROM sales_weeks",
    exact=True,
)
register(
    "e11_lag_n",
    lambda t: _sku_day(t).withColumns({f"lag_{n}": F.lag("units", n).over(_sw()) for n in (7, 14, 28)}),
    f"SELECT *, {', '.join(f'lag(units, {n}) OVER ({_so}) AS lag_{n}' for n in (7, 14, 28))} FROM {_sku_days}",
)
register(
    "e12_days_since_last",
    lambda t: _sku_day(t).withColumn("days", F.datediff("order_date", F.lag("order_date").over(_sw()))),
    f"SELECT *, order_date - lag(order_date) OVER ({_so}) AS days FROM {_sku_days}",
)
register(
    "e13_lag_of_rank",
    lambda t: t.sample_sku_ranking.select("iso_year", "iso_week", "sku", "product_line", "weekly_rank", "prev_week_rank"),
    """SELECT iso_year, iso_week, sku, product_line, weekly_rank, lag(weekly_rank) OVER (PARTITION BY sku ORDER BY week_start, product_line) AS prev_week_rank FROM k34""",
)
register(
    "e14_moving_average",
    lambda t: _sku_day(t).withColumns({f"avg_{n}": F.avg("units").over(_sw().rowsBetween(1 - n, 0)) for n in (7, 28, 90)}),
    f"SELECT *, {', '.join(f'(sum(units) OVER ({_so} ROWS {n - 1} PRECEDING))::DOUBLE / count(*) OVER ({_so} ROWS {n - 1} PRECEDING) AS avg_{n}' for n in (7, 28, 90))} FROM {_sku_days}",
)
register(
    "e15_moving_stddev",
    lambda t: _sku_day(t).withColumn("sd", F.round(F.stddev_samp("units").over(_sw().rowsBetween(-27, 0)), 6)),
    f"SELECT *, round(stddev_samp(units) OVER ({_so} ROWS 27 PRECEDING), 6) AS sd FROM {_sku_days}",
)
register(
    "e16_trailing_sum", lambda t: _sku_day(t).withColumn("t6", trailing("units", _sw(), 6)),
    f"SELECT *, (sum(units) OVER ({_so} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))::BIGINT AS t6 FROM {_sku_days}",
)
register(
    "e17_prior_sum", lambda t: _sku_day(t).withColumn("p6", prior("units", _sw(), 6)),
    f"SELECT *, (sum(units) OVER ({_so} ROWS BETWEEN 11 PRECEDING AND 6 PRECEDING))::BIGINT AS p6 FROM {_sku_days}",
)
register(
    "e18_frame_count", lambda t: _sku_day(t).withColumn("rows_6", F.count("*").over(_sw().rowsBetween(-5, 0))),
    f"SELECT *, count(*) OVER ({_so} ROWS 5 PRECEDING) AS rows_6 FROM {_sku_days}",
)
register(
    "e19_partition_minimum",
    lambda t: _sku_day(t).withColumn("days", F.datediff("order_date", F.min("order_date").over(W.partitionBy("store", "sku")))),
    f"SELECT *, order_date - min(order_date) OVER (PARTITION BY store, sku) AS days FROM {_sku_days}",
)
register(
    "e20_first_value",
    lambda t: t.lifetime.select("order_id", "store", "days_since_first_order"),
    f"SELECT order_id, store, order_date - first_value(order_date) OVER ({_seq}) AS days_since_first_order FROM k10 WHERE email IS NOT NULL",
)
register(
    "e21_window_in_arithmetic",
    lambda t: _sku_day(t).withColumn("change", x.relative_change("units", F.lag("units").over(_sw()))),
    f"SELECT *, {change('units', f'lag(units) OVER ({_so})')} AS change FROM {_sku_days}",
)

# --- F: order and limit -----------------------------------------------------------------

register(
    "f01_top_n",
    lambda t: t.lines.groupBy("color", "line_item_type").agg(F.count("*").alias("n"), F.sum("line_total").alias("revenue"))
    .orderBy(F.desc("revenue"), "color", "line_item_type").limit(20),
    "SELECT color, line_item_type, count(*) AS n, sum(line_total) AS revenue FROM k02 GROUP BY ALL ORDER BY revenue DESC, color, line_item_type LIMIT 20",
    exact=True,
)
register(
    "f02_multi_key_order",
    lambda t: t.ad_performance.groupBy("date_day", "channel").agg(F.sum("spend").alias("spend")).orderBy(F.desc("date_day"), F.asc("channel")),
    "SELECT date_day, channel, sum(spend) AS spend FROM k25 GROUP BY ALL ORDER BY date_day DESC, channel",
    exact=True,
)
_edges = ["0-15 days", "16-30 days", "31-60 days", "61-120 days", "120+ days", "No Conversion"]
register(
    "f03_custom_order",
    lambda t: t.sample_conversions.groupBy("conversion_window_bucket").agg(F.count("*").alias("customers"))
    .orderBy(x.ladder([(col("conversion_window_bucket") == b, i) for i, b in enumerate(_edges)])),
    f"SELECT conversion_window_bucket, count(*) AS customers FROM k19 GROUP BY conversion_window_bucket ORDER BY list_position({_edges}, conversion_window_bucket)",
)
register(
    "f04_top_one_per_group",
    lambda t: t.fct_orders.groupBy("email").agg(
        F.max_by(F.struct("order_id", "order_date", "net_sales"), F.struct("net_sales", "order_id")).alias("best")
    ).select("email", "best.order_id", "best.order_date", "best.net_sales"),
    """SELECT email, order_id, order_date, net_sales FROM k17 QUALIFY row_number() OVER (PARTITION BY email ORDER BY net_sales DESC, order_id DESC) = 1""",
    exact=True,
)
_best = "GROUP BY sku ORDER BY sum(quantity) DESC, sku LIMIT 1"


def _best_sku(t):
    top = t.fct_order_lines.groupBy("sku").agg(F.sum("quantity").alias("n")).orderBy(F.desc("n"), "sku").limit(1)
    return t.fct_order_lines.join(F.broadcast(top.select("sku")), "sku").groupBy("sku", "order_date").agg(F.sum("quantity").alias("units"))


register(
    "f05_top_key_as_filter", _best_sku,
    f"SELECT sku, order_date, sum(quantity)::BIGINT AS units FROM k18 WHERE sku = (SELECT sku FROM k18 {_best}) GROUP BY ALL",
)

# --- G: set operations --------------------------------------------------------------------


def _per_store(t):
    lines = t.lines_feed.select("order_line_id", "order_id", "sku", "store")
    feeds = {name: lines.filter(col("store") == name).drop("store") for name in ("regular", "commercial")}
    return union_stores(feeds)


register("g01_union_stores", _per_store, "SELECT order_line_id, order_id, sku, store FROM feed_lines")
register(
    "g02_union_padded",
    lambda t: stack(
        t.social_ads.select("date_day", "channel", "campaign_name", "ad_name", "clicks"),
        t.search_ads.select("date_day", "channel", "campaign_name", "clicks"),
    ),
    """SELECT date_day, channel, campaign_name, ad_name, clicks FROM k05 UNION ALL SELECT date_day, channel, campaign_name, NULL, clicks FROM k06""",
)
register(
    "g03_union_of_grains",
    lambda t: stack(
        t.fct_orders.groupBy(x.month_start("order_date").alias("period")).agg(F.count("*").alias("n")).withColumn("grain", F.lit("monthly")),
        t.fct_orders.groupBy(x.iso_week_start("order_date").alias("period")).agg(F.count("*").alias("n")).withColumn("grain", F.lit("weekly")),
    ),
    f"""SELECT {month('order_date')} AS period, count(*) AS n, 'monthly' AS grain FROM k17 GROUP BY ALL
    UNION ALL SELECT {monday('order_date')}, count(*), 'weekly' FROM k17 GROUP BY ALL""",
)

# --- H: scalar functions --------------------------------------------------------------------


def _scalar(name, table, keys, spark, sql, cte):
    """A scalar function over every row of a result, next to its keys."""
    register(
        name, lambda t: table(t).select(*keys, *[v.alias(k) for k, v in spark().items()]),
        f"SELECT {', '.join(keys)}, {', '.join(f'{v} AS {k}' for k, v in sql.items())} FROM {cte}",
    )


def _o(t):
    return t.orders


def _raw_o(t):
    return t.table("orders")


def _part(t):
    return t.table("part")


_ok = ["order_id", "store"]
_rawk = ["o_orderkey"]
_scalar("h01_lower", _part, ["p_partkey"], lambda: {"low": F.lower("p_brand")}, {"low": "lower(p_brand)"}, "part")
_scalar("h02_trim", _part, ["p_partkey"], lambda: {"out": F.trim(F.concat(F.lit("  "), "p_name", F.lit(" ")))},
        {"out": "trim('  ' || p_name || ' ')"}, "part")
_scalar("h03_left", _o, _ok, lambda: {"zip5": F.left("shipping_address_zip", F.lit(5))}, {"zip5": "left(shipping_address_zip, 5)"}, "k01")
_scalar("h04_concat", _o, _ok, lambda: {"key": x.household_key("shipping_address_line1", "shipping_address_zip")},
        {"key": "coalesce(shipping_address_line1, '') || '|' || coalesce(shipping_address_zip, '')"}, "k01")
_scalar(
    "h05_like", _part, ["p_partkey"],
    lambda: {"prefix": col("p_name").like("red%"), "inside": col("p_name").like("%ld%"), "suffix": col("p_name").like("%gear"),
     "many": col("p_name").like("%o%l%")},
    {"prefix": "starts_with(p_name, 'red')", "inside": "contains(p_name, 'ld')", "suffix": "ends_with(p_name, 'gear')",
     "many": "regexp_matches(p_name, 'o.*l')"}, "part",
)
_scalar("h06_regexp_extract", _o, _ok, lambda: {"seller": x.first_group("tags", rules.SALESPERSON_TAG)},
        {"seller": "nullif(regexp_extract(tags, 'Salesperson: (.*?),', 1), '')"}, "k01")
_scalar("h07_regexp_replace", _o, _ok, lambda: {"address": x.normalised_address("shipping_address_line1")},
        {"address": "trim(regexp_replace(regexp_replace(lower(shipping_address_line1), '[.,#-]', '', 'g'), '\\s+', ' ', 'g'))"}, "k01")
register(
    "h08_stable_hash",
    lambda t: t.households.groupBy("household_id")
    .agg(F.min("household_key").alias("household_key"), F.count("*").alias("orders"), F.count_distinct("household_key").alias("keys")),
    "SELECT household_id, min(household_key) AS household_key, count(*) AS orders, count(DISTINCT household_key) AS keys FROM k12 GROUP BY ALL",
)
_scalar("h09_timestamp_micros", lambda t: t.events_feed, ["event_bundle_sequence_id"], lambda: {"at": x.micros_to_utc("event_timestamp")},
        {"at": "event_timestamp_utc"}, "k04")
_scalar("h10_civil_time", _raw_o, _rawk, lambda: {"pacific": x.civil_time(col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(5)), rules.PACIFIC)},
        {"pacific": local("(o_orderdate + INTERVAL 5 HOUR)")}, "orders")
_scalar("h11_date", _raw_o, _rawk, lambda: {"day": F.to_date("o_orderdate")}, {"day": "CAST(o_orderdate AS DATE)"}, "orders")
_scalar("h12_date_diff_day", _o, _ok, lambda: {"days": F.datediff(F.lit("1998-06-15").cast("date"), "order_date")},
        {"days": "DATE '1998-06-15' - order_date"}, "k01")
_scalar("h13_date_diff_month", _o, _ok, lambda: {"months": x.month_gap("order_date", F.lit("1995-01-31").cast("date"))},
        {"months": "datediff('month', DATE '1995-01-31', order_date)"}, "k01")
_scalar("h14_datetime_diff_second", lambda t: t.events, ["event_bundle_sequence_id"],
        lambda: {"gap": x.second_gap("event_timestamp_pt", "event_previous_timestamp_pt")},
        {"gap": "epoch(date_trunc('second', event_timestamp_pt))::BIGINT - epoch(date_trunc('second', event_previous_timestamp_pt))::BIGINT"}, "k04")
_scalar("h15_timestamp_diff_minute", lambda t: t.events, ["event_bundle_sequence_id"],
        lambda: {"gap": x.minutes_elapsed("event_timestamp_pt", "event_previous_timestamp_pt")},
        {"gap": "datesub('minute', event_previous_timestamp_pt, event_timestamp_pt)"}, "k04")
_scalar("h16_month_start", _o, _ok, lambda: {"d": x.month_start("order_date")}, {"d": "make_date(year(order_date), month(order_date), 1)"}, "k01")
_scalar("h17_sunday_week", _o, _ok, lambda: {"d": x.sunday_week_start("order_date")}, {"d": sunday("order_date")}, "k01")
_scalar("h18_iso_week_start", _o, _ok, lambda: {"d": x.iso_week_start("order_date")}, {"d": "order_date - CAST(isodow(order_date) - 1 AS INTEGER)"}, "k01")
_scalar("h19_iso_week_parts", _o, _ok, lambda: {"y": x.iso_year("order_date"), "w": x.iso_week("order_date")},
        {"y": "strftime(order_date, '%G')::INTEGER", "w": "strftime(order_date, '%V')::INTEGER"}, "k01")
_scalar("h20_sunday_week_number", _o, _ok, lambda: {"w": x.sunday_week_number("order_date")}, {"w": "strftime(order_date, '%U')::INTEGER"}, "k01")
_scalar("h21_date_parts", _o, _ok, lambda: {"y": F.year("order_date"), "q": F.quarter("order_date"), "m": F.month("order_date"),
                                    "d": F.dayofmonth("order_date"), "n": F.dayofyear("order_date")},
        {"y": "year(order_date)", "q": "quarter(order_date)", "m": "month(order_date)", "d": "day(order_date)", "n": "dayofyear(order_date)"}, "k01")
_scalar("h22_day_of_week", _o, _ok, lambda: {"d": F.dayofweek("order_date")}, {"d": "dayofweek(order_date) + 1"}, "k01")
_scalar("h23_day_name", _o, _ok, lambda: {"d": F.date_format("order_date", "EEEE")}, {"d": "strftime(order_date, '%A')"}, "k01")
_scalar("h24_shard_name", _o, _ok, lambda: {"d": F.date_format("order_date", "yyyyMMdd")}, {"d": "strftime(order_date, '%Y%m%d')"}, "k01")
_scalar("h25_last_day", _o, _ok, lambda: {"d": F.last_day("order_date")}, {"d": "last_day(order_date)"}, "k01")
_scalar("h26_add_months", _o, _ok, lambda: {"d": F.add_months("order_date", F.lit(1)), "e": F.add_months("order_date", F.lit(-13))},
        {"d": "CAST(order_date + INTERVAL 1 MONTH AS DATE)", "e": "CAST(order_date - INTERVAL 13 MONTH AS DATE)"}, "k01")
register(
    "h27_days_before",
    lambda t: t.orders.filter(col("order_date") >= F.date_sub(t.as_of, 365)).select("order_id", "store", "order_date"),
    "SELECT order_id, store, order_date FROM k01 WHERE order_date >= DATE '2001-12-31' - 365",
)
_scalar(
    "h28_holiday", _o, _ok, lambda: {"holiday": m.holiday_name("order_date")},
    {"holiday": """CASE WHEN month(order_date) = 11 AND isodow(order_date) = 4 AND day(order_date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
      WHEN month(order_date) = 11 AND isodow(order_date) = 5 AND day(order_date) BETWEEN 23 AND 29 THEN 'Black Friday'
      WHEN month(order_date) = 11 AND isodow(order_date) = 1 AND day(order_date) >= 25 THEN 'Cyber Monday'
      ELSE MAP {'0101': 'New Years', '0704': 'July 4th', '1225': 'Christmas'}[strftime(order_date, '%m%d')] END"""}, "k01",
)
_scalar("h29_round", _part, ["p_partkey"], lambda: {"third": F.round(_money("p_retailprice") / F.lit(8), 2).cast("double"),
                                            "minus": F.round(-_money("p_retailprice") / F.lit(8), 2).cast("double")},
        {"third": ratio("p_retailprice", "8"), "minus": ratio("-p_retailprice", "8")}, "part")
_scalar("h30_arithmetic", lambda t: t.table("customer"), ["c_custkey"],
        lambda: {"size": F.abs("c_acctbal"), "double_it": col("c_acctbal") * 2, "less": col("c_acctbal") - 100, "part": col("c_acctbal") / 4},
        {"size": "abs(c_acctbal)", "double_it": "c_acctbal * 2", "less": "c_acctbal - 100", "part": "c_acctbal / 4"}, "customer")
_scalar("h31_safe_divide", _part, ["p_partkey"], lambda: {"q": x.safe_divide("p_retailprice", col("p_size") % 5)},
        {"q": safe("p_retailprice", "p_size % 5")}, "part")
_scalar("h32_nullif", _part, ["p_partkey"], lambda: {"n": F.nullif(col("p_size") % 5, F.lit(0))}, {"n": "nullif(p_size % 5, 0)"}, "part")
_scalar("h33_ratio_else_null", _part, ["p_partkey"], lambda: {"q": x.percent("p_size", col("p_size") % 7), "u": x.plain_ratio("p_size", col("p_size") % 7)},
        {"q": pct("p_size", "(p_size % 7)"), "u": div("p_size", "(p_size % 7)")}, "part")
_scalar("h34_ratio_else_zero", _part, ["p_partkey"], lambda: {"q": x.percent("p_size", col("p_size") % 7, otherwise=0)},
        {"q": pct("p_size", "(p_size % 7)", "0")}, "part")
_scalar(
    "h35_cast", lambda t: t.table("lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"],
    lambda: {"as_long": col("l_quantity").cast("bigint"), "as_text": col("l_linenumber").cast("string"), "as_date": col("l_shipdate").cast("date"),
     "as_double": col("l_linenumber").cast("double"), "dirty": F.col("l_returnflag").try_cast("int")},
    {"as_long": "l_quantity::BIGINT", "as_text": "l_linenumber::VARCHAR", "as_date": "l_shipdate::DATE",
     "as_double": "l_linenumber::DOUBLE", "dirty": "TRY_CAST(l_returnflag AS INTEGER)"}, "lineitem",
)
_scalar("h36_coalesce", _o, _ok, lambda: {"place": F.coalesce("shipping_address_city", "shipping_state", F.lit("unknown"))},
        {"place": "coalesce(shipping_address_city, shipping_state, 'unknown')"}, "k01")
_scalar(
    "h37_least", lambda t: t.funnel, ["email"],
    lambda: {"days": F.least(F.coalesce("days_to_order", F.lit(rules.NO_GAP)), F.coalesce("household_days_to_order", F.lit(rules.NO_GAP)))},
    {"days": "least(coalesce(days_to_order, 999999), coalesce(household_days_to_order, 999999))"}, "k13",
)
_scalar(
    "h38_param_lookup", lambda t: t.events_feed, ["event_bundle_sequence_id"],
    lambda: {"session": x.param_value("event_params", "ga_session_id", "int"), "amount": x.param_value("event_params", "value", "double"),
     "deal": x.param_value("event_params", "transaction_id", "string"), "wrong_type": x.param_value("event_params", "price", "double")},
    {"session": "ga_session_id", "amount": "transaction_value", "deal": "transaction_id", "wrong_type": "NULL::DOUBLE"}, "k04",
)
_scalar("h39_array_subscript", lambda t: t.events_feed, ["event_bundle_sequence_id"],
        lambda: {"first_key": F.get("event_params", F.lit(0))["key"], "tenth_key": F.get("event_params", F.lit(9))["key"]},
        {"first_key": "'page_location'", "tenth_key": "NULL::VARCHAR"}, "k04")
register(
    "h40_page_type",
    lambda t: t.events_feed.select("event_bundle_sequence_id", s.page_type(x.param_value("event_params", "page_location", "string")).alias("page_type")),
    "SELECT event_bundle_sequence_id, page_type FROM k04_full",
)
register(
    "h41_event_flags",
    lambda t: t.events.select("event_bundle_sequence_id", *[f"is_{n}" for n in rules.EVENT_FLAGS]),
    "SELECT event_bundle_sequence_id, " + ", ".join(f"(event_name = '{n}')::INTEGER AS is_{n}" for n in rules.EVENT_FLAGS) + " FROM k04",
)
