"""L, M and N: data checks, consumer queries and documented rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from oracle.sql import arms, flag, monday, month, pct, ratio, safe
from shoploom.catalog.registry import register
from shoploom.functions import exprs as x
from shoploom.operators import quality as q
from shoploom.plans import consumers as u
from shoploom.plans import customers as c
from shoploom.plans import extensions as e

col = F.col


def _day(text: str):
    return F.lit(text).cast("date")


# --- L: data checks -------------------------------------------------------------------

register(
    "l01_not_null", lambda t: q.not_null(t.orders, "email").select("order_id", "store"),
    "SELECT order_id, store FROM k01 WHERE email IS NULL",
)
register(
    "l02_unique", lambda t: q.unique(t.orders_feed, ["order_id", "store"]),
    "SELECT order_id, store, count(*) AS n FROM feed_orders GROUP BY ALL HAVING count(*) > 1",
)
register(
    "l03_accepted_values", lambda t: q.accepted_values(t.fct_orders, "customer_status", ["New Customer", "Returning Customer"]),
    "SELECT customer_status, count(*) AS n FROM k17 WHERE customer_status NOT IN ('New Customer', 'Returning Customer') GROUP BY ALL",
)
register(
    "l04_relationship",
    lambda t: q.relationship(t.fct_orders, "email", t.dim_customers, "email").select("order_id", "store", "email"),
    "SELECT order_id, store, email FROM k17 WHERE email NOT IN (SELECT email FROM k16)",
)
register(
    "l05_compare_counts",
    lambda t: q.compare({"orders": t.fct_orders, "staged": t.orders}, [F.count("*").alias("row_count")]),
    "SELECT 'orders' AS source, count(*) AS row_count FROM k17 UNION ALL SELECT 'staged', count(*) FROM k01",
)


def _kpis():
    return [
        F.count("*").alias("customers"), F.count_if(col("conversion_ind") == 1).alias("converted"),
        x.rounded_ratio(F.sum("days_to_order"), F.count("days_to_order")).alias("avg_days_to_order"),
        *[F.count_if(col(f"converted_within_{n}d") == 1).alias(f"converted_{n}d") for n in (15, 30, 60, 120)],
    ]


_kpi_sql = (
    "count(*) AS customers, count(*) FILTER (conversion_ind = 1) AS converted, "
    + ratio("sum(days_to_order)", "count(days_to_order)") + " AS avg_days_to_order, "
    + ", ".join(f"count(*) FILTER (converted_within_{n}d = 1) AS converted_{n}d" for n in (15, 30, 60, 120))
)


def _both(t):
    return {"mart": t.sample_conversions, "funnel": t.funnel.filter(col("first_sample_order_date").isNotNull())}


_samplers = "(SELECT * FROM k13 WHERE first_sample_order_date IS NOT NULL)"
_both_sql = f"(SELECT 'mart' AS source, {_kpi_sql} FROM k19 UNION ALL SELECT 'funnel', {_kpi_sql} FROM {_samplers})"
register("l06_compare_metrics", lambda t: q.compare(_both(t), _kpis()), f"SELECT * FROM {_both_sql}")
register(
    "l06_compare_metrics_tolerance",
    lambda t: q.within_tolerance(q.compare(_both(t), _kpis()), ["customers", "converted", "avg_days_to_order"], "funnel", "mart"),
    f"""SELECT metric, f AS base_value, m AS other_value, abs(f - m) <= 0.01 * abs(f) AS is_within FROM (
    SELECT metric, max(value) FILTER (source = 'funnel') AS f, max(value) FILTER (source = 'mart') AS m
    FROM (UNPIVOT (SELECT source, customers::DOUBLE AS customers, converted::DOUBLE AS converted, avg_days_to_order FROM {_both_sql})
      ON customers, converted, avg_days_to_order INTO NAME metric VALUE value) GROUP BY metric)""",
)
register(
    "l07_compare_distribution",
    lambda t: q.compare(_both(t), [
        F.count("*").alias("customers"), F.sum("conversion_ind").alias("converted"),
        x.percent(F.sum("conversion_ind"), F.count("*")).alias("conversion_rate_pct"),
    ], [col("sample_order_type")]),
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS source, sample_order_type, count(*) AS customers, sum(conversion_ind)::BIGINT AS converted, "
        f"{pct('sum(conversion_ind)', 'count(*)')} AS conversion_rate_pct FROM {f} GROUP BY ALL"
        for n, f in (("mart", "k19"), ("funnel", _samplers))
    ),
)


def _lifetime(df, orders, revenue):
    return df.groupBy("email").agg(orders.alias("n"), revenue.alias("v"))


register(
    "l08_compare_lifetime",
    lambda t: q.compare({
        "running": _lifetime(t.fct_orders, F.max("lifetime_product_orders"), F.max("lifetime_product_revenue")),
        "summed": _lifetime(t.classified.filter(col("email").isNotNull()), F.sum("is_product_order"), F.sum("product_revenue")),
    }, [F.count("*").alias("customers"), x.rounded_ratio(F.sum("v"), F.count("v")).alias("avg_revenue"),
        x.rounded_ratio(F.sum("n"), F.count("n")).alias("avg_orders")]),
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS source, count(*) AS customers, {ratio('sum(v)', 'count(v)')} AS avg_revenue, {ratio('sum(n)', 'count(n)')} AS avg_orders FROM "
        f"(SELECT email, {n} AS n, {v} AS v FROM {src} GROUP BY email)"
        for name, n, v, src in (
            ("running", "max(lifetime_product_orders)", "max(lifetime_product_revenue)", "k17"),
            ("summed", "sum(is_product_order)", "sum(product_revenue)", "k10 WHERE email IS NOT NULL"),
        )
    ),
)
register(
    "l09_profile_status",
    lambda t: t.fct_orders.groupBy("customer_status").agg(F.count("*").alias("order_count"), F.sum("net_sales").alias("net_sales"))
    .orderBy(F.desc("net_sales")),
    "SELECT customer_status, count(*) AS order_count, sum(net_sales) AS net_sales FROM k17 GROUP BY customer_status ORDER BY 3 DESC",
    exact=True,
)
register(
    "l09_profile_segment",
    lambda t: t.dim_customers.groupBy("customer_segment").agg(
        F.count("*").alias("customer_count"), x.rounded_ratio(F.sum("lifetime_total_revenue"), F.count("*")).alias("avg_lifetime_revenue"),
        x.rounded_ratio(F.sum("lifetime_total_orders"), F.count("*")).alias("avg_lifetime_orders"),
    ).orderBy(F.desc("customer_count")),
    f"""SELECT customer_segment, count(*) AS customer_count, {ratio('sum(lifetime_total_revenue)', 'count(*)')} AS avg_lifetime_revenue,
    {ratio('sum(lifetime_total_orders)', 'count(*)')} AS avg_lifetime_orders FROM k16 GROUP BY ALL""",
)
register(
    "l09_profile_group",
    lambda t: t.dim_customers.filter(col("first_sample_order_date").isNotNull()).groupBy("customer_group").agg(
        F.count("*").alias("customer_count"), x.rounded_ratio(F.sum("lifetime_product_revenue"), F.count("*")).alias("avg_product_revenue"),
        F.count_if(col("conversion_ind") == 1).alias("converted_customers"),
        x.percent(F.count_if(col("conversion_ind") == 1), F.count("*")).alias("conversion_rate_pct"),
    ),
    f"""SELECT customer_group, count(*) AS customer_count, {ratio('sum(lifetime_product_revenue)', 'count(*)')} AS avg_product_revenue,
    count(*) FILTER (conversion_ind = 1) AS converted_customers, {pct('(count(*) FILTER (conversion_ind = 1))', 'count(*)')} AS conversion_rate_pct
    FROM k16 WHERE first_sample_order_date IS NOT NULL GROUP BY ALL""",
)


def _orphans(t):
    lineless = t.fct_orders.select("order_id", "store").join(t.lines.select("order_id", "store"), ["order_id", "store"], "left_anti")
    known = t.dim_customers.select("email")
    unknown = t.fct_orders.select("email").distinct().join(known, "email", "left_anti")
    sampler = t.sample_conversions.select("email").join(known, "email", "left_anti")
    return (
        q.violations(lineless, "orders without lines", F.lit(True))
        .unionByName(q.violations(unknown, "orders without customer", F.lit(True)))
        .unionByName(q.violations(sampler, "samplers without customer", F.lit(True)))
    )


register(
    "l10_orphans", _orphans,
    """SELECT 'orders without lines' AS check_name, count(*) AS violations FROM k17 o WHERE NOT EXISTS (FROM k02 l WHERE l.order_id = o.order_id AND l.store = o.store)
    UNION ALL SELECT 'orders without customer', count(DISTINCT email) FROM k17 WHERE email NOT IN (SELECT email FROM k16)
    UNION ALL SELECT 'samplers without customer', count(*) FROM k19 WHERE email NOT IN (SELECT email FROM k16)""",
)
register(
    "l11_invariants",
    lambda t: q.violations(t.fct_orders, "negative net sales", col("net_sales") < 0)
    .unionByName(q.violations(t.fct_orders, "order above lifetime", col("product_revenue") > col("lifetime_product_revenue")))
    .unionByName(q.violations(t.sample_conversions, "sample after purchase", col("first_sample_order_date") > col("first_product_order_date"))),
    """SELECT 'negative net sales' AS check_name, count(*) AS violations FROM k17 WHERE net_sales < 0
    UNION ALL SELECT 'order above lifetime', count(*) FROM k17 WHERE product_revenue > lifetime_product_revenue
    UNION ALL SELECT 'sample after purchase', count(*) FROM k19 WHERE first_sample_order_date > first_product_order_date""",
)
register(
    "l12_impossible_progress",
    lambda t: q.violations(t.sessions, "checkout without cart", (col("reached_begin_checkout") == 1) & (col("reached_add_to_cart") == 0)),
    "SELECT 'checkout without cart' AS check_name, count(*) AS violations FROM k14 WHERE reached_begin_checkout > reached_add_to_cart",
)


def _spread(df, keys, column):
    return df.groupBy(*keys).agg(
        F.min(column).alias("smallest"), F.max(column).alias("largest"), F.count_distinct(column).alias("n")
    )


register(
    "l13_constant_in_group",
    lambda t: _spread(t.monthly_cohorts, ["cohort_month", "primary_store"], "cohort_size").filter("n > 1"),
    """SELECT cohort_month, primary_store, min(cohort_size) AS smallest, max(cohort_size) AS largest, count(DISTINCT cohort_size) AS n
    FROM k22 GROUP BY ALL HAVING count(DISTINCT cohort_size) > 1""",
)
register(
    "l14_hash_stability",
    lambda t: t.households.groupBy("household_key").agg(
        F.count_distinct("household_id").alias("ids"), F.count("*").alias("orders")
    ),
    "SELECT household_key, 1::BIGINT AS ids, count(*) AS orders FROM k12 GROUP BY ALL",
)
register(
    "l15_truth_table",
    lambda t: t.sample_conversions.groupBy("conversion_ind", "household_conversion_ind", "hybrid_conversion_ind")
    .agg(F.count("*").alias("customer_count")),
    "SELECT conversion_ind, household_conversion_ind, hybrid_conversion_ind, count(DISTINCT email) AS customer_count FROM k19 GROUP BY ALL",
)

# --- M: consumer queries -----------------------------------------------------------------

_SINCE, _SINCE_SQL = "1996-01-01", "DATE '1996-01-01'"
_conv = {"email": "conversion_ind", "household": "household_conversion_ind", "hybrid": "hybrid_conversion_ind"}
_cnt = {k: f"(count(DISTINCT email) FILTER ({v} = 1))" for k, v in _conv.items()}
register(
    "m01_conversion_lift", lambda t: u.conversion_lift(t.sample_conversions, _day(_SINCE)),
    f"""SELECT {_cnt['email']} AS email_converters, count(DISTINCT email) AS total_samplers, {pct(_cnt['email'], 'count(DISTINCT email)')} AS email_conversion_rate,
    {_cnt['hybrid']} AS hybrid_converters, {pct(_cnt['hybrid'], 'count(DISTINCT email)')} AS hybrid_conversion_rate,
    {pct(f"({_cnt['hybrid']} - {_cnt['email']})", 'count(DISTINCT email)')} AS conversion_rate_lift FROM k19 WHERE first_sample_order_date >= {_SINCE_SQL}""",
)
# k19 carries no household key; each email has one home.
_housed = "(SELECT k19.*, house FROM k19 JOIN funnel_home USING (email))"
register(
    "m02_multi_email_households", lambda t: u.multi_email_households(t.sample_conversions).drop("household_id"),
    f"""SELECT household_email_count, string_agg(DISTINCT email, ', ' ORDER BY email) AS emails_in_household, max(conversion_ind) AS any_email_converted,
    max(household_conversion_ind) AS household_converted, min(first_sample_order_date) AS first_sample_date, min(first_product_order_date) AS first_product_date,
    min(household_first_product_order_date) AS household_product_date, min(email) AS first_email FROM {_housed} WHERE household_email_count > 1
    GROUP BY house, household_email_count ORDER BY household_email_count DESC, first_email LIMIT 100""",
)
register(
    "m03_cohort_conversion", lambda t: u.cohort_conversion(t.sample_conversions, _day(_SINCE)),
    "SELECT cohort_month, count(DISTINCT email) AS cohort_size, "
    + ", ".join(f"{n} AS {k}_converters, {pct(n, 'count(DISTINCT email)')} AS {k}_conversion_rate" for k, n in _cnt.items())
    + f" FROM k19 WHERE cohort_month >= {_SINCE_SQL} GROUP BY cohort_month",
)
register(
    "m04_window_comparison", lambda t: u.window_comparison(t.sample_conversions, _day(_SINCE)),
    f"""SELECT conversion_window_bucket AS email_window, household_conversion_window_bucket AS household_window, hybrid_conversion_window_bucket AS hybrid_window,
    {", ".join(f"{n} AS {k}_converters" for k, n in _cnt.items())} FROM k19 WHERE first_sample_order_date >= {_SINCE_SQL} GROUP BY ALL""",
)
register(
    "m05_household_attribution", lambda t: u.household_attribution(t.sample_conversions).drop("household_id"),
    f"""SELECT *, CASE WHEN sample_email = product_email THEN 'Same Email' ELSE 'Different Emails' END AS multi_email_conversion FROM (
    SELECT household_email_count, string_agg(DISTINCT email, ', ' ORDER BY email) AS emails_in_household, list(email ORDER BY first_sample_order_date, email)[1] AS sample_email,
    list(email ORDER BY household_first_product_order_date, email)[1] AS product_email, min(household_first_sample_order_date) AS household_sample_date,
    min(household_first_product_order_date) AS household_product_date, min(household_days_to_order) AS household_days_to_order, min(email) AS first_email
    FROM {_housed} WHERE household_conversion_ind = 1 AND household_email_count > 1 GROUP BY house, household_email_count
    ORDER BY household_days_to_order NULLS FIRST, first_email LIMIT 100)""",
)
register(
    "m06_address_audit", lambda t: u.address_audit(t.households),
    """SELECT shipping_address_line1 AS raw_address, normalized_address, normalized_zip, count(DISTINCT order_id) AS order_count FROM k12
    GROUP BY ALL ORDER BY order_count DESC, raw_address, normalized_zip LIMIT 100""",
)
register(
    "m07_event_distribution", lambda t: u.event_distribution(t.events),
    "SELECT event_name, count(*) AS event_count, count(DISTINCT user_pseudo_id) AS unique_users FROM k04 GROUP BY ALL",
)
register("m07_page_distribution", lambda t: u.page_distribution(t.events), "SELECT page_type, count(*) AS event_count FROM k04_full GROUP BY ALL")
register(
    "m08_email_profile", lambda t: u.email_profile(t.email_performance),
    f"""SELECT email_type, count(*) AS email_count, {ratio('sum(open_rate::DECIMAL(18,2))', 'count(open_rate)')} AS avg_open_rate,
    {ratio('sum(click_rate::DECIMAL(18,2))', 'count(click_rate)')} AS avg_click_rate, sum(revenue) AS total_revenue FROM k26 GROUP BY ALL""",
    exact=True,
)
register(
    "m08_email_categories", lambda t: u.email_categories(t.email_performance),
    "SELECT email_category, count(*) AS n FROM k26 GROUP BY ALL",
)
register(
    "m09_channel_days", lambda t: u.channel_days(t.ad_performance, _day("2001-10-01")),
    f"""SELECT date_day, channel, sum(spend) AS spend, sum(conversions) AS total_conversions, {ratio('sum(roas::DECIMAL(18,2))', 'count(roas)')} AS avg_roas
    FROM k25 WHERE date_day >= DATE '2001-10-01' GROUP BY ALL""",
    exact=True,
)
register(
    "m10_carrier_scorecard", lambda t: u.carrier_scorecard(t.fct_shipments),
    f"""SELECT carrier, count(*) AS total_shipments, sum(on_time_delivery_count)::BIGINT AS on_time_deliveries, sum(late_delivery_count)::BIGINT AS late_deliveries,
    {pct('sum(on_time_delivery_count)', 'count(*)')} AS on_time_pct FROM k28 GROUP BY ALL""",
)
register(
    "m11_daily_scorecard", lambda t: u.daily_scorecard(t.daily_performance, _day("2001-07-01")),
    """SELECT date_day, store, total_orders, product_orders, sample_orders, total_revenue, new_customers, returning_customers, cac, roas
    FROM k20 WHERE date_day >= DATE '2001-07-01'""",
    exact=True,
)
register(
    "m11_weekly_top_skus", lambda t: u.weekly_top_skus(t.weekly_product_sales, _day("2001-07-18")),
    f"""SELECT week_start_date, sku, line_item_type, total_quantity, total_revenue, order_count, unique_customers, title, store FROM k21
    WHERE week_start_date >= {monday("DATE '2001-07-18'")} ORDER BY week_start_date DESC, total_revenue DESC, sku, title, store LIMIT 20""",
    exact=True,
)
register(
    "m12_economics_by_day", lambda t: u.economics_by_day(t.unit_economics, _day("2001-05-01")),
    f"""SELECT order_date, store, count(*) AS order_count, sum(net_sales) AS net_sales, sum(allocated_ad_spend) AS total_ad_spend,
    sum(contribution_margin_before_cogs) AS contribution_margin_before_cogs, {ratio('sum(contribution_margin_pct::DECIMAL(18,2))', 'count(contribution_margin_pct)')} AS avg_contribution_margin_pct
    FROM k23 WHERE order_date >= DATE '2001-05-01' GROUP BY ALL ORDER BY order_date DESC, store LIMIT 30""",
    exact=True,
)
register(
    "m12_worst_margins", lambda t: u.worst_margins(t.unit_economics),
    """SELECT order_id, email, order_date, net_sales, allocated_ad_spend, contribution_margin_before_cogs, contribution_margin_pct FROM k23
    WHERE contribution_margin_before_cogs < 0 ORDER BY contribution_margin_before_cogs, order_id LIMIT 20""",
    exact=True,
)
register(
    "m13_top_sku_demand", lambda t: u.top_sku_demand(t.demand_features, _day("1998-01-01"), _day("1996-01-01")),
    """SELECT date_day, sku, store, quantity_sold, quantity_sold_lag_7d, quantity_sold_avg_7d, quantity_sold_avg_28d, seasonality_index_28d,
    demand_volatility_cv, is_weekend, is_holiday_week FROM k24 WHERE date_day >= DATE '1996-01-01' AND sku =
    (SELECT sku FROM k24 WHERE date_day >= DATE '1998-01-01' GROUP BY sku ORDER BY sum(quantity_sold) DESC, sku LIMIT 1)""",
)
register(
    "m14_retention_curve", lambda t: u.retention_curve(t.monthly_cohorts, "regular", _day("1996-01-01")),
    f"""SELECT cohort_month, months_since_first_order, cohort_size, active_customers, retention_rate, {ratio('cumulative_ltv', 'cohort_size')} AS cumulative_ltv_per_customer
    FROM k22 WHERE primary_store = 'regular' AND cohort_month >= DATE '1996-01-01' AND months_since_first_order <= 12""",
)
register(
    "m14_funnel_listing", lambda t: u.funnel_listing(t.web_funnel, _day("2024-01-10")),
    """SELECT session_date, deepest_funnel_stage, total_sessions, sessions_reached_homepage, sessions_reached_purchase, overall_conversion_rate,
    homepage_to_plp_rate, pdp_to_cart_rate, checkout_to_purchase_rate FROM k27 WHERE session_date >= DATE '2024-01-10'
    ORDER BY session_date DESC, deepest_funnel_stage LIMIT 30""",
)

# --- N: documented rules ---------------------------------------------------------------------

_words = {
    "street": "st", "avenue": "ave", "drive": "dr", "road": "rd", "lane": "ln", "court": "ct", "circle": "cir", "place": "pl", "apartment": "apt",
    "suite": "ste", "building": "bldg", "north": "n", "south": "s", "east": "e", "west": "w",
}
_short = "normalized_address"
for _w, _s in _words.items():
    _short = f"regexp_replace({_short}, '\\b{_w}\\b', '{_s}', 'g')"
register(
    "n01_address_abbreviations",
    lambda t: c.households(t.orders, abbreviations=True).select("order_id", "store", "normalized_address", "household_key"),
    f"SELECT order_id, store, {_short} AS normalized_address, {_short} || '|' || normalized_zip AS household_key FROM k12",
)
_code = """CASE line_item_type WHEN 'Product' THEN 'lvp-' || list_extract(string_split(sku, '-'), -1)
  WHEN 'Sample' THEN CASE WHEN contains(sku, '7-CUT') THEN 'lvp-7T' ELSE 'lvp-' || nullif(regexp_extract(sku, '[^-]-(B|C|S)-[^-]', 1), '') END END"""
register(
    "n02_product_category",
    lambda t: t.lines.withColumn("code", e.category_code()).select(
        "order_line_id", "sku", "line_item_type", "code", e.product_category("code").alias("category")
    ),
    f"""SELECT order_line_id, sku, line_item_type, {_code} AS code, coalesce(MAP {{'lvp-S': 'Signature', 'lvp-7210': 'Signature', 'lvp-B': 'Base', 'lvp-4805': 'Base',
    'lvp-C': 'Craftsman', 'lvp-7': 'Silvan Hardwood', 'lvp-7T': 'Silvan Hardwood'}}[{_code}], 'Other') AS category FROM k02""",
)
register(
    "n03_sample_cohort_retention", lambda t: e.sample_cohort_retention(t.fct_orders),
    f"""SELECT *, {safe('customer_count', 'first_month_count')} AS count_retention, {safe('sales', 'first_month_sales')} AS sales_retention FROM (
    SELECT *, min_by(customer_count, retention_months) OVER w AS first_month_count, min_by(sales, retention_months) OVER w AS first_month_sales
    FROM (SELECT {month('first_sample_order_date')} AS cohort_month, (datediff('month', first_sample_order_date, order_date) + 1)::INTEGER AS retention_months,
      count(DISTINCT email) AS customer_count, sum(net_sales) AS sales FROM k17 WHERE order_date >= first_sample_order_date GROUP BY ALL)
    WINDOW w AS (PARTITION BY cohort_month))""",
    exact=True,
)
register(
    "n04_color_conversion",
    lambda t: e.color_conversion(t.fct_order_lines).select("order_line_id", "order_id", "email", "color", "color_conversion"),
    f"""SELECT order_line_id, order_id, email, color, {flag("product_quantity > 0 AND processed_at > min(processed_at) FILTER (sample_quantity > 0) OVER (PARTITION BY email, color)")} AS color_conversion
    FROM k18""",
)
register(
    "n05_sample_type_count", lambda t: e.sample_type_counts(t.lines),
    "SELECT order_id, store, count(DISTINCT CASE WHEN sample_quantity > 0 THEN "
    + arms([("regexp_matches(sku, '-S-|-7210-')", "'s'"), ("regexp_matches(sku, '-B-|-4805-')", "'b'"), ("contains(sku, '-C-')", "'c'"),
            ("regexp_matches(sku, '-7-|-7T-')", "'v'")], "'o'")
    + " END) AS sample_type_count FROM k02 GROUP BY ALL",
)
register(
    "n06_price_fields", lambda t: e.price_fields(t.orders).select("order_id", "store", "subtotal_plus_tax", "total_excl_tax"),
    "SELECT order_id, store, subtotal_price + total_tax AS subtotal_plus_tax, total_price - total_tax AS total_excl_tax FROM k01",
    exact=True,
)
register(
    "n07_sampled_after", lambda t: e.sampled_after(t.funnel, _day("1997-12-31")).select("email", "first_sample_order_date"),
    "SELECT email, first_sample_order_date FROM k13 WHERE first_sample_order_date > DATE '1997-12-31'",
)
