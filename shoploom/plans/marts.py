"""Marts built on the order, line and customer facts, and on ads, mail, web and freight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.functions import rules
from shoploom.operators.ranges import Ranged
from shoploom.operators.relational import stack, zero_fill


def calendar_parts(day: str, prefix: str = "", week: str = "week_start_date", month: str = "month_start_date") -> dict[str, Column]:
    """Year, month, quarter, Sunday week start and month start of a date column."""
    return {
        f"{prefix}year": F.year(day), f"{prefix}month": F.month(day), f"{prefix}quarter": F.quarter(day),
        f"{prefix}{week}": x.sunday_week_start(day), f"{prefix}{month}": x.month_start(day),
    }


# --- sample conversions -------------------------------------------------------


def _picked(kind: str) -> list[Column]:
    """Attributes of the first sample or product order, picked while grouping."""
    columns = {
        "order_id": "order_id", "store": "store", "salesperson": "salesperson", "quantity": f"{kind}_quantity",
        "revenue": f"{kind}_revenue", "shipping_state": "shipping_state", "shipping_state_code": "shipping_state_code",
    }
    chosen = F.col(f"is_first_{kind}_order") == 1
    return [F.max(F.when(chosen, F.col(c))).alias(f"first_{kind}_{out}") for out, c in columns.items()]


def sample_conversions(
    funnel: DataFrame, customers: DataFrame, orders: DataFrame,
    windows: Sequence[int] = rules.CONVERSION_WINDOWS, revenue_window: int = rules.REVENUE_WINDOW,
) -> DataFrame:
    """Customers who sampled: first orders, product orders and revenue per window, window buckets.

    The order fact already carries the customer's first sample date, so one pass per
    (email, order id) and one per email give everything that depends on orders.
    """
    gap = F.datediff("order_date", "first_sample_order_date")
    follows = (F.col("is_product_order") == 1) & F.col("first_sample_order_date").isNotNull()
    near = F.when(follows & (gap <= revenue_window), F.col("product_revenue")).otherwise(0)
    relevant = orders.filter(
        follows | (F.col("is_first_sample_order") == 1) | (F.col("is_first_product_order") == 1)
    )
    names = [f"first_{k}_{c}" for k in ("sample", "product") for c in
             ("order_id", "store", "salesperson", "quantity", "revenue", "shipping_state", "shipping_state_code")]
    per_order = relevant.groupBy("email", F.col("order_id").alias("_order")).agg(
        *_picked("sample"), *_picked("product"),
        F.min(F.when(follows, gap)).alias("_gap"), F.sum(near).alias("_near"),
    )
    per_email = per_order.groupBy("email").agg(
        *[F.max(n).alias(n) for n in names],
        *[F.count_if(F.col("_gap") <= n).alias(f"product_orders_within_{n}d") for n in windows],
        F.sum("_near").alias(f"product_revenue_within_{revenue_window}d"),
    )
    counted = [*[f"product_orders_within_{n}d" for n in windows], f"product_revenue_within_{revenue_window}d"]
    attributes = customers.select(
        "email", "customer_group", "customer_type", "primary_shipping_state", "primary_store", "lifetime_product_orders",
        "lifetime_sample_orders", "lifetime_product_revenue", "lifetime_sample_revenue", "lifetime_total_revenue",
        "customer_segment",
    )
    dropped = [c for c in funnel.columns if c.endswith("_timestamp") or c.endswith("has_ever_purchased_product")]
    samplers = funnel.filter(F.col("first_sample_order_date").isNotNull()).drop(*dropped)
    joined = zero_fill(samplers.join(attributes, "email").join(per_email, "email", "left"), counted)

    def window_bucket(days):
        return x.bucket(days, rules.CONVERSION_BUCKETS, rules.BUCKET_ABOVE, rules.BUCKET_NONE)

    earliest = F.least(*[F.coalesce(F.col(c), F.lit(rules.NO_GAP)) for c in ("days_to_order", "household_days_to_order")])
    hybrid = F.when(F.col("hybrid_conversion_ind") != 0, earliest)
    ratio = F.when(
        F.col("first_product_revenue").isNotNull(), x.plain_ratio("first_product_revenue", "first_sample_revenue")
    )
    return joined.withColumns({
        "sample_to_product_revenue_ratio": ratio,
        "conversion_window_bucket": window_bucket("days_to_order"),
        "household_conversion_window_bucket": window_bucket("household_days_to_order"),
        "hybrid_conversion_window_bucket": window_bucket(hybrid),
    })


# --- daily, weekly, monthly ---------------------------------------------------


def daily_performance(orders: DataFrame, ads: DataFrame) -> DataFrame:
    """Day and store: orders, customers, revenue, ad spend and ratios.

    Customers are counted from one row per day, store and customer, which spares the row
    expansion of several distinct counts. Ad totals repeat for each store of a day.
    """
    is_product, is_sample = F.col("is_product_order") == 1, F.col("is_sample_order") == 1
    net = F.col("net_sales")
    sums = {
        "product_orders": F.col("is_product_order"), "sample_orders": F.col("is_sample_order"),
        "accessory_orders": F.col("is_accessory_only"), "total_revenue": net,
        "product_revenue": F.when(is_product, net).otherwise(0), "sample_revenue": F.when(is_sample, net).otherwise(0),
        "total_discounts": F.col("total_discounts"), "total_product_quantity": F.col("product_quantity"),
        "total_sample_quantity": F.col("sample_quantity"), "total_accessories_quantity": F.col("accessories_quantity"),
        "_product_net": F.when(is_product, net), "_product_n": F.when(is_product & net.isNotNull(), 1),
    }
    day = F.col("order_date").alias("date_day")
    per_customer = orders.groupBy(day, "store", "email").agg(
        F.count("*").alias("total_orders"), *[F.sum(c).alias(n) for n, c in sums.items()], F.count("net_sales").alias("_net_n"),
        F.max("is_new_customer").alias("_new"), F.max("is_returning_customer").alias("_returning"),
    )
    known = F.col("email").isNotNull()
    by_day = per_customer.groupBy("date_day", "store").agg(
        F.sum("total_orders").alias("total_orders"), *[F.sum(n).alias(n) for n in sums], F.sum("_net_n").alias("_net_n"),
        F.count("email").alias("total_customers"),
        F.count_if(known & (F.col("_new") == 1)).alias("new_customers"),
        F.count_if(known & (F.col("_returning") == 1)).alias("returning_customers"),
    ).withColumns({
        "average_order_value": x.plain_ratio("total_revenue", "_net_n"),
        "average_product_order_value": x.plain_ratio("_product_net", "_product_n"),
    }).drop("_product_net", "_product_n", "_net_n")
    spend = F.col("spend")
    by_ad_day = ads.groupBy("date_day").agg(
        F.sum(spend).alias("total_ad_spend"),
        F.sum(F.when(F.col("channel") == "Facebook", spend).otherwise(0)).alias("facebook_spend"),
        F.sum(F.when(F.col("channel") == "Google", spend).otherwise(0)).alias("google_spend"),
        F.sum("conversions").alias("total_ad_conversions"), F.sum("conversions_value").alias("total_ad_conversion_value"),
        F.sum("clicks").alias("total_ad_clicks"), F.sum("impressions").alias("total_ad_impressions"),
    )
    ad_columns = [c for c in by_ad_day.columns if c != "date_day"]
    return zero_fill(by_day.join(by_ad_day, "date_day", "left"), ad_columns).withColumns({
        **calendar_parts("date_day"),
        "day_of_week": F.dayofweek("date_day"), "day_name": F.date_format("date_day", "EEEE"),
        "cac": x.rounded_ratio("total_ad_spend", "new_customers", otherwise=0),
        "roas": x.rounded_ratio("total_revenue", "total_ad_spend", otherwise=0),
        "product_order_rate": x.percent("product_orders", "total_orders", otherwise=0),
        "new_customer_rate": x.percent("new_customers", "total_customers", otherwise=0),
        "contribution_margin_excl_cogs": F.col("total_revenue") - F.col("total_ad_spend"),
    })


def weekly_product_sales(lines: DataFrame, layout: Sequence[str] = ()) -> DataFrame:
    """Sunday week, sku, title, color, type and store: volume, revenue, customers, conversions.

    A line belongs to one order and an order to one customer, so the five distinct counts are
    nested: the first row of each line and order is marked inside the order, where the join to orders leaves its lines;
    then one shuffle by group, of rows without their ids, lets customers be counted inside their group.

    `layout` names columns of the group in whose order rows are dealt to ranges at that shuffle, for a table
    clustered by them.
    """
    group = ["week_start_date", "sku", "title", "color", "line_item_type", "store"]
    sums = {
        "total_quantity": "quantity", "total_revenue": "line_total", "total_discount": "total_discount",
        "converted_purchases": "is_converted_purchase", "_price": "price", "_days": "days_from_sample_to_purchase",
    }
    counts = {"_price_n": "price", "_days_n": "days_from_sample_to_purchase"}
    # Lines joined by sorting and merging lie so already: then this is no shuffle.
    weekly = lines.withColumn("week_start_date", x.sunday_week_start("order_date")).repartition("order_id", "store")
    order = ["order_id", "store"]
    inside = W.partitionBy(*order, *[c for c in group if c not in order], "email").orderBy("order_line_id")
    line, order_id = F.col("order_line_id"), F.col("order_id")
    rows = weekly.select(
        *group, "email", *sums.values(), "is_new_customer", "is_returning_customer",
        x.flag(line.isNotNull() & ~line.eqNullSafe(F.lag(line).over(inside))).alias("line_item_count"),
        x.flag(order_id.isNotNull() & (F.row_number().over(inside) == 1)).alias("order_count"),
    )
    if layout:
        dealt = rows.repartitionByRange(*layout, *[c for c in group if c not in layout])
    else:
        dealt = rows.repartition(*group)
    per_customer = dealt.groupBy(*group, "email").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()], *[F.count(c).alias(n) for n, c in counts.items()],
        F.max("is_new_customer").alias("_new"), F.max("is_returning_customer").alias("_returning"),
        F.sum("line_item_count").alias("line_item_count"), F.sum("order_count").alias("order_count"),
    )
    carried = [F.sum(n).alias(n) for n in (*sums, *counts)]
    known = F.col("email").isNotNull()
    out = per_customer.groupBy(*group).agg(
        F.sum("order_count").alias("order_count"), F.sum("line_item_count").alias("line_item_count"), *carried,
        F.count("email").alias("unique_customers"), F.count_if(known & (F.col("_new") == 1)).alias("new_customers"),
        F.count_if(known & (F.col("_returning") == 1)).alias("returning_customers"),
    )
    parts = calendar_parts("week_start_date")
    return out.withColumns({
        "average_price": x.plain_ratio("_price", "_price_n"), "avg_days_from_sample": x.plain_ratio("_days", "_days_n"),
        **{c: parts[c] for c in ("year", "month", "quarter", "month_start_date")},
        "revenue_per_order": x.rounded_ratio("total_revenue", "order_count", otherwise=0),
        "revenue_per_customer": x.rounded_ratio("total_revenue", "unique_customers", otherwise=0),
        "revenue_per_unit": x.rounded_ratio("total_revenue", "total_quantity", otherwise=0),
        "discount_rate": x.percent("total_discount", "total_revenue", otherwise=0),
        "conversion_rate": x.percent("converted_purchases", "line_item_count", otherwise=0),
    }).drop("_price", "_price_n", "_days", "_days_n")


def monthly_cohorts(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Cohorts by month of the first product order and usual store: retention, revenue and cumulative value.

    Months without activity give no row. `customers` holds one row per email.
    """
    buyers = customers.filter(F.col("first_product_order_date").isNotNull()).select(
        "email", x.month_start("first_product_order_date").alias("cohort_month"), "primary_store"
    )
    cohort = ["cohort_month", "primary_store"]
    sizes = buyers.groupBy(*cohort).agg(F.count("*").alias("cohort_size"))
    activity = (
        orders.filter(F.col("order_type") == "Product Order")
        .groupBy("email", x.month_start("order_date").alias("order_month"))
        .agg(F.count_distinct("order_id").alias("orders"), F.sum("net_sales").alias("revenue"))
    )
    monthly = (
        buyers.join(activity, "email")
        .groupBy(*cohort, x.month_gap("order_month", "cohort_month").alias("months_since_first_order"))
        .agg(F.count("*").alias("active_customers"), F.sum("orders").alias("total_orders"), F.sum("revenue").alias("_revenue"))
    )
    so_far = W.partitionBy(*cohort).orderBy("months_since_first_order").rowsBetween(W.unboundedPreceding, W.currentRow)
    return monthly.join(sizes, cohort).withColumns({
        "retention_rate": x.percent("active_customers", "cohort_size", otherwise=0),
        "cohort_revenue": F.round("_revenue", 2),
        "avg_revenue_per_active_customer": x.rounded_ratio("_revenue", "active_customers", otherwise=0),
        "avg_revenue_per_cohort_customer": x.rounded_ratio("_revenue", "cohort_size", otherwise=0),
        "cumulative_ltv": F.sum("_revenue").over(so_far),
        "calendar_month": F.add_months("cohort_month", F.col("months_since_first_order")),
    }).drop("_revenue")


def unit_economics(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """Product orders with allocated ad spend and margin. Net sales here are subtotal minus discounts."""
    base = orders.filter(F.col("order_type") == "Product Order").select(
        "order_id", "email", "order_date", "store", "order_type", "customer_status", "salesperson", "shipping_state",
        "shipping_address_country", F.col("subtotal_price").alias("gross_revenue"),
        F.col("total_discounts").alias("discount_amount"),
        (F.col("subtotal_price") - F.col("total_discounts")).alias("net_sales"), "lifetime_product_revenue",
    )
    spend = daily.filter(F.col("new_customers") > 0).select(
        F.col("date_day").alias("order_date"), "store", "total_ad_spend", "new_customers"
    )
    is_new = F.col("customer_status").isin("New Customer", "New Customer Sample") & (F.col("new_customers") > 0)
    share = F.round(F.col("total_ad_spend").cast("decimal(20,6)") / F.col("new_customers").cast("decimal(20,6)"), 2)
    allocated = F.when(is_new, share).otherwise(0).cast("decimal(20,2)")
    out = base.join(spend, ["order_date", "store"], "left").withColumn("allocated_ad_spend", allocated)
    margin = F.col("net_sales") - F.col("allocated_ad_spend")
    return out.withColumns({
        "discount_rate_pct": x.percent("discount_amount", "gross_revenue", otherwise=0),
        "contribution_margin_before_cogs": F.round(margin, 2),
        "contribution_margin_pct": x.percent(margin, "net_sales", otherwise=0),
        "ad_spend_pct": x.percent("allocated_ad_spend", "net_sales", otherwise=0),
        **{c: F.round(c, 2) for c in ("gross_revenue", "discount_amount", "net_sales", "lifetime_product_revenue")},
    }).drop("total_ad_spend", "new_customers")


# --- demand features ------------------------------------------------------------


def holiday_name(day: str) -> Column:
    month, number, weekday = F.month(day), F.dayofmonth(day), F.dayofweek(day)
    arms = []
    for m, first, last, wanted, name in rules.HOLIDAYS:
        hit = (month == m) & number.between(first, last)
        arms.append((hit if wanted is None else hit & (weekday == wanted), name))
    return x.ladder(arms)


def demand_features(lines: DataFrame, daily: DataFrame) -> DataFrame:
    """Day, store and sku of product lines in product orders: sales, calendar, lags, rolling statistics, ad context.

    Lags and frames count rows present, not calendar days. The line fact carries the order's
    date, customer and type, so orders are not joined again. A series may hold a large part of all rows: it is dealt to
    ranges of days, which see the 89 rows before them.
    """
    group = [F.col("order_date").alias("date_day"), "store", "sku", "line_item_type", "color"]
    keys = ["date_day", "store", "sku", "line_item_type", "color"]
    wanted = (
        (F.col("line_item_type") == rules.PRODUCT) & (F.col("order_type") == "Product Order") & F.col("sku").isNotNull()
    )
    # One shuffle by (series, day, customer): orders, then customers, are counted inside it.
    per_order = lines.filter(wanted).select(*group, "email", "order_id", "quantity", "line_total", "price").repartition(
        *keys, "email"
    ).groupBy(*keys, "email", "order_id").agg(
        F.sum("quantity").alias("quantity_sold"), F.sum("line_total").alias("revenue"), F.sum("price").alias("_price"),
        F.count("price").alias("_price_n"),
    )
    sums = [F.sum(c).alias(c) for c in ("quantity_sold", "revenue", "_price", "_price_n")]
    per_email = per_order.groupBy(*keys, "email").agg(*sums, F.count("*").alias("order_count"))
    sales = per_email.groupBy(*keys).agg(
        *sums, F.sum("order_count").alias("order_count"), F.count("email").alias("unique_customers")
    ).withColumn("avg_unit_price", x.plain_ratio("_price", "_price_n")).drop("_price", "_price_n")

    day = "date_day"
    number, month = F.dayofmonth(day), F.month(day)
    span_month, span_first, span_last = rules.HOLIDAY_WEEK_SPAN
    dated = sales.withColumns({
        "day_of_week": F.dayofweek(day), "day_of_month": number, "week_of_year": x.sunday_week_number(day),
        "month_of_year": month, "quarter_of_year": F.quarter(day), "year": F.year(day), "day_of_year": F.dayofyear(day),
        "is_weekend": x.flag(F.dayofweek(day).isin(1, 7)), "is_month_start": x.flag(number == 1),
        "is_month_end": x.flag(F.col(day) == F.last_day(day)), "holiday_name": holiday_name(day),
        "is_holiday_week": x.flag(
            month.isin(*rules.HOLIDAY_WEEK_MONTHS)
            & (number.isin(*rules.HOLIDAY_WEEK_DAYS) | ((month == span_month) & number.between(span_first, span_last)))
        ),
    })
    sold = "quantity_sold"
    ranged = Ranged(dated, ["store", "sku"], [day, "line_item_type", "color"])
    first_sales = ranged.rows.groupBy("store", "sku").agg(F.min(day).alias("_first_sale"))

    def rolling(series: WindowSpec) -> dict[str, Column]:
        last_28 = series.rowsBetween(-27, 0)
        return {
            **{f"{sold}_lag_{n}d": F.lag(sold, n).over(series) for n in (7, 14, 28)},
            **{f"{sold}_avg_{n}d": F.avg(sold).over(series.rowsBetween(1 - n, 0)) for n in (7, 28, 90)},
            f"{sold}_stddev_28d": F.stddev_samp(sold).over(last_28),
            # Exact total and row count of the 28 rows, so that the index rounds ties as decimals.
            "_total": F.sum(sold).over(last_28), "_rows": F.count(sold).over(last_28),
            "days_since_first_sale": F.datediff(day, "_first_sale"), "days_since_last_sale": F.datediff(day, F.lag(day).over(series)),
        }

    lagged = ranged.framed(89, rolling, beside=first_sales).drop("_first_sale")
    context = daily.select(
        "date_day", "store", F.col("total_ad_spend").alias("daily_ad_spend"), F.col("new_customers").alias("daily_new_customers")
    )
    joined = zero_fill(lagged.join(context, ["date_day", "store"], "left"), ["daily_ad_spend", "daily_new_customers"])
    lag7, average, deviation = F.col(f"{sold}_lag_7d"), F.col(f"{sold}_avg_28d"), F.col(f"{sold}_stddev_28d")
    return joined.withColumns({
        "quantity_change_pct_7d": x.percent(F.col(sold) - lag7, lag7),
        "seasonality_index_28d": x.rounded_ratio(F.col(sold) * F.col("_rows"), "_total"),
        "demand_volatility_cv": F.when(average > 0, F.round(deviation / average, 2)),
    }).drop("_total", "_rows")


# --- ads, mail, web, freight -----------------------------------------------------


def ad_performance(social: DataFrame, search: DataFrame) -> DataFrame:
    """Both ad channels, harmonised; search has no ad set or ad."""
    shared = [
        "date_day", "channel", "campaign_id", "campaign_name", "clicks", "impressions", "spend", "conversions",
        "conversions_value", "ctr", "cpc", "roas", "cpa",
    ]
    both = stack(social.select(*shared, "ad_set_name", "ad_name"), search.select(*shared))
    return both.withColumns({
        **calendar_parts("date_day"),
        "revenue_per_conversion": x.plain_ratio("conversions_value", "conversions", 0),
        "click_conversion_rate": x.plain_ratio("conversions", "clicks", 0),
    })


def email_performance(campaigns: DataFrame, flows: DataFrame) -> DataFrame:
    """Campaigns and flows in one table; flows have no send date, subject or sender."""
    shared = [
        "recipients", "received", "opened", "clicked", "converters", "orders", "revenue", "net_revenue", "open_rate",
        "click_rate", "click_to_open_rate", "conversion_rate", "revenue_per_converter", "revenue_per_recipient",
        "average_order_value", "unsubscribed", "unsubscribe_rate", "bounced", "bounce_rate", "marked_spam", "channel",
    ]

    def named(df, kind, prefix, *more):
        return df.select(
            F.col(f"{prefix}_id").alias("email_id"), F.lit(kind).alias("email_type"),
            F.col(f"{prefix}_name").alias("email_name"), F.col(f"{prefix}_category").alias("email_category"), *more, *shared,
        )

    sent = F.to_date("sent_at").alias("sent_date")
    both = stack(
        named(campaigns, "Campaign", "campaign", "sent_at", sent, "subject", "from_email", "from_name"),
        named(flows, "Flow", "flow"),
    )
    return both.withColumns(calendar_parts("sent_date", "sent_"))


def session_funnel(events: DataFrame, stages=rules.FUNNEL_STAGES) -> DataFrame:
    """One row per web session: stages reached, counts, purchase, duration, deepest stage, drop-offs."""
    def on_page(kind):
        return F.col("page_type") == kind

    pages = {"homepage": "homepage", "plp": "product_list", "pdp": "product_detail"}
    steps = ("add_to_cart", "begin_checkout", "purchase")
    bought = F.col("is_purchase") == 1
    sessions = (
        events.filter(F.col("user_pseudo_id").isNotNull() & F.col("ga_session_id").isNotNull())
        .groupBy("user_pseudo_id", "ga_session_id")
        .agg(
            F.min("event_timestamp_pt").alias("session_start_time"), F.max("event_timestamp_pt").alias("session_end_time"),
            *[F.max(x.flag(on_page(kind))).alias(f"reached_{n}") for n, kind in pages.items()],
            *[F.max(f"is_{s}").alias(f"reached_{s}") for s in steps],
            *[F.count_if(on_page(kind)).alias(f"{n}_views") for n, kind in pages.items()],
            *[F.sum(f"is_{s}").alias(f"{s}_events") for s in steps],
            F.max(F.when(bought, F.col("transaction_id"))).alias("transaction_id"),
            F.max(F.when(bought, F.col("transaction_value"))).alias("transaction_value"),
            F.count("*").alias("total_events"), F.count_distinct("event_name").alias("unique_event_types"),
        )
    )

    def reached(stage):
        return F.col(f"reached_{stage}") == 1

    path = (("homepage", "plp", "homepage"), ("plp", "pdp", "plp"), ("pdp", "add_to_cart", "pdp"),
            ("add_to_cart", "begin_checkout", "cart"), ("begin_checkout", "purchase", "checkout"))
    return sessions.withColumns({
        "session_duration_minutes": x.minutes_elapsed("session_end_time", "session_start_time"),
        "deepest_funnel_stage": x.ladder([(F.col(c) == 1, label) for c, label, _ in stages], "Other"),
        "funnel_stage_depth": x.ladder([(F.col(c) == 1, depth) for c, _, depth in stages], 0),
        "is_converted_session": x.flag(reached("purchase")),
        **{f"dropped_at_{name}": x.flag(reached(here) & ~reached(onward)) for here, onward, name in path},
        "session_date": F.to_date("session_start_time"),
    })


def web_funnel(sessions: DataFrame) -> DataFrame:
    """Day and deepest stage: sessions reaching and leaving each stage, step and drop-off rates, value, engagement."""
    reach = {"homepage": "homepage", "plp": "plp", "pdp": "pdp", "add_to_cart": "cart",
             "begin_checkout": "checkout", "purchase": "purchase"}
    drops = ("homepage", "plp", "pdp", "cart", "checkout")
    daily = sessions.groupBy("session_date", "deepest_funnel_stage", "funnel_stage_depth").agg(
        F.count("*").alias("total_sessions"), F.count_distinct("user_pseudo_id").alias("unique_users"),
        *[F.sum(f"reached_{c}").alias(f"sessions_reached_{out}") for c, out in reach.items()],
        *[F.sum(f"dropped_at_{d}").alias(f"sessions_dropped_at_{d}") for d in drops],
        F.sum("is_converted_session").alias("converted_sessions"),
        F.sum(F.col("transaction_value").cast("decimal(24,6)")).alias("_value"),
        *[F.sum(c).alias(f"_{c}") for c in ("session_duration_minutes", "total_events", "pdp_views")],
    )
    order = list(reach.values())
    steps = list(zip(order, order[1:]))
    return daily.withColumns({
        **{f"{a}_to_{b}_rate": x.percent(f"sessions_reached_{b}", f"sessions_reached_{a}", otherwise=0) for a, b in steps},
        "overall_conversion_rate": x.percent("converted_sessions", "total_sessions", otherwise=0),
        **{f"{d}_dropoff_rate": x.percent(f"sessions_dropped_at_{d}", f"sessions_reached_{d}", otherwise=0) for d in drops},
        "total_revenue": F.round("_value", 2).cast("decimal(18,2)"),
        "avg_order_value": x.rounded_ratio("_value", "converted_sessions", otherwise=0),
        "avg_session_duration_minutes": x.rounded_ratio("_session_duration_minutes", "total_sessions"),
        "avg_events_per_session": x.rounded_ratio("_total_events", "total_sessions"),
        "avg_pdp_views_per_session": x.rounded_ratio("_pdp_views", "total_sessions"),
    }).drop("_value", "_session_duration_minutes", "_total_events", "_pdp_views")


def fct_shipments(shipments: DataFrame) -> DataFrame:
    """Shipments with pickup calendar parts and 0/1 flags; an unknown outcome is 0 in both flags."""
    return shipments.withColumns({
        **calendar_parts("pickup_date", "pickup_"),
        "on_time_delivery_count": x.flag(F.col("is_on_time")), "late_delivery_count": x.flag(~F.col("is_on_time")),
        "over_budget_count": x.flag(F.col("cost_variance") > 0), "under_budget_count": x.flag(F.col("cost_variance") < 0),
    })
