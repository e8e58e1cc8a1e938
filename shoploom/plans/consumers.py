"""Consumer queries over the marts. `since` and `days` bound the period; limits are top-k lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.functions import exprs as x

TOP_HOUSEHOLDS, TOP_SKUS, TOP_ORDERS, TOP_DAYS = 100, 20, 20, 30


def _exact(column: str, scale: int = 2) -> Column:
    return F.col(column).cast(f"decimal(18,{scale})")


def _mean(column: str, digits: int = 2) -> Column:
    """Average of a column rounded in turn, from exact sums."""
    return x.rounded_ratio(F.sum(_exact(column)), F.count(column), digits=digits)


def _converted(flag: str) -> Column:
    """One row per customer, so converters are a plain count."""
    return F.count_if(F.col(flag) == 1)


def conversion_lift(conversions: DataFrame, since: Column) -> DataFrame:
    """Email against hybrid conversion rate, and the lift."""
    counted = conversions.filter(F.col("first_sample_order_date") >= since).agg(
        _converted("conversion_ind").alias("email_converters"), F.count("*").alias("total_samplers"),
        _converted("hybrid_conversion_ind").alias("hybrid_converters"),
    )
    return counted.withColumns({
        "email_conversion_rate": x.percent("email_converters", "total_samplers"),
        "hybrid_conversion_rate": x.percent("hybrid_converters", "total_samplers"),
        "conversion_rate_lift": x.percent(F.col("hybrid_converters") - F.col("email_converters"), "total_samplers"),
    })


def _members(df: DataFrame) -> DataFrame:
    """Sorted list of emails per household. One list is one value, so it is built for few households."""
    return df.select("household_id", "email").distinct().groupBy("household_id").agg(
        F.array_join(F.sort_array(F.collect_list("email")), ", ").alias("emails_in_household")
    )


def multi_email_households(conversions: DataFrame, limit: int = TOP_HOUSEHOLDS) -> DataFrame:
    """Households with most emails; the email lists are built for the chosen ones only."""
    shared = conversions.filter(F.col("household_id").isNotNull() & (F.col("household_email_count") > 1))
    top = shared.groupBy("household_id", "household_email_count").agg(
        F.max("conversion_ind").alias("any_email_converted"), F.max("household_conversion_ind").alias("household_converted"),
        F.min("first_sample_order_date").alias("first_sample_date"), F.min("first_product_order_date").alias("first_product_date"),
        F.min("household_first_product_order_date").alias("household_product_date"), F.min("email").alias("first_email"),
    ).orderBy(F.desc("household_email_count"), "first_email").limit(limit)
    return top.join(_members(shared.join(top.select("household_id"), "household_id", "left_semi")), "household_id")


def cohort_conversion(conversions: DataFrame, since: Column) -> DataFrame:
    """Email, household and hybrid conversion rate by cohort month."""
    kinds = {"email": "conversion_ind", "household": "household_conversion_ind", "hybrid": "hybrid_conversion_ind"}
    counted = conversions.filter(F.col("cohort_month") >= since).groupBy("cohort_month").agg(
        F.count("*").alias("cohort_size"), *[_converted(c).alias(f"{k}_converters") for k, c in kinds.items()]
    )
    return counted.withColumns(
        {f"{k}_conversion_rate": x.percent(f"{k}_converters", "cohort_size") for k in kinds}
    ).orderBy("cohort_month")


def window_comparison(conversions: DataFrame, since: Column) -> DataFrame:
    """Customers by their three window buckets, in the order of the email bucket."""
    buckets = ["0-15 days", "16-30 days", "31-60 days", "61-120 days", "120+ days", "No Conversion"]
    return conversions.filter(F.col("first_sample_order_date") >= since).groupBy(
        F.col("conversion_window_bucket").alias("email_window"),
        F.col("household_conversion_window_bucket").alias("household_window"),
        F.col("hybrid_conversion_window_bucket").alias("hybrid_window"),
    ).agg(
        _converted("conversion_ind").alias("email_converters"),
        _converted("household_conversion_ind").alias("household_converters"),
        _converted("hybrid_conversion_ind").alias("hybrid_converters"),
    ).orderBy(x.ladder([(F.col("email_window") == b, i) for i, b in enumerate(buckets)]))


def household_attribution(conversions: DataFrame, limit: int = TOP_HOUSEHOLDS) -> DataFrame:
    """For converted households of several emails: who sampled first and who bought first."""
    shared = conversions.filter(
        F.col("household_id").isNotNull() & (F.col("household_conversion_ind") == 1) & (F.col("household_email_count") > 1)
    )
    top = shared.groupBy("household_id", "household_email_count").agg(
        F.min_by("email", F.struct("first_sample_order_date", "email")).alias("sample_email"),
        F.min_by("email", F.struct("household_first_product_order_date", "email")).alias("product_email"),
        F.min("household_first_sample_order_date").alias("household_sample_date"),
        F.min("household_first_product_order_date").alias("household_product_date"),
        F.min("household_days_to_order").alias("household_days_to_order"), F.min("email").alias("first_email"),
    ).orderBy(F.asc_nulls_first("household_days_to_order"), "first_email").limit(limit)
    same = F.when(F.col("sample_email") == F.col("product_email"), "Same Email").otherwise("Different Emails")
    return top.join(_members(shared.join(top.select("household_id"), "household_id", "left_semi")), "household_id").withColumn(
        "multi_email_conversion", same
    )


def address_audit(households: DataFrame, limit: int = TOP_HOUSEHOLDS) -> DataFrame:
    """Raw and normalised addresses with most orders."""
    return households.groupBy(
        F.col("shipping_address_line1").alias("raw_address"), "normalized_address", "normalized_zip"
    ).agg(F.count_distinct("order_id").alias("order_count")).orderBy(
        F.desc("order_count"), "raw_address", "normalized_zip"
    ).limit(limit)


def event_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("event_name").agg(
        F.count("*").alias("event_count"), F.count_distinct("user_pseudo_id").alias("unique_users")
    ).orderBy(F.desc("event_count"), "event_name")


def page_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("page_type").agg(F.count("*").alias("event_count"))


def email_profile(mail: DataFrame) -> DataFrame:
    return mail.groupBy("email_type").agg(
        F.count("*").alias("email_count"), _mean("open_rate").alias("avg_open_rate"),
        _mean("click_rate").alias("avg_click_rate"), F.sum("revenue").alias("total_revenue"),
    )


def email_categories(mail: DataFrame) -> DataFrame:
    return mail.groupBy("email_category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "email_category")


def channel_days(ads: DataFrame, since: Column) -> DataFrame:
    return ads.filter(F.col("date_day") >= since).groupBy("date_day", "channel").agg(
        F.sum("spend").alias("spend"), F.sum("conversions").alias("total_conversions"), _mean("roas").alias("avg_roas")
    ).orderBy(F.desc("date_day"), "channel")


def carrier_scorecard(shipments: DataFrame) -> DataFrame:
    counted = shipments.groupBy("carrier").agg(
        F.count("*").alias("total_shipments"), F.sum("on_time_delivery_count").alias("on_time_deliveries"),
        F.sum("late_delivery_count").alias("late_deliveries"),
    )
    return counted.withColumn("on_time_pct", x.percent("on_time_deliveries", "total_shipments")).orderBy(
        F.desc("total_shipments"), "carrier"
    )


def daily_scorecard(daily: DataFrame, since: Column) -> DataFrame:
    return daily.filter(F.col("date_day") >= since).select(
        "date_day", "store", "total_orders", "product_orders", "sample_orders", "total_revenue", "new_customers",
        "returning_customers", "cac", "roas",
    ).orderBy(F.desc("date_day"), "store")


def weekly_top_skus(weekly: DataFrame, since: Column, limit: int = TOP_SKUS) -> DataFrame:
    """Best sku rows of the newest weeks; `since` is taken back to its Monday."""
    return weekly.filter(F.col("week_start_date") >= x.iso_week_start(since)).select(
        "week_start_date", "sku", "line_item_type", "total_quantity", "total_revenue", "order_count", "unique_customers", "title", "store"
    ).orderBy(F.desc("week_start_date"), F.desc("total_revenue"), "sku", "title", "store").limit(limit)


def economics_by_day(economics: DataFrame, since: Column, limit: int = TOP_DAYS) -> DataFrame:
    return economics.filter(F.col("order_date") >= since).groupBy("order_date", "store").agg(
        F.count("*").alias("order_count"), F.sum("net_sales").alias("net_sales"),
        F.sum("allocated_ad_spend").alias("total_ad_spend"),
        F.sum("contribution_margin_before_cogs").alias("contribution_margin_before_cogs"),
        _mean("contribution_margin_pct").alias("avg_contribution_margin_pct"),
    ).orderBy(F.desc("order_date"), "store").limit(limit)


def worst_margins(economics: DataFrame, limit: int = TOP_ORDERS) -> DataFrame:
    """Product orders that lose money, worst first."""
    return economics.filter(F.col("contribution_margin_before_cogs") < 0).select(
        "order_id", "email", "order_date", "net_sales", "allocated_ad_spend", "contribution_margin_before_cogs",
        "contribution_margin_pct",
    ).orderBy("contribution_margin_before_cogs", "order_id").limit(limit)


def top_sku_demand(features: DataFrame, rank_since: Column, show_since: Column) -> DataFrame:
    """Recent demand features of the sku sold most since `rank_since`."""
    top = features.filter(F.col("date_day") >= rank_since).groupBy("sku").agg(F.sum("quantity_sold").alias("n")).orderBy(
        F.desc("n"), "sku"
    ).limit(1)
    return features.filter(F.col("date_day") >= show_since).join(F.broadcast(top.select("sku")), "sku").select(
        "date_day", "sku", "store", "quantity_sold", "quantity_sold_lag_7d", "quantity_sold_avg_7d",
        "quantity_sold_avg_28d", "seasonality_index_28d", "demand_volatility_cv", "is_weekend", "is_holiday_week",
    ).orderBy(F.desc("date_day"), "store")


def retention_curve(cohorts: DataFrame, store: str, since: Column, months: int = 12) -> DataFrame:
    return cohorts.filter(
        (F.col("primary_store") == store) & (F.col("cohort_month") >= since) & (F.col("months_since_first_order") <= months)
    ).select(
        "cohort_month", "months_since_first_order", "cohort_size", "active_customers", "retention_rate",
        x.rounded_ratio("cumulative_ltv", "cohort_size").alias("cumulative_ltv_per_customer"),
    ).orderBy("cohort_month", "months_since_first_order")


def funnel_listing(funnel: DataFrame, since: Column, limit: int = TOP_DAYS) -> DataFrame:
    return funnel.filter(F.col("session_date") >= since).select(
        "session_date", "deepest_funnel_stage", "total_sessions", "sessions_reached_homepage", "sessions_reached_purchase",
        "overall_conversion_rate", "homepage_to_plp_rate", "pdp_to_cart_rate", "checkout_to_purchase_rate",
    ).orderBy(F.desc("session_date"), "deepest_funnel_stage").limit(limit)
