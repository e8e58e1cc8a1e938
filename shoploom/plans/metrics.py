"""KPI catalogue: each KPI is one aggregate over a result, overall or per slice.

`kpis(df, model)` gives rows (kpi, slice, value). Rates are ratios of sums. Where the documented
calculation and the models differ, the models are followed: mail rates are over mails received,
and ad spend, which repeats per store, is taken once per day. The shipping share of net sales is
absent: no model links shipping cost to orders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.plans.extensions import category_code, product_category

ALL = "all"


@dataclass(frozen=True)
class Kpi:
    name: str
    value: Callable[[], Column]
    slice: Callable[[], Column] | None = None
    share: bool = False  # value as a percentage of its sum over slices
    distinct: str | None = None  # the column whose distinct values it counts


def _by(*columns: str) -> Callable[[], Column]:
    return lambda: F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _sum(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _max(column: str) -> Callable[[], Column]:
    return lambda: F.max(column)


def _rows() -> Column:
    return F.count("*")


def _share_of_rows(flag: str) -> Callable[[], Column]:
    return lambda: x.percent(F.count_if(F.col(flag) == 1), F.count("*"))


def _rows_where(column: str, value) -> Callable[[], Column]:
    return lambda: F.count_if(F.col(column) == value)


def _ratio(num: str, den: str, times: int = 1) -> Callable[[], Column]:
    return lambda: x.rounded_ratio(F.sum(num), F.sum(den), times=times)


def _mean(column: str) -> Callable[[], Column]:
    return lambda: x.rounded_ratio(F.sum(column), F.count(column))


def _mean_gap() -> Column:
    gap = F.when(F.col("conversion_ind") == 1, F.col("days_to_order"))
    return x.rounded_ratio(F.sum(gap), F.count(gap))


def _money(column: str) -> Callable[[], Column]:
    return lambda: F.sum(F.col(column).cast("decimal(18,2)"))


_DAY, _MAIL, _EMAIL, _SKU = _by("date_day"), _by("email_type"), _by("email"), _by("sku")
_COHORT = _by("cohort_month", "primary_store", "months_since_first_order")
_SESSION_DAY = _by("session_date")


def _sku_week() -> Column:
    return F.concat_ws("|", x.sunday_week_start("order_date").cast("string"), "sku")


def _category() -> Column:
    return product_category(category_code())


CATALOGUE: dict[str, list[Kpi]] = {
    "funnel": [
        Kpi("Email Conversion Rate", _share_of_rows("conversion_ind")),
        Kpi("Household Conversion Rate", _share_of_rows("household_conversion_ind")),
        Kpi("Hybrid Conversion Rate", _share_of_rows("hybrid_conversion_ind")),
        Kpi("Average Days to Order", _mean_gap),
        Kpi("Multi-Email Household Count", lambda: F.count_if(F.col("household_email_count") > 1)),
    ],
    "sessions": [
        Kpi("Session Conversion Rate", _share_of_rows("is_converted_session")),
        Kpi("Deepest Funnel Stage", _max("funnel_stage_depth")),
        Kpi("Funnel Dropoff Analysis", _rows, _by("deepest_funnel_stage"), share=True),
        Kpi("Transaction Value", lambda: F.sum(F.when(F.col("is_converted_session") == 1, F.col("transaction_value").cast("decimal(18,2)")))),
    ],
    "fct_orders": [
        Kpi("Net Revenue", _sum("net_sales")),
        Kpi("Product Orders", _rows_where("order_type", "Product Order")),
        Kpi("Sample Orders", _rows_where("order_type", "Sample Order")),
        Kpi("Average Order Value", lambda: x.rounded_ratio(F.sum("net_sales"), F.count("order_id"))),
        Kpi("Lifetime Product Revenue", _max("lifetime_product_revenue"), _EMAIL),
        Kpi("New vs Returning Customer", _rows, _by("customer_status")),
    ],
    "fct_order_lines": [
        Kpi("SKU Revenue", _sum("line_total"), _SKU),
        Kpi("SKU Units Sold", _sum("quantity"), _SKU),
        Kpi("Sample vs Product Distribution", _rows, _by("line_item_type")),
        Kpi("Converted Purchases", _rows_where("is_converted_purchase", 1)),
        Kpi("Product Category Revenue", _sum("line_total"), _category),
        Kpi("Weekly SKU Revenue", _sum("line_total"), _sku_week),
        Kpi("Weekly SKU Units Sold", _sum("quantity"), _sku_week),
        Kpi("Weekly SKU Customer Count", lambda: F.count_distinct("email"), _sku_week, distinct="email"),
        Kpi("Converted Purchases by SKU", _sum("is_converted_purchase"), _sku_week),
    ],
    "dim_customers": [
        Kpi("Customer Lifetime Value", _max("lifetime_product_revenue"), _EMAIL),
        Kpi("Total Customer Lifetime Value", _max("lifetime_total_revenue"), _EMAIL),
        Kpi("Days to Order", _max("days_to_order"), _EMAIL),
        Kpi("Sample-to-Purchase Conversion", _max("conversion_ind"), _EMAIL),
        Kpi("Customer Value Segment", _rows, _by("customer_segment")),
        Kpi("Customer Group", _rows, _by("customer_group")),
    ],
    "sample_conversions": [
        Kpi("Email-Based Conversion Rate", _share_of_rows("conversion_ind")),
        Kpi("Household Conversion Rate", _share_of_rows("household_conversion_ind")),
        Kpi("Hybrid Conversion Rate", _share_of_rows("hybrid_conversion_ind")),
        *[Kpi(f"{n}-Day Conversion Rate", _share_of_rows(f"converted_within_{n}d")) for n in (15, 30, 60, 120)],
        Kpi("Average Days to Order", _mean_gap),
        Kpi("Sample Order Type Distribution", _rows, _by("sample_order_type")),
        Kpi("Household Email Count", _max("household_email_count"), _EMAIL),
    ],
    "daily_performance": [
        Kpi("Customer Acquisition Cost", lambda: x.rounded_ratio(F.max("total_ad_spend"), F.sum("new_customers"), otherwise=0), _DAY),
        Kpi("Return on Ad Spend", lambda: x.rounded_ratio(F.sum("total_revenue"), F.max("total_ad_spend"), otherwise=0), _DAY),
        Kpi("Daily Revenue", _sum("total_revenue"), _DAY),
        Kpi("Daily Product Revenue", _sum("product_revenue"), _DAY),
        Kpi("Daily Total Orders", _sum("total_orders"), _DAY),
        Kpi("Daily Product Orders", _sum("product_orders"), _DAY),
        Kpi("New Customers Acquired", _sum("new_customers"), _DAY),
        Kpi("Returning Customers", _sum("returning_customers"), _DAY),
    ],
    "monthly_cohorts": [
        Kpi("Cohort Retention Rate", _max("retention_rate"), _COHORT),
        Kpi("Cumulative Lifetime Value", _max("cumulative_ltv"), _COHORT),
        Kpi("LTV per Customer", _ratio("cumulative_ltv", "cohort_size"), _COHORT),
        Kpi("Cohort Size", _max("cohort_size"), _COHORT),
    ],
    "unit_economics": [
        Kpi("Contribution Margin (before COGS)", _sum("contribution_margin_before_cogs")),
        Kpi("Contribution Margin Percentage", _ratio("contribution_margin_before_cogs", "net_sales", 100)),
        Kpi("Ad Spend Percentage", _ratio("allocated_ad_spend", "net_sales", 100)),
        Kpi("Discount Amount", _sum("discount_amount")),
    ],
    "ad_performance": [
        Kpi("Return on Ad Spend", _ratio("conversions_value", "spend"), _DAY),
        Kpi("Cost per Acquisition", _ratio("spend", "conversions"), _DAY),
        Kpi("Ad Spend", _sum("spend"), _DAY),
        Kpi("Ad Conversions", _sum("conversions"), _DAY),
        Kpi("Conversion Value", _sum("conversions_value"), _DAY),
    ],
    "email_performance": [
        Kpi("Email Open Rate", _ratio("opened", "received", 100), _MAIL),
        Kpi("Email Click Rate", _ratio("clicked", "received", 100), _MAIL),
        Kpi("Email Conversion Rate", _ratio("converters", "received", 100), _MAIL),
        Kpi("Email Revenue", _sum("revenue"), _MAIL),
        Kpi("Email Net Revenue", _sum("net_revenue"), _MAIL),
        Kpi("Revenue per Recipient", _ratio("revenue", "received"), _MAIL),
    ],
    "web_funnel": [
        Kpi("Overall Conversion Rate", _ratio("converted_sessions", "total_sessions", 100), _SESSION_DAY),
        *[
            Kpi(name, _ratio(f"sessions_reached_{b}", f"sessions_reached_{a}", 100), _SESSION_DAY)
            for name, a, b in (
                ("Homepage to PLP Rate", "homepage", "plp"), ("PLP to PDP Rate", "plp", "pdp"), ("PDP to Cart Rate", "pdp", "cart"),
                ("Cart to Checkout Rate", "cart", "checkout"), ("Checkout to Purchase Rate", "checkout", "purchase"),
            )
        ],
        Kpi("Average Order Value", _ratio("total_revenue", "converted_sessions"), _SESSION_DAY),
    ],
    "fct_shipments": [
        Kpi("On-Time Delivery Rate", _share_of_rows("on_time_delivery_count")),
        Kpi("Late Delivery Rate", _share_of_rows("late_delivery_count")),
        Kpi("Shipping Cost per Order", lambda: x.rounded_ratio(F.sum("shipping_cost"), F.count("*"))),
        Kpi("Actual Transit Days", _mean("actual_transit_days")),
        Kpi("Estimated Transit Days", _mean("estimated_transit_days")),
        Kpi("Delivery Issues by Region", _sum("late_delivery_count"), _by("destination_state")),
    ],
}


def _in_one_pass(df: DataFrame, by_slice: dict[object, list[Kpi]]) -> DataFrame:
    """KPIs of several slices: a row goes to its group in each, so that the result is made and read once.

    Most slices have few groups, to which tasks bring their rows down before they are shuffled. A column whose distinct
    values are counted is kept for that slice only, as it would part the groups of the others.
    """
    keys = [F.lit(ALL) if key is None else key() for key in by_slice]
    groups = [F.struct(F.lit(i).alias("part"), key.alias("slice")) for i, key in enumerate(keys)]
    rows = df.withColumn("_group", F.explode(F.array(*groups))).withColumns({"part": F.col("_group.part"), "slice": F.col("_group.slice")})
    part = F.col("part")
    for column in {k.distinct for group in by_slice.values() for k in group if k.distinct}:
        counted = [i for i, group in enumerate(by_slice.values()) if any(k.distinct == column for k in group)]
        rows = rows.withColumn(column, F.when(part.isin(counted), F.col(column)))
    values = rows.groupBy("part", "slice").agg(*[
        F.when(part == i, k.value().cast("double")).alias(k.name) for i, group in enumerate(by_slice.values()) for k in group
    ])
    own = x.ladder([
        (part == i, F.array(*[F.struct(F.lit(k.name).alias("kpi"), F.col(f"`{k.name}`").alias("value")) for k in group]))
        for i, group in enumerate(by_slice.values())
    ])
    return values.select("slice", F.explode(own).alias("_kpi")).select("_kpi.kpi", "slice", "_kpi.value")


def kpis(df: DataFrame, model: str, wanted: list[str] | None = None) -> DataFrame:
    """Rows (kpi, slice, value) of a result's KPIs; those with the same slice share one aggregation, and slices one pass."""
    by_slice: dict[object, list[Kpi]] = {}
    for kpi in CATALOGUE[model]:
        if wanted is None or kpi.name in wanted:
            by_slice.setdefault(kpi.slice, []).append(kpi)
    parts = []
    plain = {key: group for key, group in by_slice.items() if not any(k.share for k in group)}
    if len(plain) > 1:
        parts.append(_in_one_pass(df, plain))
        by_slice = {key: group for key, group in by_slice.items() if key not in plain}
    for key, group in by_slice.items():
        sliced = df.withColumn("slice", F.lit(ALL) if key is None else key())
        values = sliced.groupBy("slice").agg(*[k.value().cast("double").alias(k.name) for k in group])
        part = values.unpivot(["slice"], [k.name for k in group], "kpi", "value")
        shared = [k.name for k in group if k.share]
        if shared:
            total = part.groupBy("kpi").agg(F.sum("value").alias("_total"))
            share = x.percent("value", "_total")
            part = part.join(total, "kpi").withColumn(
                "value", F.when(F.col("kpi").isin(*shared), share).otherwise(F.col("value"))
            ).drop("_total")
        parts.append(part.select("kpi", "slice", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
