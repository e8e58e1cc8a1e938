"""N08: the KPI catalogue, one query per result."""

from __future__ import annotations

from oracle.sql import pct, ratio, sunday
from shoploom.catalog.consumers import _code
from shoploom.catalog.registry import register
from shoploom.plans.metrics import CATALOGUE, kpis


def _rate(flag):
    return pct(f"(count(*) FILTER ({flag} = 1))", "count(*)")


def _of(num, den, times=1):
    return ratio(f"sum({num})", f"sum({den})", times)


def _mean(c):
    return ratio(f"sum({c})", f"count({c})")


_gap = ratio("(sum(days_to_order) FILTER (conversion_ind = 1))", "(count(days_to_order) FILTER (conversion_ind = 1))")
_week = f"{sunday('order_date')} || '|' || sku"
_cat = (
    f"coalesce(MAP {{'lvp-S': 'Signature', 'lvp-7210': 'Signature', 'lvp-B': 'Base', 'lvp-4805': 'Base', 'lvp-C': 'Craftsman', "
    f"'lvp-7': 'Silvan Hardwood', 'lvp-7T': 'Silvan Hardwood'}}[{_code}], 'Other')"
)
_cohort = "cohort_month || '|' || primary_store || '|' || months_since_first_order"
_all, _day, _mail, _sday = "'all'", "date_day::VARCHAR", "email_type", "session_date::VARCHAR"

# result -> (statement, [(kpi, slice, value)])
_SQL = {
    "funnel": ("k13", [
        ("Email Conversion Rate", _all, _rate("conversion_ind")), ("Household Conversion Rate", _all, _rate("household_conversion_ind")),
        ("Hybrid Conversion Rate", _all, _rate("hybrid_conversion_ind")), ("Average Days to Order", _all, _gap),
        ("Multi-Email Household Count", _all, "count(*) FILTER (household_email_count > 1)"),
    ]),
    "sessions": ("k14", [
        ("Session Conversion Rate", _all, _rate("is_converted_session")), ("Deepest Funnel Stage", _all, "max(funnel_stage_depth)"),
        ("Funnel Dropoff Analysis", "deepest_funnel_stage", pct("count(*)", "(SELECT count(*) FROM k14)")),
        ("Transaction Value", _all, "sum(transaction_value::DECIMAL(18,2)) FILTER (is_converted_session = 1)"),
    ]),
    "fct_orders": ("k17", [
        ("Net Revenue", _all, "sum(net_sales)"), ("Product Orders", _all, "count(*) FILTER (order_type = 'Product Order')"),
        ("Sample Orders", _all, "count(*) FILTER (order_type = 'Sample Order')"), ("Average Order Value", _all, ratio("sum(net_sales)", "count(order_id)")),
        ("Lifetime Product Revenue", "email", "sum(product_revenue)"), ("New vs Returning Customer", "customer_status", "count(*)"),
    ]),
    "fct_order_lines": ("k18", [
        ("SKU Revenue", "sku", "sum(line_total)"), ("SKU Units Sold", "sku", "sum(quantity)"),
        ("Sample vs Product Distribution", "line_item_type", "count(*)"), ("Converted Purchases", _all, "sum(is_converted_purchase)"),
        ("Product Category Revenue", _cat, "sum(line_total)"), ("Weekly SKU Revenue", _week, "sum(line_total)"),
        ("Weekly SKU Units Sold", _week, "sum(quantity)"), ("Weekly SKU Customer Count", _week, "count(DISTINCT email)"),
        ("Converted Purchases by SKU", _week, "sum(is_converted_purchase)"),
    ]),
    "dim_customers": ("k16", [
        ("Customer Lifetime Value", "email", "max(lifetime_product_revenue)"), ("Total Customer Lifetime Value", "email", "max(lifetime_total_revenue)"),
        ("Days to Order", "email", "max(days_to_order)"), ("Sample-to-Purchase Conversion", "email", "max(conversion_ind)"),
        ("Customer Value Segment", "customer_segment", "count(*)"), ("Customer Group", "customer_group", "count(*)"),
    ]),
    "sample_conversions": ("k19", [
        ("Email-Based Conversion Rate", _all, _rate("conversion_ind")), ("Household Conversion Rate", _all, _rate("household_conversion_ind")),
        ("Hybrid Conversion Rate", _all, _rate("hybrid_conversion_ind")),
        *[(f"{n}-Day Conversion Rate", _all, _rate(f"converted_within_{n}d")) for n in (15, 30, 60, 120)],
        ("Average Days to Order", _all, _gap), ("Sample Order Type Distribution", "sample_order_type", "count(*)"),
        ("Household Email Count", "email", "max(household_email_count)"),
    ]),
    "daily_performance": ("k20", [
        ("Customer Acquisition Cost", _day, ratio("max(total_ad_spend)", "sum(new_customers)", otherwise="0")),
        ("Return on Ad Spend", _day, ratio("sum(total_revenue)", "max(total_ad_spend)", otherwise="0")),
        ("Daily Revenue", _day, "sum(total_revenue)"), ("Daily Product Revenue", _day, "sum(product_revenue)"),
        ("Daily Total Orders", _day, "sum(total_orders)"), ("Daily Product Orders", _day, "sum(product_orders)"),
        ("New Customers Acquired", _day, "sum(new_customers)"), ("Returning Customers", _day, "sum(returning_customers)"),
    ]),
    "monthly_cohorts": ("k22", [
        ("Cohort Retention Rate", _cohort, "max(retention_rate)"), ("Cumulative Lifetime Value", _cohort, "max(cumulative_ltv)"),
        ("LTV per Customer", _cohort, _of("cumulative_ltv", "cohort_size")), ("Cohort Size", _cohort, "max(cohort_size)"),
    ]),
    "unit_economics": ("k23", [
        ("Contribution Margin (before COGS)", _all, "sum(contribution_margin_before_cogs)"),
        ("Contribution Margin Percentage", _all, _of("contribution_margin_before_cogs", "net_sales", 100)),
        ("Ad Spend Percentage", _all, _of("allocated_ad_spend", "net_sales", 100)), ("Discount Amount", _all, "sum(discount_amount)"),
    ]),
    "ad_performance": ("k25", [
        ("Return on Ad Spend", _day, _of("conversions_value", "spend")), ("Cost per Acquisition", _day, _of("spend", "conversions")),
        ("Ad Spend", _day, "sum(spend)"), ("Ad Conversions", _day, "sum(conversions)"), ("Conversion Value", _day, "sum(conversions_value)"),
    ]),
    "email_performance": ("k26", [
        ("Email Open Rate", _mail, _of("opened", "received", 100)), ("Email Click Rate", _mail, _of("clicked", "received", 100)),
        ("Email Conversion Rate", _mail, _of("converters", "received", 100)), ("Email Revenue", _mail, "sum(revenue)"),
        ("Email Net Revenue", _mail, "sum(net_revenue)"), ("Revenue per Recipient", _mail, _of("revenue", "received")),
    ]),
    "web_funnel": ("k27", [
        ("Overall Conversion Rate", _sday, _of("converted_sessions", "total_sessions", 100)),
        *[(name, _sday, _of(f"sessions_reached_{b}", f"sessions_reached_{a}", 100)) for name, a, b in (
            ("Homepage to PLP Rate", "homepage", "plp"), ("PLP to PDP Rate", "plp", "pdp"), ("PDP to Cart Rate", "pdp", "cart"),
            ("Cart to Checkout Rate", "cart", "checkout"), ("Checkout to Purchase Rate", "checkout", "purchase"))],
        ("Average Order Value", _sday, _of("total_revenue", "converted_sessions")),
    ]),
    "fct_shipments": ("k28", [
        ("On-Time Delivery Rate", _all, _rate("on_time_delivery_count")), ("Late Delivery Rate", _all, _rate("late_delivery_count")),
        ("Shipping Cost per Order", _all, ratio("sum(shipping_cost)", "count(*)")), ("Actual Transit Days", _all, _mean("actual_transit_days")),
        ("Estimated Transit Days", _all, _mean("estimated_transit_days")),
        ("Delivery Issues by Region", "destination_state", "sum(late_delivery_count)"),
    ]),
}

for _model in CATALOGUE:
    _cte, _rows = _SQL[_model]
    register(
        f"n08_kpis_{_model}",
        lambda t, model=_model: kpis(getattr(t, model), model),
        "\nUNION ALL\n".join(
            f"SELECT '{n}' AS kpi, {s} AS slice, CAST({v} AS DOUBLE) AS value FROM {_cte} GROUP BY 1, 2" for n, s, v in _rows
        ),
    )
