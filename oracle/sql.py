"""Small builders for the check SQL."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

# Exact (decimal) columns, compared as DOUBLE.
EXACT = """
subtotal_price total_price total_discounts total_tax total_tip_received refund_subtotal refund_total_tax
order_adjustment_amount order_adjusted_total price line_total line_total_gross total_discount sample_revenue
product_revenue accessories_revenue total_line_items_revenue net_sales lifetime_product_revenue
lifetime_sample_revenue lifetime_total_revenue lifetime_total_spent lifetime_total_refunded lifetime_total_net
lifetime_total_tax lifetime_total_discount avg_order_value avg_tax_per_order shopify_lifetime_spent
shopify_lifetime_refunded shopify_avg_order_value spend conversions_value revenue net_revenue checkout_started_value
refunded_revenue cancelled_revenue quoted_rate invoiced_amount shipping_cost cost_variance first_sample_revenue
first_product_revenue product_revenue_within_60d total_revenue total_ad_spend facebook_spend google_spend
total_ad_conversion_value contribution_margin_excl_cogs cohort_revenue cumulative_ltv gross_revenue discount_amount
allocated_ad_spend contribution_margin_before_cogs daily_ad_spend channel_net_sales total_net_sales
prev_week_channel_sales prev_week_net_sales prior_year_net_sales prev_week_revenue wow_change_dollars t6w_revenue
net_dollars prev_week_net_dollars wow_delta_dollars t6w_net_dollars p6w_net_dollars t6w_delta_dollars
subtotal_plus_tax total_excl_tax sales first_month_sales
""".split()


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def needed(sql: str, seen: list[str]) -> list[str]:
    for word in re.findall(r"[a-z_][a-z_0-9]*", sql):
        if word in CTES and word not in seen:
            needed(CTES[word], seen)
            if word not in seen:
                seen.append(word)
    return seen


def full(sql: str) -> str:
    """The statement preceded by every CTE it needs."""
    names = needed(sql, [])
    return ("WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + sql) if names else sql


def plain(sql: str, exact: bool = True) -> str:
    """`sql` with exact columns as DOUBLE (`exact`: whether it has any)."""
    if not exact:
        return sql
    names = ", ".join(f"'{c}'" for c in EXACT)
    return (
        f"SELECT CAST(COLUMNS(lambda c: c IN ({names})) AS DOUBLE), COLUMNS(lambda c: c NOT IN ({names})) FROM ({sql})"
    )


def ratio(num: str, den: str, times: int = 1, digits: int = 2, otherwise: str = "NULL") -> str:
    """Exact `num / den * times`, rounded half away from zero; `otherwise` unless `den > 0`."""
    n = f"CAST(CAST({num} AS DECIMAL(30,6)) * 1000000 AS HUGEINT)"
    d = f"CAST(CAST({den} AS DECIMAL(30,6)) * 1000000 AS HUGEINT)"
    k = times * 10**digits
    up = f"(2 * abs({n}) * {k} + {d}) // (2 * {d})"
    return (
        f"CASE WHEN {den} > 0 THEN sign({n}) * CAST({up} AS DOUBLE) / {10**digits} ELSE CAST({otherwise} AS DOUBLE) END"
    )


def pct(num: str, den: str, otherwise: str = "NULL") -> str:
    return ratio(num, den, 100, 2, otherwise)


def div(num: str, den: str, otherwise: str = "NULL") -> str:
    """Unrounded quotient where the divisor is positive."""
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE CAST({otherwise} AS DOUBLE) END"


def safe(num: str, den: str) -> str:
    """Unrounded quotient, NULL for a zero divisor."""
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def change(now: str, before: str) -> str:
    return safe(f"({now} - {before})", f"abs({before})")


def flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def arms(pairs, otherwise="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {otherwise} END"


def local(ts: str) -> str:
    return f"(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles')"


def sunday(day: str) -> str:
    return f"CAST({day} - CAST(dayofweek({day}) AS INTEGER) AS DATE)"


def month(day: str) -> str:
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def monday(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"
