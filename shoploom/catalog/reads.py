"""Columns of the order fact that registered queries read.

A query's `Shop` makes and writes the order fact and classified orders with these columns only: rows and steps are the same, but
addresses, names and counts that nobody reads are not shuffled, sorted and written. Queries that are not named here get all columns.
"""

from __future__ import annotations

from shoploom.plans import customers as c

_LINES = ["order_id", "store", *c.LINE_CONTEXT]
_FULL_LINES = ["order_id", "store", *c.ORDER_CONTEXT]
_ENRICHED = [*_LINES, "cancel_reason", "financial_status"]
_CUSTOMERS = [
    "email", "store", "order_date", "shipping_state", "shipping_state_code", "shipping_address_city",
    *[f"lifetime_{kind}_{what}" for kind in ("product", "sample", "total") for what in ("orders", "revenue")],
]
_CONVERSIONS = [
    *_CUSTOMERS, "order_id", "salesperson", "sample_quantity", "product_quantity", "sample_revenue", "product_revenue",
    "is_product_order", "is_first_sample_order", "is_first_product_order", "first_sample_order_date",
]
_DAILY = [
    "order_date", "store", "email", "is_product_order", "is_sample_order", "is_accessory_only", "net_sales", "total_discounts",
    "product_quantity", "sample_quantity", "accessories_quantity", "is_new_customer", "is_returning_customer",
]
_COHORTS = [*_CUSTOMERS, "order_id", "order_type", "net_sales"]
_WEEKS = ["order_date", "order_id", "net_sales", "cancel_reason"]

# By result, for the queries `kNN_<result>`, `a10_table_<result>`, `l16_declared_tests_<result>` and `n08_kpis_<result>`.
RESULTS: dict[str, list[str]] = {
    "funnel": [],
    "dim_customers": _CUSTOMERS,
    "sample_conversions": _CONVERSIONS,
    "daily_performance": _DAILY,
    "fct_order_lines": _FULL_LINES,
    "enriched_lines": [*_FULL_LINES, *_ENRICHED],
    "weekly_product_sales": [*_LINES, "email", "is_new_customer", "is_returning_customer"],
    "monthly_cohorts": _COHORTS,
    "unit_economics": [
        *_DAILY, "order_id", "order_type", "customer_status", "salesperson", "shipping_state", "shipping_address_country",
        "subtotal_price", "lifetime_product_revenue",
    ],
    "demand_features": [*_LINES, *_DAILY, "order_type"],
    "channel_mix": [*_WEEKS, "store", "salesperson"],
    "net_sales": [*_WEEKS, "email"],
    "product_performance": _ENRICHED,
    "sku_performance": _ENRICHED,
    "sample_orders": [*_ENRICHED, "is_sample_order"],
    "sample_sku_ranking": _ENRICHED,
    "launch_sampling": _ENRICHED,
}
_FAMILIES = ("a10_table_", "l16_declared_tests_", "n08_kpis_")

# By query.
QUERIES: dict[str, list[str]] = {
    "k13_customer_funnel": [],
    "a04_model_reference": ["store", "order_type"],
    "a08_table_sink_by_month": _CONVERSIONS,
    "a09_table_sink_clustered": _FULL_LINES,
    "b11_or_of_flags": ["order_id", "store", "email", "order_type", "is_first_sample_order", "is_first_product_order"],
    "b12_null_or_before": [],
    "b13_in_list": ["order_id", "store", "customer_status"],
    "b19_lookup_with_fallback": _ENRICHED,
    "b21_range_buckets": [],
    "c02_inner_to_window_result": [],
    "c05_left_star": ["email", "lifetime_total_orders"],
    "c06_mixed_joins_then_filter": ["email", "product_revenue", "is_first_product_order"],
    "c07_year_over_year": _WEEKS,
    "c08_full_outer": ["order_date", "store", "is_sample_order", "is_accessory_only"],
    "c09_share_of_total": ["order_year", "store", "net_sales"],
    "c11_detail_with_two_rollups": ["order_date", "store", "order_type"],
    "c12_cross_mart": [*_DAILY, "order_id"],
    "c13_coarser_grain": ["order_date", "store"],
    "c14_three_way_then_aggregate": [],
    "c16_left_sparse_key": [],
    "d03_count_distinct": [*_LINES, "email"],
    "d03_bitmaps_by_period": ["order_date", "order_id", "email"],
    "d04_conditional_bitmaps": ["order_date", "email", "is_sample_order", "is_product_order"],
    "d06_conditional_sum": ["order_year", "is_product_order", "is_sample_order", "net_sales"],
    "d08_first_of_kind": [],
    "d09_ever": [],
    "d10_attribute_pick": ["email", "order_id", "salesperson", "is_first_sample_order", "is_first_product_order"],
    "d11_conditional_average": ["order_year", "store", "line_item_count", "is_product_order"],
    "d12_mode": ["email", "shipping_state", "store"],
    "d12_merged_states": ["store", "order_date", "shipping_state"],
    "d12_customers_approximate": _CUSTOMERS,
    "d14_aggregate_of_aggregate": _LINES,
    "d18_global_aggregate": ["email", "net_sales", "order_date"],
    "d19_ratio_of_aggregates": ["order_year", "store", "net_sales", "subtotal_price"],
    "e02_sequence": [],
    "e03_sequence_by_flag": [],
    "e04_rank_in_period": ["order_year", "order_month", "salesperson", "net_sales"],
    "e05_running_sum": [],
    "e06_running_count": [],
    "e07_running_sum_with_peers": ["store", "order_type", "order_date"],
    "e08_cumulative_of_aggregate": _COHORTS,
    "e09_lag": _LINES,
    "e10_global_lag": _WEEKS,
    "e11_lag_n": _LINES,
    "e12_days_since_last": _LINES,
    "e13_lag_of_rank": RESULTS["sample_sku_ranking"],
    "e14_moving_average": _LINES,
    "e15_moving_stddev": _LINES,
    "e16_trailing_sum": _LINES,
    "e17_prior_sum": _LINES,
    "e18_frame_count": _LINES,
    "e19_partition_minimum": _LINES,
    "e20_first_value": [],
    "e21_window_in_arithmetic": _LINES,
    "f03_custom_order": _CONVERSIONS,
    "f04_top_one_per_group": ["email", "order_id", "order_date", "net_sales"],
    "f05_top_key_as_filter": _LINES,
    "g03_union_of_grains": ["order_date"],
    "h37_least": [],
    "l03_accepted_values": ["customer_status"],
    "l04_relationship": [*_CUSTOMERS, "order_id"],
    "l05_compare_counts": ["order_id"],
    "l06_compare_metrics": _CONVERSIONS,
    "l06_compare_metrics_tolerance": _CONVERSIONS,
    "l07_compare_distribution": _CONVERSIONS,
    "l08_compare_lifetime": ["email", "lifetime_product_orders", "lifetime_product_revenue"],
    "l09_profile_status": ["customer_status", "net_sales"],
    "l09_profile_segment": _CUSTOMERS,
    "l09_profile_group": _CUSTOMERS,
    "l10_orphans": _CONVERSIONS,
    "l11_invariants": [*_CONVERSIONS, "net_sales"],
    "l13_constant_in_group": _COHORTS,
    "l15_truth_table": _CONVERSIONS,
    "l16_declared_tests_classified": ["order_type"],
    "l16_declared_tests_lifetime": [],
    "l16_declared_tests_fct_orders": [*_CUSTOMERS, "order_id", "order_type", "customer_status"],
    "l16_declared_tests_fct_order_lines": [*_LINES, *_CUSTOMERS],
    "m01_conversion_lift": _CONVERSIONS,
    "m02_multi_email_households": _CONVERSIONS,
    "m03_cohort_conversion": _CONVERSIONS,
    "m04_window_comparison": _CONVERSIONS,
    "m05_household_attribution": _CONVERSIONS,
    "m11_daily_scorecard": _DAILY,
    "m11_weekly_top_skus": RESULTS["weekly_product_sales"],
    "m12_economics_by_day": RESULTS["unit_economics"],
    "m12_worst_margins": RESULTS["unit_economics"],
    "m13_top_sku_demand": RESULTS["demand_features"],
    "m14_retention_curve": _COHORTS,
    "n03_sample_cohort_retention": ["order_date", "first_sample_order_date", "email", "net_sales"],
    "n04_color_conversion": [*_LINES, "email", "processed_at"],
    "n07_sampled_after": [],
    "n08_kpis_fct_orders": ["order_id", "email", "order_type", "net_sales", "lifetime_product_revenue", "customer_status"],
    "n08_kpis_fct_order_lines": [*_LINES, "email"],
}


def columns_of(query: str) -> list[str] | None:
    """The columns that a query reads, None for all."""
    if query in QUERIES:
        return QUERIES[query]
    result = query.split("_", 1)[1] if query.startswith("k") else next((query[len(f):] for f in _FAMILIES if query.startswith(f)), "")
    return RESULTS.get(result)
