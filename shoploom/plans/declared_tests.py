"""The declared column tests of every result, run as one table of violations per result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoploom.functions import rules

_STORES = [s.name for s in rules.STORES]
_ORDER_TYPES = ["Product Order", "Sample Order", "Accessory Only", "Other"]
_LINE_TYPES = [rules.SAMPLE, rules.PRODUCT, rules.ACCESSORIES]
_GROUPS = ["Retail", "Trade Rewards", "Pending Trade Rewards"]
_BUCKETS = [rules.BUCKET_NONE, *[label for _, label in rules.CONVERSION_BUCKETS], rules.BUCKET_ABOVE]
_STAGES = [*[label for _, label, _ in rules.FUNNEL_STAGES], "Other"]


def _names(pairs):
    return [*[label for label, _ in pairs], "Other"]


# Result -> not-null columns, unique keys, accepted values, parents (column, result, field).
# Orders are unique by (order_id, store), their deduplication key.
TESTS: dict[str, dict] = {
    "orders": dict(not_null="order_id email processed_at store", unique=["order_id,store"], accepted={"store": _STORES}),
    "lines": dict(not_null="order_line_id order_id line_item_type store", unique=["order_line_id"],
                  accepted={"line_item_type": _LINE_TYPES, "store": _STORES}, parents=[("order_id", "orders", "order_id")]),
    "customers": dict(not_null="email customer_group customer_type store", unique=["email"],
                      accepted={"customer_group": _GROUPS, "store": _STORES}),
    "events": dict(not_null="event_date event_name event_timestamp_pt"),
    "social_ads": dict(not_null="date_day ad_id campaign_id channel", accepted={"channel": ["Facebook"]}),
    "search_ads": dict(not_null="date_day campaign_id channel", accepted={"channel": ["Google"]}),
    "email_campaigns": dict(not_null="campaign_id channel campaign_category", unique=["campaign_id"],
                            accepted={"channel": ["Email"], "campaign_category": _names(rules.CAMPAIGN_CATEGORIES)}),
    "email_flows": dict(not_null="flow_id channel flow_category", unique=["flow_id"],
                        accepted={"channel": ["Email"], "flow_category": _names(rules.FLOW_CATEGORIES)}),
    "shipments": dict(not_null="shipment_id", unique=["shipment_id"]),
    "classified": dict(not_null="order_id email order_type", unique=["order_id,store"], accepted={"order_type": _ORDER_TYPES}),
    "lifetime": dict(not_null="order_id email order_sequence_number", unique=["order_id,store"]),
    "households": dict(not_null="order_id email household_id", unique=["order_id,store"]),
    "funnel": dict(not_null="email", unique=["email"]),
    "enriched_lines": dict(not_null="order_line_id"),
    "sessions": dict(not_null="user_pseudo_id ga_session_id session_date deepest_funnel_stage funnel_stage_depth",
                     accepted={"deepest_funnel_stage": _STAGES}),
    "fct_orders": dict(not_null="order_id email order_date order_type store customer_status", unique=["order_id,store"],
                       accepted={"order_type": _ORDER_TYPES, "store": _STORES, "customer_status": [
                           "New Customer", "New Customer Sample", "Returning Sample", "Returning Customer", "Other"]},
                       parents=[("email", "dim_customers", "email")]),
    "fct_order_lines": dict(not_null="order_line_id order_id email line_item_type", unique=["order_line_id"],
                            accepted={"line_item_type": _LINE_TYPES},
                            parents=[("order_id", "fct_orders", "order_id"), ("email", "dim_customers", "email")]),
    "dim_customers": dict(not_null="email customer_group customer_type customer_segment", unique=["email"],
                          accepted={"customer_group": _GROUPS, "customer_segment": [
                              *[label for _, label in rules.SEGMENTS], "Sample Only", "No Purchase"]}),
    "sample_conversions": dict(
        not_null="email first_sample_order_date conversion_ind sample_order_type conversion_window_bucket "
                 "household_conversion_window_bucket hybrid_conversion_window_bucket",
        unique=["email"], accepted={f"{p}conversion_window_bucket": _BUCKETS for p in ("", "household_", "hybrid_")},
        parents=[("email", "dim_customers", "email")]),
    "daily_performance": dict(not_null="date_day store", accepted={"store": _STORES}),
    "weekly_product_sales": dict(not_null="week_start_date sku line_item_type store",
                                 accepted={"line_item_type": _LINE_TYPES, "store": _STORES}),
    "monthly_cohorts": dict(not_null="cohort_month primary_store months_since_first_order", accepted={"primary_store": _STORES}),
    "unit_economics": dict(not_null="order_id email order_date store order_type", unique=["order_id,store"],
                           accepted={"store": _STORES, "order_type": ["Product Order"]}),
    "demand_features": dict(not_null="date_day store sku line_item_type",
                            accepted={"store": _STORES, "line_item_type": [rules.PRODUCT]}),
    "ad_performance": dict(not_null="date_day channel campaign_id", accepted={"channel": ["Facebook", "Google"]}),
    "email_performance": dict(not_null="email_id email_type email_category channel", unique=["email_id"],
                              accepted={"email_type": ["Campaign", "Flow"], "channel": ["Email"]}),
    "web_funnel": dict(not_null="session_date deepest_funnel_stage", accepted={"deepest_funnel_stage": _STAGES}),
    "fct_shipments": dict(not_null="shipment_id pickup_date", unique=["shipment_id"]),
    "net_sales": dict(not_null="grain", accepted={"grain": ["weekly", "monthly"]}),
    "channel_mix": dict(not_null="wbr_channel", accepted={"wbr_channel": ["DTC", "Comm.", "MSR", "Ind. Retail"]}),
    "product_performance": dict(not_null="grain product_line", accepted={"grain": ["product_line", "subline"]}),
    "sku_performance": dict(not_null="sku"),
    "sample_orders": dict(not_null="grain"),
    "sample_sku_ranking": dict(not_null="sku"),
    "launch_sampling": dict(not_null="sku size_variant"),
}


def run_tests(result: str, df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows (test, violations) of one result; every column test shares a single pass over it.

    Uniqueness counts surplus rows. A NULL is only counted by the not-null test.
    """
    declared = TESTS[result]
    counts = {f"not_null {c}": F.count_if(F.col(c).isNull()) for c in declared["not_null"].split()}
    counts |= {
        f"accepted_values {c}": F.count_if(~F.col(c).isin(*values)) for c, values in declared.get("accepted", {}).items()
    }
    parts = [df.agg(*[c.alias(n) for n, c in counts.items()]).unpivot([], list(counts), "test", "violations")]
    for key in declared.get("unique", []):
        columns = key.split(",")
        surplus = df.dropna(subset=columns).groupBy(*columns).agg((F.count("*") - 1).alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
        )
        parts.append(surplus.select(F.lit(f"unique {key}").alias("test"), "violations"))
    for column, parent, field in declared.get("parents", []):
        known = parents[parent].select(F.col(field).alias(column)).distinct()
        orphans = df.filter(F.col(column).isNotNull()).join(known, column, "left_anti").agg(F.count("*").alias("violations"))
        parts.append(orphans.select(F.lit(f"relationship {column}").alias("test"), "violations"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(result).alias("result"), "test", "violations")
