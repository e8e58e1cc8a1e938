"""K: the composite results."""

from oracle import models as check
from shoploom.catalog.registry import register
from shoploom.plans import staging

_HIDDEN = ["sampled_signature", "sampled_base", "sampled_craftsman", "sampled_silvan", "household_key"]


def _all(name, plan, cte, exact=True):
    register(name, plan, f"SELECT * FROM {cte}", exact)


_all("k01_stage_orders", lambda t: staging.stage_orders(t.by_store(t.orders_feed), t.stores), "k01")
_all("k02_stage_order_lines", lambda t: staging.stage_order_lines(t.by_store(t.lines_feed), t.stores), "k02")
_all("k03_stage_customers", lambda t: staging.stage_customers(t.by_store(t.customers_feed)), "k03")
_all("k04_stage_web_events", lambda t: t.events.drop("ecommerce", "event_params", "user_properties"), "k04_full", exact=False)
_all("k05_stage_social_ads", lambda t: t.social_ads, "k05")
_all("k06_stage_search_ads", lambda t: t.search_ads, "k06")
_all("k07_stage_email_campaigns", lambda t: t.email_campaigns, "k07")
_all("k08_stage_email_flows", lambda t: t.email_flows, "k08")
_all("k09_stage_shipments", lambda t: t.shipments, "k09")
register(
    "k10_order_classification", lambda t: t.classified.drop(*_HIDDEN), f"SELECT {', '.join(check.K10_COLUMNS)} FROM k10", True
)
_all("k11_lifetime_metrics", lambda t: t.lifetime.drop(*_HIDDEN), "k11")
_all("k12_households", lambda t: t.households, "k12", exact=False)
_all("k13_customer_funnel", lambda t: t.funnel, "k13", exact=False)
_all("k14_session_funnel", lambda t: t.sessions, "k14", exact=False)
_all("k15_enriched_lines", lambda t: t.enriched_lines, "k15")
_all("k16_dim_customers", lambda t: t.dim_customers, "k16")
_all("k17_fct_orders", lambda t: t.fct_orders_plan, "k17")
_all("k18_fct_order_lines", lambda t: t.fct_order_lines, "k18")
_all("k19_sample_conversions", lambda t: t.sample_conversions, "k19")
_all("k20_daily_performance", lambda t: t.daily_performance, "k20")
_all("k21_weekly_product_sales", lambda t: t.weekly_product_sales, "k21")
_all("k22_monthly_cohorts", lambda t: t.monthly_cohorts, "k22")
_all("k23_unit_economics", lambda t: t.unit_economics, "k23")
_all("k24_demand_features", lambda t: t.demand_features, "k24")
_all("k25_ad_performance", lambda t: t.ad_performance, "k25")
_all("k26_email_performance", lambda t: t.email_performance, "k26")
_all("k27_web_funnel", lambda t: t.web_funnel, "k27")
_all("k28_fct_shipments", lambda t: t.fct_shipments, "k28")
_all("k29_channel_mix", lambda t: t.channel_mix, "k29")
_all("k30_net_sales", lambda t: t.net_sales, "k30")
_all("k31_product_performance", lambda t: t.product_performance, "k31")
_all("k32_sku_performance", lambda t: t.sku_performance, "k32")
_all("k33_sample_orders", lambda t: t.sample_orders, "k33", exact=False)
_all("k34_sample_sku_ranking", lambda t: t.sample_sku_ranking, "k34", exact=False)
_all("k35_launch_sampling", lambda t: t.launch_sampling, "k35", exact=False)
