"""Input schemas. Money is DECIMAL(18,2); feeds carry the store name in `store`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def _address(side: str) -> str:
    parts = ("address_1", "address_2", "city", "province", "province_code", "zip", "country", "country_code")
    return ", ".join(f"{side}_address_{p} string" for p in parts)


ORDERS = f"""
order_id bigint, customer_id bigint, user_id bigint, email string, processed_timestamp timestamp_ntz,
created_timestamp timestamp_ntz, cancelled_timestamp timestamp_ntz, closed_timestamp timestamp_ntz,
updated_timestamp timestamp_ntz, subtotal_price_pres_amount {MONEY}, total_price_pres_amount {MONEY},
total_discounts_pres_amount {MONEY}, total_tax_pres_amount {MONEY}, total_tip_received_pres_amount {MONEY},
refund_subtotal {MONEY}, refund_total_tax {MONEY}, order_adjustment_amount {MONEY}, order_adjusted_total {MONEY},
name string, number bigint, note string, source_name string, financial_status string, fulfillment_status string,
cancel_reason string, location_id bigint, {_address("billing")}, {_address("shipping")}, order_tags string,
_fivetran_synced timestamp_ntz, source_relation string, store string
"""

ORDER_LINES = f"""
order_line_id string, order_id bigint, product_id bigint, variant_id bigint, sku string, title string, name string,
quantity bigint, variant_price {MONEY}, price_pres_amount {MONEY}, total_discount_pres_amount {MONEY}, vendor string,
variant_title string, is_gift_card boolean, is_taxable boolean, is_shipping_required boolean,
fulfillment_status string, index int, _fivetran_synced timestamp_ntz, source_relation string, store string
"""

CUSTOMERS = f"""
customer_id bigint, email string, first_name string, last_name string, phone string, note string,
account_state string, is_tax_exempt boolean, is_verified_email boolean, currency string,
marketing_consent_state string, marketing_opt_in_level string, marketing_consent_updated_at timestamp_ntz,
created_timestamp timestamp_ntz, updated_timestamp timestamp_ntz, first_order_timestamp timestamp_ntz,
most_recent_order_timestamp timestamp_ntz, customer_tags string, lifetime_count_orders bigint,
lifetime_total_spent {MONEY}, lifetime_total_refunded {MONEY}, lifetime_total_net {MONEY},
lifetime_total_tax {MONEY}, lifetime_total_discount {MONEY}, lifetime_abandoned_checkouts bigint,
avg_order_value {MONEY}, avg_quantity_per_order double, avg_tax_per_order {MONEY},
_fivetran_synced timestamp_ntz, source_relation string, store string
"""

_PARAMS = "array<struct<key: string, value: struct<string_value: string, int_value: bigint, double_value: double>>>"
EVENTS = f"""
event_date string, event_timestamp bigint, event_name string, event_bundle_sequence_id bigint,
event_previous_timestamp bigint, event_value_in_usd double, user_id string, user_pseudo_id string,
user_first_touch_timestamp bigint,
device struct<category: string, mobile_brand_name: string, mobile_model_name: string, operating_system: string,
operating_system_version: string, language: string, web_info: struct<browser: string, browser_version: string>>,
geo struct<continent: string, country: string, region: string, city: string, metro: string>,
traffic_source struct<name: string, medium: string, source: string>, app_info struct<id: string, version: string>,
platform string, privacy_info struct<analytics_storage: string, ads_storage: string>,
ecommerce struct<transaction_id: string, purchase_revenue: double>, event_params {_PARAMS}, user_properties {_PARAMS}
"""

SOCIAL_ADS = f"""
date_day date, account_id string, account_name string, campaign_id bigint, campaign_name string, ad_set_id string,
ad_set_name string, ad_id string, ad_name string, conversion_domain string, clicks bigint, impressions bigint,
spend {MONEY}, conversions double, conversions_value {MONEY}, source_relation string
"""

SEARCH_STATS = f"""
segments_date date, campaign_id bigint, customer_id bigint, metrics_clicks bigint, metrics_impressions bigint,
metrics_cost_micros bigint, metrics_conversions double, metrics_conversions_value {MONEY},
metrics_interactions bigint, metrics_view_through_conversions bigint, segments_ad_network_type string,
segments_device string, _DATA_DATE date, _LATEST_DATE date
"""

SEARCH_CAMPAIGNS = """
campaign_id bigint, customer_id bigint, campaign_name string, campaign_advertising_channel_type string,
campaign_advertising_channel_sub_type string, campaign_status string, _DATA_DATE date
"""

_MAIL = f"""
status string, is_archived boolean, total_count_unique_people bigint, unique_count_received_email bigint,
unique_count_opened_email bigint, unique_count_clicked_email bigint, unique_count_marked_email_as_spam bigint,
unique_count_unsubscribed bigint, count_opened_email bigint, count_clicked_email bigint,
unique_count_placed_order bigint, count_placed_order bigint, sum_revenue_placed_order {MONEY},
sum_revenue_ordered_product {MONEY}, sum_revenue_checkout_started {MONEY}, sum_revenue_refunded_order {MONEY},
sum_revenue_cancelled_order {MONEY}, unique_count_received_sms bigint, unique_count_clicked_sms bigint,
created_at timestamp_ntz, updated_at timestamp_ntz
"""
EMAIL_CAMPAIGNS = f"""
campaign_id bigint, campaign_variation_key string, variation_id string, campaign_name string, subject string,
campaign_type string, from_email string, from_name string, email_template_id string, sent_at timestamp_ntz,
scheduled_at timestamp_ntz, {_MAIL}
"""
EMAIL_FLOWS = f"flow_id bigint, flow_name string, trigger_type string, {_MAIL}"

SHIPMENTS = f"""
id string, created_date timestamp_ntz, pickup_date timestamp_ntz, tracking_delivery_date_actual timestamp_ntz,
status string, tracking_status string, rate_carrier string, rate_service_type string, rate_transit_days int,
rate_total {MONEY}, invoice_amount {MONEY}, origin_city string, origin_state string, destination_city string,
destination_state string
"""

SKU_LOOKUP = """
sku string, product_line string, product_category string, bevel string, color_code string, color_name string
"""


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of `ddl`, in order and cast to its types; raises when one is missing."""
    fields = T.StructType.fromDDL(ddl).fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
