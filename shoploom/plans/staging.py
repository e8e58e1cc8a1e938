"""Staging: one row per order, line, customer, event, ad day, mail and shipment, cleaned and classified.

Orders, lines and customers come as one feed per store (`{store: feed}`), which are stacked here: columns that a store
lacks are NULL, of the type the other store has. A single frame with the name in `store` will do as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.functions import rules
from shoploom.operators.relational import union_stores
from shoploom.operators.windows import newest_per
from shoploom.sources.tables import shards_since


def per_store(stores: Sequence[rules.Store], attribute: str) -> Column:
    """Setting of the row's store."""
    return x.ladder([(F.col("store") == s.name, getattr(s, attribute)) for s in stores])


Feeds = DataFrame | Mapping[str, DataFrame]


def stacked(feeds: Feeds, stores: Sequence[rules.Store]) -> DataFrame:
    """All stores' rows with the store's name. A feed of a store without settings is refused."""
    if isinstance(feeds, DataFrame):
        return feeds
    unknown = sorted(set(feeds) - {s.name for s in stores})
    if unknown or not feeds:
        raise ValueError(f"no settings for the stores {unknown}" if unknown else "no feed at all")
    return union_stores(feeds)


# Column names.
_ADDRESS = {
    "address_1": "{}_address_line1", "address_2": "{}_address_line2", "city": "{}_address_city",
    "province": "{}_state", "province_code": "{}_state_code", "zip": "{}_address_zip",
    "country": "{}_address_country", "country_code": "{}_address_country_code",
}


def stage_orders(
    orders: Feeds,
    stores: Sequence[rules.Store] = rules.STORES,
    tz: str = rules.PACIFIC,
    newest_first: Sequence[str] = ("_fivetran_synced",),
) -> DataFrame:
    """Newest copy of each (order_id, store) with civil times, salesperson and date parts."""
    def local(name):
        return x.civil_time(name, tz)

    def zero(name):
        return F.coalesce(F.col(name), F.lit(0).cast("decimal(18,2)")).alias(name)

    newest = newest_per(stacked(orders, stores), ["order_id", "store"], newest_first)
    staged = newest.select(
        "order_id", "customer_id", "user_id", F.lower("email").alias("email"),
        *[local(f"{t}_timestamp").alias(f"{t}_at") for t in ("processed", "created", "cancelled", "closed", "updated")],
        F.col("subtotal_price_pres_amount").alias("subtotal_price"), F.col("total_price_pres_amount").alias("total_price"),
        F.col("total_discounts_pres_amount").alias("total_discounts"), F.col("total_tax_pres_amount").alias("total_tax"),
        F.col("total_tip_received_pres_amount").alias("total_tip_received"),
        zero("refund_subtotal"), zero("refund_total_tax"), zero("order_adjustment_amount"), "order_adjusted_total",
        F.col("name").alias("order_name"), F.col("number").alias("order_number"), "note", "source_name",
        "financial_status", "fulfillment_status", "cancel_reason", "location_id",
        *[
            F.col(f"{side}_address_{part}").alias(out.format(side))
            for side in ("billing", "shipping") for part, out in _ADDRESS.items()
        ],
        F.col("order_tags").alias("tags"), "store", "_fivetran_synced", "source_relation",
        per_store(stores, "price_threshold").alias("product_price_threshold"),
        per_store(stores, "default_salesperson").alias("default_salesperson"),
    )
    return staged.withColumns({
        "salesperson": F.coalesce(x.first_group("tags", rules.SALESPERSON_TAG), F.col("default_salesperson")),
        "order_date": F.to_date("processed_at"),
        "order_year": F.year("processed_at"),
        "order_month": F.month("processed_at"),
        "order_quarter": F.quarter("processed_at"),
    })


def line_type(threshold: Column, title: Column, sku: Column) -> Column:
    """Sample, Product or Accessories: sku prefix first, then words in title and sku, then price.

    `title` and `sku` are in lower case.
    """
    sample = (
        x.like_any("sku", rules.SAMPLE_SKU_PREFIXES)
        | x.like_any(title, rules.SAMPLE_TITLE_PARTS)
        | x.like_any(sku, rules.SAMPLE_SKU_PARTS)
    )
    dear = (F.col("price") > threshold) & ~title.like(rules.NOT_PRODUCT_TITLE)
    return x.ladder(
        [(sample, rules.SAMPLE), (F.col("sku").like(rules.PRODUCT_SKU_PREFIX) | dear, rules.PRODUCT)], rules.ACCESSORIES
    )


def sample_type(title: Column, sku: Column) -> Column:
    return x.ladder([
        (x.like_any(title, rules.CUT_TITLE_PARTS) | sku.like(rules.CUT_SKU_PART), rules.SAMPLE_CUT),
        (title.like(rules.PLANK_TITLE_PART) | sku.like(rules.PLANK_SKU_PART), rules.SAMPLE_PLANK),
    ])


def first_word(title: str) -> Column:
    """Text before the first white space, at least one character long; the whole title without one."""
    return F.coalesce(F.nullif(F.regexp_extract(title, r"^(.+?)\s", 1), F.lit("")), F.col(title))


# Columns of named lines that the line fact leaves out.
UNREAD = ["line_item_index", "_fivetran_synced", "source_relation"]


def name_order_lines(lines: Feeds, stores: Sequence[rules.Store] = rules.STORES) -> DataFrame:
    """Lines as delivered, under their names here: all that `type_order_lines` needs."""
    return stacked(lines, stores).select(
        "order_line_id", "order_id", "product_id", "variant_id", "sku", "title", F.col("name").alias("line_item_name"),
        "quantity", F.col("variant_price").alias("price"), F.col("price_pres_amount").alias("line_total_gross"),
        F.col("total_discount_pres_amount").alias("total_discount"), "vendor", "variant_title", "is_gift_card",
        "is_taxable", "is_shipping_required", "fulfillment_status", F.col("index").alias("line_item_index"), "store",
        "_fivetran_synced", "source_relation",
    )


def stage_order_lines(lines: Feeds, stores: Sequence[rules.Store] = rules.STORES) -> DataFrame:
    """Classified lines with quantity and revenue split by type. Lines are not deduplicated."""
    named = name_order_lines(lines, stores)
    typed = type_order_lines(named, stores)
    last = ["product_price_threshold", "_fivetran_synced", "source_relation"]
    first = [c for c in named.columns if c not in last]
    return typed.select(*first, *last, *[c for c in typed.columns if c not in (*first, *last)])


def type_order_lines(named: DataFrame, stores: Sequence[rules.Store] = rules.STORES) -> DataFrame:
    """Named lines with their type, and quantity and revenue split by it. Lines that are joined are narrower before than after."""
    # Lower-cased once per line, not once per pattern.
    lowered = named.withColumns({
        "product_price_threshold": per_store(stores, "price_threshold"), "_title": F.lower("title"), "_sku": F.lower("sku"),
    })
    typed = lowered.withColumns({
        "line_item_type": line_type(F.col("product_price_threshold"), F.col("_title"), F.col("_sku")),
        "sample_type": sample_type(F.col("_title"), F.col("_sku")),
        "color": first_word("title"),
        "line_total": F.col("line_total_gross"),
    }).drop("_title", "_sku")
    kinds = {"sample": rules.SAMPLE, "product": rules.PRODUCT, "accessories": rules.ACCESSORIES}
    return typed.withColumns({
        f"{name}_{measure}": F.when(F.col("line_item_type") == kind, F.col(column)).otherwise(0)
        for measure, column in (("quantity", "quantity"), ("revenue", "line_total"))
        for name, kind in kinds.items()
    })


def stage_customers(
    customers: Feeds,
    tz: str = rules.PACIFIC,
    newest_first: Sequence[str] = ("updated_at", "_fivetran_synced"),
    stores: Sequence[rules.Store] = rules.STORES,
) -> DataFrame:
    """Newest record per lower-case email, with customer group and type from the tags."""
    def local(name):
        return x.civil_time(name, tz)

    named = stacked(customers, stores).filter(F.col("email").isNotNull()).select(
        "customer_id", F.lower("email").alias("email"), "first_name", "last_name", "phone", "note", "account_state",
        "is_tax_exempt", "is_verified_email", "currency", "marketing_consent_state", "marketing_opt_in_level",
        "marketing_consent_updated_at", local("created_timestamp").alias("created_at"),
        local("updated_timestamp").alias("updated_at"), local("first_order_timestamp").alias("first_order_at"),
        local("most_recent_order_timestamp").alias("most_recent_order_at"), F.col("customer_tags").alias("tags"),
        "lifetime_count_orders", "lifetime_total_spent", "lifetime_total_refunded", "lifetime_total_net",
        "lifetime_total_tax", "lifetime_total_discount", "lifetime_abandoned_checkouts", "avg_order_value",
        "avg_quantity_per_order", "avg_tax_per_order", "store", "_fivetran_synced", "source_relation",
    )
    tags = F.lower("tags")
    return newest_per(named, ["email"], newest_first).withColumns({
        "customer_group": x.ladder(
            [(x.like_any(tags, patterns), label) for label, patterns in rules.CUSTOMER_GROUPS], rules.DEFAULT_CUSTOMER_GROUP
        ),
        "customer_type": F.coalesce(x.first_group("tags", rules.CUSTOMER_TYPE_TAG), F.lit(rules.DEFAULT_CUSTOMER_TYPE)),
    })


def page_type(url, host: str = rules.SHOP_HOST) -> Column:
    u = x.col(url)
    arms = [(x.like_any(u, patterns), label) for label, patterns in rules.PAGE_TYPES]
    return x.ladder([*arms, ((u == "/") | u.like(f"%{host}/"), "homepage")], "other")


def stage_events(
    events: DataFrame, as_of: Column | None = None, days: int = 90, tz: str = rules.PACIFIC, host: str = rules.SHOP_HOST
) -> DataFrame:
    """Flat web events of the last `days` days: civil times, parameters by key, event flags, page type."""
    recent = shards_since(events, F.current_date() if as_of is None else as_of, days)
    utc = recent.withColumns({
        "event_timestamp_utc": x.micros_to_utc("event_timestamp"),
        "event_previous_timestamp_utc": x.micros_to_utc("event_previous_timestamp"),
        "user_first_touch_timestamp_utc": x.micros_to_utc("user_first_touch_timestamp"),
    })
    flat = utc.select(
        "event_date", "event_name", "event_bundle_sequence_id", "event_timestamp_utc",
        x.civil_time("event_timestamp_utc", tz).alias("event_timestamp_pt"),
        F.to_date(x.civil_time("event_timestamp_utc", tz)).alias("event_date_pt"), "event_previous_timestamp_utc",
        x.civil_time("event_previous_timestamp_utc", tz).alias("event_previous_timestamp_pt"), "event_value_in_usd",
        "user_id", "user_pseudo_id", "user_first_touch_timestamp_utc", F.col("device.category").alias("device_category"),
        F.col("device.mobile_brand_name").alias("device_brand"), F.col("device.mobile_model_name").alias("device_model"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.operating_system_version").alias("os_version"), F.col("device.web_info.browser").alias("browser"),
        F.col("device.web_info.browser_version").alias("browser_version"),
        F.col("device.language").alias("device_language"),
        *[F.col(f"geo.{c}").alias(f"geo_{c}") for c in ("continent", "country", "region", "city", "metro")],
        *[F.col(f"traffic_source.{c}").alias(f"traffic_source_{c}") for c in ("name", "medium", "source")],
        F.col("app_info.id").alias("app_id"), F.col("app_info.version").alias("app_version"), "platform",
        F.col("privacy_info.analytics_storage").alias("analytics_storage_consent"),
        F.col("privacy_info.ads_storage").alias("ads_storage_consent"), "ecommerce", "event_params", "user_properties",
    )
    known = flat.withColumns({out: x.param_value("event_params", key, kind) for out, key, kind in rules.EVENT_PARAMS})
    return known.withColumns({
        **{f"is_{name}": x.flag(F.col("event_name") == name) for name in rules.EVENT_FLAGS},
        "engagement_time_seconds": F.col("engagement_time_msec") / F.lit(1000.0).cast("double"),
        "seconds_since_previous_event": x.second_gap("event_timestamp_pt", "event_previous_timestamp_pt"),
        "page_type": page_type("page_location", host),
    })


def with_ad_ratios(df: DataFrame) -> DataFrame:
    """Click rate (%), cost per click, return on spend and cost per conversion; NULL without a denominator."""
    return df.withColumns({
        "ctr": x.percent("clicks", "impressions"),
        "cpc": x.rounded_ratio("spend", "clicks"),
        "roas": x.rounded_ratio("conversions_value", "spend"),
        "cpa": x.rounded_ratio("spend", "conversions"),
    })


def stage_social_ads(ads: DataFrame, channel: str = "Facebook") -> DataFrame:
    return with_ad_ratios(ads).withColumn("channel", F.lit(channel))


def stage_search_ads(stats: DataFrame, campaigns: DataFrame, channel: str = "Google") -> DataFrame:
    """Campaign statistics in currency units with the newest attributes of each campaign."""
    named = stats.select(
        F.col("segments_date").alias("date_day"), "campaign_id", "customer_id", F.col("metrics_clicks").alias("clicks"),
        F.col("metrics_impressions").alias("impressions"),
        (F.col("metrics_cost_micros") / F.lit(1000000)).cast("decimal(20,6)").alias("spend"),
        F.col("metrics_conversions").alias("conversions"), F.col("metrics_conversions_value").alias("conversions_value"),
        F.col("metrics_interactions").alias("interactions"),
        F.col("metrics_view_through_conversions").alias("view_through_conversions"),
        F.col("segments_ad_network_type").alias("ad_network_type"), F.col("segments_device").alias("device"),
        F.col("_DATA_DATE").alias("data_date"), F.col("_LATEST_DATE").alias("latest_date"),
    )
    attributes = newest_per(campaigns, ["campaign_id", "customer_id"], ["_DATA_DATE"]).select(
        "campaign_id", "customer_id", "campaign_name", F.col("campaign_advertising_channel_type").alias("channel_type"),
        F.col("campaign_advertising_channel_sub_type").alias("channel_sub_type"), F.col("campaign_status").alias("status"),
    )
    joined = named.join(attributes, ["campaign_id", "customer_id"], "left")
    return with_ad_ratios(joined).withColumn("channel", F.lit(channel))


# Column names.
_MAIL_COUNTS = {
    "total_count_unique_people": "recipients", "unique_count_received_email": "received",
    "unique_count_opened_email": "opened", "unique_count_clicked_email": "clicked",
    "unique_count_marked_email_as_spam": "marked_spam", "unique_count_unsubscribed": "unsubscribed",
    "count_opened_email": "total_opens", "count_clicked_email": "total_clicks",
    "unique_count_placed_order": "converters", "count_placed_order": "orders", "sum_revenue_placed_order": "revenue",
    "sum_revenue_ordered_product": "product_revenue", "sum_revenue_checkout_started": "checkout_started_value",
    "sum_revenue_refunded_order": "refunded_revenue", "sum_revenue_cancelled_order": "cancelled_revenue",
    "unique_count_received_sms": "sms_received", "unique_count_clicked_sms": "sms_clicked",
}
# Column names.
_MAIL_RATES = {
    "open_rate": ("opened", "received"), "click_rate": ("clicked", "received"),
    "click_to_open_rate": ("clicked", "opened"), "unsubscribe_rate": ("unsubscribed", "received"),
    "bounce_rate": ("bounced", "received"), "conversion_rate": ("converters", "received"),
}
_MAIL_MONEY = {
    "revenue_per_converter": "converters", "revenue_per_recipient": "received", "average_order_value": "orders",
}


def stage_mail(df: DataFrame, live_status: str, name: str, category: str, categories, channel: str = "Email") -> DataFrame:
    """Live, unarchived mailings with rates (0 without a denominator), net revenue and a category by name."""
    live = df.filter((F.col("status") == live_status) & ~F.col("is_archived"))
    counted = live.withColumnsRenamed(_MAIL_COUNTS).withColumn("bounced", F.lit(None).cast("bigint"))
    lower = F.lower(name)
    return counted.withColumns({
        **{out: x.percent(num, den, otherwise=0) for out, (num, den) in _MAIL_RATES.items()},
        **{out: x.rounded_ratio("revenue", den, otherwise=0) for out, den in _MAIL_MONEY.items()},
        "net_revenue": F.col("revenue") - F.coalesce("refunded_revenue", F.lit(0)) - F.coalesce("cancelled_revenue", F.lit(0)),
        "channel": F.lit(channel),
        category: x.ladder([(x.like_any(lower, patterns), label) for label, patterns in categories], "Other"),
    })


def stage_email_campaigns(campaigns: DataFrame) -> DataFrame:
    return stage_mail(campaigns, "sent", "campaign_name", "campaign_category", rules.CAMPAIGN_CATEGORIES)


def stage_email_flows(flows: DataFrame) -> DataFrame:
    return stage_mail(flows, "live", "flow_name", "flow_category", rules.FLOW_CATEGORIES)


def stage_shipments(shipments: DataFrame, tz: str = rules.PACIFIC) -> DataFrame:
    """Shipments with cost, transit days, on-time flag (NULL when unknown) and variances.

    Dates are taken from the UTC instants, while the two `_at` columns are civil times.
    """
    named = shipments.select(
        F.col("id").alias("shipment_id"), x.civil_time("created_date", tz).alias("created_at"),
        F.to_date("pickup_date").alias("pickup_date"),
        x.civil_time("tracking_delivery_date_actual", tz).alias("actual_delivery_at"),
        F.to_date("tracking_delivery_date_actual").alias("actual_delivery_date"), "status", "tracking_status",
        F.col("rate_carrier").alias("carrier"), F.col("rate_service_type").alias("service_type"),
        F.col("rate_transit_days").alias("estimated_transit_days"), F.col("rate_total").alias("quoted_rate"),
        F.col("invoice_amount").alias("invoiced_amount"),
        F.coalesce("invoice_amount", "rate_total").alias("shipping_cost"), "origin_city", "origin_state",
        "destination_city", "destination_state",
    )
    timed = named.withColumn("actual_transit_days", F.datediff("actual_delivery_date", "pickup_date"))
    return timed.withColumns({
        "is_on_time": F.col("actual_transit_days") <= F.col("estimated_transit_days"),
        "cost_variance": F.col("invoiced_amount") - F.col("quoted_rate"),
        "transit_variance_days": F.col("actual_transit_days") - F.col("estimated_transit_days"),
    })
