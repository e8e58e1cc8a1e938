"""The results of `shoploom.plans` in SQL, over the CTEs of `oracle.feeds`."""

from oracle import farm, feeds  # noqa: F401
from oracle.sql import arms, change, cte, div, flag, local, monday, month, pct, ratio, safe, sunday

_T = local("placed")

# --- staging ---------------------------------------------------------------------

_sides = ", ".join(
    f"street AS {s}_address_line1, NULL::VARCHAR AS {s}_address_line2, city AS {s}_address_city, 'State ' || state_no AS {s}_state, "
    f"'S' || state_no AS {s}_state_code, zip AS {s}_address_zip, country AS {s}_address_country, country AS {s}_address_country_code"
    for s in ("billing", "shipping")
)
cte("k01", f"""
SELECT order_id, customer_id, NULL::BIGINT AS user_id, lower(email) AS email, {_T} AS processed_at,
  {local("(placed - INTERVAL 5 MINUTE)")} AS created_at,
  CASE WHEN cancel IS NOT NULL THEN {local("(placed + INTERVAL 1 DAY)")} END AS cancelled_at,
  CASE WHEN o_orderstatus = 'O' THEN {local("(placed + INTERVAL 3 DAY)")} END AS closed_at, {_T} AS updated_at,
  subtotal AS subtotal_price, (subtotal + tax)::DECIMAL(18,2) AS total_price, discounts AS total_discounts, tax AS total_tax,
  0::DECIMAL(18,2) AS total_tip_received, coalesce(refund, 0)::DECIMAL(18,2) AS refund_subtotal, 0::DECIMAL(18,2) AS refund_total_tax,
  0::DECIMAL(18,2) AS order_adjustment_amount, (subtotal + tax - coalesce(refund, 0))::DECIMAL(18,2) AS order_adjusted_total,
  '#' || order_id AS order_name, order_id AS order_number, CASE WHEN copy = 1 THEN 'resync' END AS note, 'web' AS source_name,
  CASE o_orderstatus WHEN 'O' THEN 'paid' WHEN 'P' THEN 'refunded' ELSE 'pending' END AS financial_status,
  CASE o_orderstatus WHEN 'O' THEN 'fulfilled' WHEN 'P' THEN 'partial' END AS fulfillment_status, cancel AS cancel_reason,
  NULL::BIGINT AS location_id, {_sides}, tags, store, placed + to_days(copy) AS _fivetran_synced, 'shop_' || store AS source_relation,
  CASE store WHEN 'regular' THEN 955 ELSE 940 END AS product_price_threshold,
  CASE store WHEN 'regular' THEN 'DTC' ELSE 'Commercial' END AS default_salesperson,
  CASE WHEN regexp_matches(tags, 'Salesperson: (.*?),') THEN regexp_extract(tags, 'Salesperson: (.*?),', 1)
    WHEN store = 'regular' THEN 'DTC' ELSE 'Commercial' END AS salesperson,
  CAST({_T} AS DATE) AS order_date, year({_T})::INTEGER AS order_year, month({_T})::INTEGER AS order_month, quarter({_T})::INTEGER AS order_quarter
FROM feed_orders
QUALIFY row_number() OVER (PARTITION BY order_id, store ORDER BY placed + to_days(copy) DESC) = 1
""")

_types = arms(
    [
        ("sku LIKE 'SA-%' OR sku LIKE 'KIT%' OR regexp_matches(lower(title), 'cut|sample|plank') OR regexp_matches(lower(sku), 'cut|full')", "'Sample'"),
        ("sku LIKE 'FL-%' OR (price > CASE store WHEN 'regular' THEN 955 ELSE 940 END AND NOT contains(lower(title), 'nosing'))", "'Product'"),
    ],
    "'Accessories'",
)
_splits = ", ".join(
    f"CASE WHEN line_item_type = '{t}' THEN {c} ELSE 0 END AS {t.lower()}_{m}"
    for m, c in (("quantity", "quantity"), ("revenue", "line_total")) for t in ("Sample", "Product", "Accessories")
)
cte("k02", f"""
SELECT *, {_splits} FROM (
  SELECT order_line_id, order_id, product_id, product_id AS variant_id, sku, title, p_name AS line_item_name, quantity, price,
    line_total AS line_total_gross, total_discount, vendor, NULL::VARCHAR AS variant_title, false AS is_gift_card, true AS is_taxable,
    true AS is_shipping_required, fulfillment_status, l_linenumber AS line_item_index, store,
    CASE store WHEN 'regular' THEN 955 ELSE 940 END AS product_price_threshold, l_shipdate AS _fivetran_synced,
    'shop_' || store AS source_relation, {_types} AS line_item_type,
    CASE WHEN regexp_matches(lower(title), 'cut|sample') OR contains(lower(sku), 'cut') THEN 'Sample - Cut'
      WHEN contains(lower(title), 'plank') OR contains(lower(sku), 'full') THEN 'Sample - Plank' END AS sample_type,
    split_part(title, ' ', 1) AS color, line_total
  FROM feed_lines)
""")

cte("k03", f"""
SELECT customer_id, lower(email) AS email, 'Cust' AS first_name, k::VARCHAR AS last_name, NULL::VARCHAR AS phone, NULL::VARCHAR AS note,
  'ENABLED' AS account_state, false AS is_tax_exempt, k % 2 = 0 AS is_verified_email, 'USD' AS currency,
  CASE WHEN k % 3 = 0 THEN 'SUBSCRIBED' ELSE 'NOT_SUBSCRIBED' END AS marketing_consent_state, 'SINGLE_OPT_IN' AS marketing_opt_in_level,
  NULL::TIMESTAMP AS marketing_consent_updated_at, {local("made")} AS created_at, {local("(made + to_days(copy + 1))")} AS updated_at,
  {local("(made + INTERVAL 10 DAY)")} AS first_order_at, {local("(made + INTERVAL 100 DAY)")} AS most_recent_order_at, tags,
  k % 12 AS lifetime_count_orders, balance AS lifetime_total_spent, {feeds._share('balance', '0.1')} AS lifetime_total_refunded,
  {feeds._share('balance', '0.9')} AS lifetime_total_net, {feeds._share('balance', '0.08')} AS lifetime_total_tax,
  {feeds._share('balance', '0.05')} AS lifetime_total_discount, CASE WHEN copy = 0 THEN k % 4 END AS lifetime_abandoned_checkouts,
  {feeds._share('balance', '0.25')} AS avg_order_value, CAST(k % 5 + 0.5 AS DOUBLE) AS avg_quantity_per_order,
  {feeds._share('balance', '0.02')} AS avg_tax_per_order, store, made + to_days(copy + 2) AS _fivetran_synced, 'shop_' || store AS source_relation,
  CASE WHEN contains(lower(tags), 'pending') THEN 'Pending Trade Rewards'
    WHEN regexp_matches(lower(tags), 'trade|legacy tr|partner plus') THEN 'Trade Rewards' ELSE 'Retail' END AS customer_group,
  CASE WHEN regexp_matches(tags, 'Customer Type: (.*?),') THEN regexp_extract(tags, 'Customer Type: (.*?),', 1) ELSE 'DTC' END AS customer_type
FROM feed_customers WHERE email IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY copy DESC) = 1
""")

_flags = ", ".join(
    flag(f"event_name = '{n}'") + f" AS is_{n}" for n in
    "purchase add_to_cart remove_from_cart view_item view_item_list select_item begin_checkout add_payment_info "
    "add_shipping_info page_view session_start first_visit".split()
)
_unused = ", ".join(
    f"NULL::{t} AS {c}" for c, t in (
        ("page_referrer", "VARCHAR"), ("page_title", "VARCHAR"), ("ga_session_number", "BIGINT"), ("currency", "VARCHAR"),
        ("tax", "DOUBLE"), ("shipping", "DOUBLE"), ("coupon", "VARCHAR"), ("item_id", "VARCHAR"), ("item_name", "VARCHAR"),
        ("item_category", "VARCHAR"), ("item_variant", "VARCHAR"), ("item_price", "DOUBLE"), ("item_quantity", "BIGINT"),
        ("utm_campaign", "VARCHAR"), ("utm_source", "VARCHAR"), ("utm_medium", "VARCHAR"), ("utm_term", "VARCHAR"),
        ("utm_content", "VARCHAR"), ("search_term", "VARCHAR"), ("device_model", "VARCHAR"), ("geo_region", "VARCHAR"),
        ("geo_metro", "VARCHAR"), ("app_id", "VARCHAR"), ("app_version", "VARCHAR"), ("user_id", "VARCHAR"),
        ("user_first_touch_timestamp_utc", "TIMESTAMP"),
    )
)
_now, _then = local("ts"), local("previous_ts")
cte("k04", f"""
SELECT *, {_flags}, engagement_time_msec / 1000.0::DOUBLE AS engagement_time_seconds,
  date_diff('second', event_previous_timestamp_pt, event_timestamp_pt) AS seconds_since_previous_event,
  ['product_detail', 'product_detail', 'product_list', 'cart', 'checkout or samples', 'homepage', 'other'][kk + 1] AS page_kind
FROM (
  SELECT strftime(ts, '%Y%m%d') AS event_date,
    CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'begin_checkout' WHEN 'purchase' THEN 'purchase' ELSE 'page_view' END AS event_name,
    event_id AS event_bundle_sequence_id, ts AS event_timestamp_utc, {_now} AS event_timestamp_pt, CAST({_now} AS DATE) AS event_date_pt,
    previous_ts AS event_previous_timestamp_utc, {_then} AS event_previous_timestamp_pt, CASE WHEN bought THEN value END AS event_value_in_usd,
    CASE WHEN event_id % 61 <> 0 THEN user_id::VARCHAR END AS user_pseudo_id, ['mobile', 'desktop', 'tablet'][user_id % 3 + 1] AS device_category,
    'Acme' AS device_brand, 'Web' AS operating_system, '1' AS os_version, CASE WHEN user_id % 2 = 0 THEN 'Chrome' ELSE 'Safari' END AS browser,
    '9' AS browser_version, 'en' AS device_language, 'Americas' AS geo_continent, CASE WHEN user_id % 5 = 0 THEN 'CA' ELSE 'US' END AS geo_country,
    'City ' || (user_id % 9) AS geo_city, '(direct)' AS traffic_source_name, CASE WHEN user_id % 4 = 0 THEN 'cpc' ELSE 'organic' END AS traffic_source_medium,
    'search' AS traffic_source_source, 'WEB' AS platform, 'Yes' AS analytics_storage_consent, 'No' AS ads_storage_consent, k % 7 AS kk, k % 2 AS odd,
    CASE WHEN event_id % 50 <> 0 THEN CAST(strftime(ts, '%Y%m%d') AS BIGINT) END AS ga_session_id,
    CASE WHEN k % 3 = 0 THEN CAST(k * 130 AS BIGINT) END AS engagement_time_msec, CASE WHEN bought THEN 'T' || event_id END AS transaction_id,
    CASE WHEN bought THEN value END AS transaction_value
  FROM feed_events WHERE ts >= TIMESTAMP '2023-11-02 00:00:00')
""")
cte("k04_full", f"""
SELECT * EXCLUDE (page_kind, kk, odd), {_unused},
  CASE kk WHEN 0 THEN 'https://shop.example.com/products/oak' WHEN 1 THEN 'https://shop.example.com/collections/oak/products/a'
    WHEN 2 THEN 'https://shop.example.com/collections/oak' WHEN 3 THEN 'https://shop.example.com/cart'
    WHEN 4 THEN CASE odd WHEN 0 THEN 'https://shop.example.com/checkout' ELSE 'https://shop.example.com/pages/samples' END
    WHEN 5 THEN CASE odd WHEN 0 THEN 'https://shop.example.com/' ELSE '/' END ELSE 'https://shop.example.com/about' END AS page_location,
  CASE WHEN kk = 4 THEN CASE odd WHEN 0 THEN 'checkout' ELSE 'samples' END ELSE page_kind END AS page_type
FROM k04
""")

_adr = (
    f"{pct('clicks', 'impressions')} AS ctr, {ratio('spend', 'clicks')} AS cpc, "
    f"{ratio('conversions_value', 'spend')} AS roas, {ratio('spend', 'conversions')} AS cpa"
)
cte("k05", f"""
SELECT date_day, 'A1' AS account_id, 'Main' AS account_name, campaign_id, 'Social ' || campaign_id AS campaign_name, 'S' || campaign_id AS ad_set_id,
  'Set ' || campaign_id AS ad_set_name, 'D' || campaign_id AS ad_id, 'Ad ' || campaign_id AS ad_name, 'shop.example.com' AS conversion_domain,
  clicks, impressions, spend, conversions, conversions_value, 'social' AS source_relation, {_adr}, 'Facebook' AS channel
FROM feed_social
""")
cte("k06", f"""
SELECT date_day, s.campaign_id, 1::BIGINT AS customer_id, campaign_name, CASE WHEN c.campaign_id IS NOT NULL THEN 'SEARCH' END AS channel_type,
  NULL::VARCHAR AS channel_sub_type, status, clicks, impressions, spend, conversions, conversions_value, clicks AS interactions,
  0::BIGINT AS view_through_conversions, {_adr}, 'SEARCH' AS ad_network_type, device, 'Google' AS channel, date_day AS data_date,
  DATE '2001-12-31' AS latest_date
FROM feed_search s LEFT JOIN feed_campaigns c USING (campaign_id)
""")

_z = "0"
_mail = f"""
  is_archived, recipients, received, opened, clicked, marked_spam, unsubscribed, NULL::BIGINT AS bounced, total_opens, total_clicks, converters, orders, revenue,
  revenue AS product_revenue, checkout_started_value, refunded_revenue, cancelled_revenue, 0::BIGINT AS sms_received, 0::BIGINT AS sms_clicked,
  {pct('opened', 'received', _z)} AS open_rate, {pct('clicked', 'received', _z)} AS click_rate, {pct('clicked', 'opened', _z)} AS click_to_open_rate,
  {pct('unsubscribed', 'received', _z)} AS unsubscribe_rate, CASE WHEN received > 0 THEN NULL ELSE 0.0::DOUBLE END AS bounce_rate,
  {pct('converters', 'received', _z)} AS conversion_rate, {ratio('revenue', 'converters', otherwise=_z)} AS revenue_per_converter,
  {ratio('revenue', 'received', otherwise=_z)} AS revenue_per_recipient, {ratio('revenue', 'orders', otherwise=_z)} AS average_order_value,
  revenue - coalesce(refunded_revenue, 0) - coalesce(cancelled_revenue, 0) AS net_revenue, 'Email' AS channel,
  created_at, created_at + INTERVAL 1 DAY AS updated_at
"""


def _by_name(pairs):
    return arms([(f"regexp_matches(lower(mail_name), '{p}')", f"'{label}'") for p, label in pairs], "'Other'")


cte("k07", f"""
SELECT p_partkey AS campaign_id, 'v' || p_partkey AS campaign_variation_key, NULL::VARCHAR AS variation_id, mail_name AS campaign_name,
  'About ' || mail_name AS subject, 'email' AS campaign_type, 'sent' AS status, 'hello@example.com' AS from_email, 'Shop' AS from_name,
  NULL::VARCHAR AS email_template_id, CASE WHEN p_partkey % 50 <> 2 THEN created_at + INTERVAL 2 HOUR END AS sent_at, created_at AS scheduled_at,
  {_by_name((('welcome', 'Welcome Series'), ('abandon|cart', 'Cart Abandonment'), ('sample', 'Sample Nurture'), ('win.*back|re.*engage', 'Winback'),
             ('promo|sale', 'Promotion'), ('newsletter', 'Newsletter')))} AS campaign_category, {_mail}
FROM feed_mail WHERE NOT is_flow AND is_live AND NOT is_archived
""")
cte("k08", f"""
SELECT p_partkey AS flow_id, mail_name AS flow_name, 'live' AS status, trigger_type,
  {_by_name((('welcome', 'Welcome Series'), ('abandon|cart', 'Cart Abandonment'), ('sample', 'Sample Nurture'), ('post.*purchase|thank.*you', 'Post-Purchase'),
             ('win.*back|re.*engage', 'Winback'), ('birthday|anniversary', 'Lifecycle')))} AS flow_category, {_mail}
FROM feed_mail WHERE is_flow AND is_live AND NOT is_archived
""")

cte("k09", f"""
SELECT *, actual_transit_days <= estimated_transit_days AS is_on_time, invoiced_amount - quoted_rate AS cost_variance,
  actual_transit_days - estimated_transit_days AS transit_variance_days
FROM (
  SELECT shipment_id, {local("created")} AS created_at, CAST(pickup AS DATE) AS pickup_date, {local("delivered")} AS actual_delivery_at,
    CAST(delivered AS DATE) AS actual_delivery_date, CASE WHEN moving THEN 'in-transit' ELSE 'delivered' END AS status,
    CASE WHEN moving THEN 'moving' ELSE 'done' END AS tracking_status, carrier, service_type, estimated_transit_days, quoted_rate, invoiced_amount,
    coalesce(invoiced_amount, quoted_rate) AS shipping_cost, origin_city, origin_state, destination_city, destination_state,
    CAST(delivered AS DATE) - CAST(pickup AS DATE) AS actual_transit_days
  FROM feed_shipments)
""")

# --- orders and customers ------------------------------------------------------------

CATEGORIES = (("signature", "-S-|-7210-"), ("base", "-B-|-4805-"), ("craftsman", "-C-"), ("silvan", "-7-|-7T-"))
_sampled = ", ".join(
    f"coalesce(bool_or(line_item_type = 'Sample' AND regexp_matches(sku, '{p}')), false) AS s_{n}" for n, p in CATEGORIES
)
cte("line_sums", f"""
SELECT order_id, store, {", ".join(f"sum({c})::BIGINT AS {c}" for c in ("sample_quantity", "product_quantity", "accessories_quantity"))},
  sum(quantity)::BIGINT AS total_quantity, sum(sample_revenue) AS sample_revenue, sum(product_revenue) AS product_revenue,
  sum(accessories_revenue) AS accessories_revenue, sum(line_total) AS total_line_items_revenue, count(*) AS line_item_count,
  count(DISTINCT sku) AS distinct_sku_count, coalesce(sum(sample_quantity) FILTER (sample_type = 'Sample - Cut'), 0)::BIGINT AS cut_sample_quantity,
  coalesce(sum(sample_quantity) FILTER (sample_type = 'Sample - Plank'), 0)::BIGINT AS plank_sample_quantity,
  count(DISTINCT color) FILTER (sample_quantity > 0) AS sample_color_count, count(DISTINCT color) FILTER (product_quantity > 0) AS product_color_count,
  {_sampled}
FROM k02 GROUP BY order_id, store
""")
_zeros = (
    "sample_quantity product_quantity accessories_quantity total_quantity sample_revenue product_revenue accessories_revenue "
    "total_line_items_revenue line_item_count distinct_sku_count cut_sample_quantity plank_sample_quantity sample_color_count product_color_count"
).split()
_header = (
    "order_id email customer_id processed_at order_date order_year order_month order_quarter store product_price_threshold default_salesperson "
    "salesperson subtotal_price total_price total_discounts total_tax total_tip_received refund_subtotal refund_total_tax order_adjustment_amount "
    "order_name order_number note source_name financial_status fulfillment_status cancel_reason billing_state billing_state_code "
    "billing_address_city billing_address_zip billing_address_country billing_address_country_code shipping_state shipping_state_code "
    "shipping_address_city shipping_address_zip shipping_address_country shipping_address_country_code"
).split()
cte("k10", f"""
SELECT *, CASE WHEN is_product_order = 1 THEN 'Product Order' WHEN is_sample_order = 1 THEN 'Sample Order' WHEN is_accessory_only = 1 THEN 'Accessory Only' ELSE 'Other' END AS order_type,
  {flag('cut_sample_quantity > 0')} AS has_cut_samples, {flag('plank_sample_quantity > 0')} AS has_plank_samples,
  (subtotal_price - refund_subtotal)::DECIMAL(18,2) AS net_sales, {div('subtotal_price', 'line_item_count', _z)} AS avg_line_item_value,
  {div('subtotal_price', 'total_quantity', _z)} AS avg_unit_price, {div('total_discounts', 'subtotal_price', _z)} AS discount_rate,
  {div('total_discounts', 'distinct_sku_count', _z)} AS line_item_discount
FROM (
  SELECT *, {flag('product_quantity > 0 AND subtotal_price > 100000')} AS is_product_order, {flag('sample_quantity > 0 AND product_quantity = 0')} AS is_sample_order,
    {flag('accessories_quantity > 0 AND sample_quantity + product_quantity = 0')} AS is_accessory_only
  FROM (SELECT {", ".join(f"o.{c}" for c in _header)}, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _zeros)}, {", ".join(f"coalesce(s_{n}, false) AS s_{n}" for n, _ in CATEGORIES)}
    FROM k01 o LEFT JOIN line_sums USING (order_id, store)))
""")
K10_COLUMNS = _header + _zeros + (
    "order_type is_product_order is_sample_order is_accessory_only has_cut_samples has_plank_samples net_sales avg_line_item_value "
    "avg_unit_price discount_rate line_item_discount"
).split()

cte("k11", f"""
SELECT * EXCLUDE (s_signature, s_base, s_craftsman, s_silvan), {flag('order_sequence_number = 1')} AS is_first_order,
  {flag('product_order_sequence_number = 1 AND is_product_order = 1')} AS is_first_product_order,
  {flag('sample_order_sequence_number = 1 AND is_sample_order = 1')} AS is_first_sample_order,
  CAST(lifetime_total_revenue AS DOUBLE) / CAST(lifetime_total_orders AS DOUBLE) AS avg_order_value_to_date
FROM (
  SELECT *, (sum(is_product_order) OVER so_far)::BIGINT AS lifetime_product_orders, (sum(is_sample_order) OVER so_far)::BIGINT AS lifetime_sample_orders,
    count(*) OVER so_far AS lifetime_total_orders, sum(product_revenue) OVER so_far AS lifetime_product_revenue,
    sum(sample_revenue) OVER so_far AS lifetime_sample_revenue, sum(net_sales) OVER so_far AS lifetime_total_revenue,
    row_number() OVER so_far AS order_sequence_number,
    row_number() OVER (PARTITION BY email, is_product_order ORDER BY processed_at, order_id, store) AS product_order_sequence_number,
    row_number() OVER (PARTITION BY email, is_sample_order ORDER BY processed_at, order_id, store) AS sample_order_sequence_number,
    order_date - first_value(order_date) OVER so_far AS days_since_first_order
  FROM k10 WHERE email IS NOT NULL
  WINDOW so_far AS (PARTITION BY email ORDER BY processed_at, order_id, store ROWS UNBOUNDED PRECEDING))
""")

cte("k12_rows", """
SELECT order_id, email, processed_at, order_date, store, shipping_address_line1, shipping_address_line2, shipping_address_city, shipping_state,
  shipping_address_zip, shipping_address_country, normalized_address, normalized_zip, normalized_address || '|' || normalized_zip AS household_key
FROM (
  SELECT *, trim(regexp_replace(translate(lower(shipping_address_line1), '.,#-', ''), '\\s+', ' ', 'g')) AS normalized_address,
    CASE WHEN shipping_address_country = 'US' THEN regexp_replace(shipping_address_zip, '[^0-9]', '', 'g')[1:5]
      ELSE lower(regexp_replace(shipping_address_zip, '\\s+', '', 'g')) END AS normalized_zip
  FROM k01 WHERE shipping_address_line1 IS NOT NULL AND shipping_address_zip IS NOT NULL AND NOT contains(email, 'amazon'))
""")
cte("k12", "SELECT r.*, household_id FROM k12_rows r JOIN farm_ids ON k = household_key")

cte("funnel_orders", """
SELECT o.*, h.household_key AS house FROM k10 o LEFT JOIN k12 h USING (order_id, store) WHERE NOT contains(o.email, 'amazon')
""")


def _firsts(prefix):
    dates = ", ".join(
        f"min({c}) FILTER ({f} = 1) AS {prefix}first_{n}" for n, c, f in (
            ("sample_order_date", "order_date", "is_sample_order"), ("sample_order_timestamp", "processed_at", "is_sample_order"),
            ("product_order_date", "order_date", "is_product_order"), ("product_order_timestamp", "processed_at", "is_product_order"),
            ("cut_order_date", "order_date", "has_cut_samples"), ("plank_order_date", "order_date", "has_plank_samples"),
        )
    )
    return f"min(order_date) AS {prefix}first_order_date, {dates}, max(is_product_order) AS {prefix}has_ever_purchased_product"


def _windows(p):
    gap = f"{p}first_product_order_date - {p}first_sample_order_date"
    return (
        f"{gap} AS {p}days_to_order, {p}first_product_order_date - {p}first_cut_order_date AS {p}days_cut_to_order, "
        f"{p}first_product_order_date - {p}first_plank_order_date AS {p}days_plank_to_order, "
        f"{p}first_plank_order_date - {p}first_cut_order_date AS {p}days_cut_to_plank, "
        + ", ".join(f"{flag(f'{gap} <= {n}')} AS {p}converted_within_{n}d" for n in (15, 30, 60, 120))
        + f", {p}has_ever_purchased_product AS {p}conversion_ind"
    )


cte("funnel_email", f"SELECT *, {_windows('')} FROM (SELECT email, {_firsts('')} FROM funnel_orders GROUP BY email)")
cte("funnel_house", f"""
SELECT *, {_windows('household_')}
FROM (SELECT house, count(DISTINCT email) AS household_email_count, {_firsts('household_')} FROM funnel_orders WHERE house IS NOT NULL GROUP BY house)
""")
cte("funnel_home", """
SELECT email, house FROM funnel_orders WHERE house IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY email ORDER BY processed_at DESC, order_id DESC, store DESC) = 1
""")
cte("funnel_samples", """
SELECT email, concat_ws('+', CASE WHEN bool_or(s_base) THEN 'b' END, CASE WHEN bool_or(s_signature) THEN 's' END,
    CASE WHEN bool_or(s_craftsman) THEN 'c' END, CASE WHEN bool_or(s_silvan) THEN 'v' END) AS mix
FROM funnel_orders JOIN funnel_email USING (email)
WHERE is_sample_order = 1 AND (first_product_order_date IS NULL OR order_date < first_product_order_date) GROUP BY email
""")
cte("k13", f"""
SELECT e.*, h.* EXCLUDE (house), household_id, {flag('e.conversion_ind = 1 OR h.household_conversion_ind = 1')} AS hybrid_conversion_ind,
  CASE WHEN mix IS NULL THEN 'No Samples' WHEN mix = 'b' THEN 'Base Sample Only' WHEN mix = 's' THEN 'Signature Sample Only'
    WHEN mix = 'c' THEN 'Craftsman Sample Only' WHEN mix = 'v' THEN 'Silvan Sample Only' WHEN mix = 'b+s' THEN 'Base and Signature Sample Only'
    WHEN mix = 'b+c' THEN 'Base and Craftsman Sample Only' WHEN mix = 's+c' THEN 'Signature and Craftsman Sample Only'
    ELSE 'Mixed or Other' END AS sample_order_type, {month('first_sample_order_date')} AS cohort_month
FROM funnel_email e LEFT JOIN funnel_home USING (email) LEFT JOIN funnel_house h USING (house) LEFT JOIN farm_ids ON k = house LEFT JOIN funnel_samples USING (email)
""")

K17_COLUMNS = (
    "order_id email customer_id processed_at order_date order_year order_month order_quarter store salesperson order_type is_product_order "
    "is_sample_order is_accessory_only financial_status fulfillment_status cancel_reason subtotal_price total_price total_discounts total_tax "
    "net_sales refund_subtotal refund_total_tax order_adjustment_amount discount_rate line_item_discount sample_quantity product_quantity "
    "accessories_quantity total_quantity cut_sample_quantity plank_sample_quantity sample_revenue product_revenue accessories_revenue "
    "total_line_items_revenue line_item_count distinct_sku_count sample_color_count product_color_count has_cut_samples has_plank_samples "
    "shipping_state shipping_state_code shipping_address_city shipping_address_zip shipping_address_country billing_state billing_state_code "
    "lifetime_product_orders lifetime_sample_orders lifetime_total_orders lifetime_product_revenue lifetime_sample_revenue lifetime_total_revenue "
    "order_sequence_number product_order_sequence_number sample_order_sequence_number is_first_order is_first_product_order is_first_sample_order "
    "avg_order_value_to_date days_since_first_order"
)
cte("k17", f"""
SELECT {", ".join("o." + c for c in K17_COLUMNS.split())}, f.first_sample_order_date, f.first_product_order_date, f.days_to_order, f.sample_order_type,
  CASE WHEN is_first_product_order = 1 THEN 'New Customer' WHEN is_first_sample_order = 1 THEN 'New Customer Sample'
    WHEN is_sample_order = 1 AND order_date > f.first_sample_order_date THEN 'Returning Sample'
    WHEN is_product_order = 1 AND order_date > f.first_product_order_date THEN 'Returning Customer' ELSE 'Other' END AS customer_status,
  is_first_product_order AS is_new_customer, {flag('is_product_order = 1 AND order_date > f.first_product_order_date')} AS is_returning_customer
FROM k11 o LEFT JOIN k13 f USING (email)
""")

cte("k18", f"""
SELECT order_line_id, l.order_id, product_id, variant_id, l.store, sku, title, line_item_name, vendor, variant_title, line_item_type, sample_type, color,
  quantity, price, line_total, total_discount, l.sample_quantity, l.product_quantity, l.accessories_quantity, l.sample_revenue, l.product_revenue,
  l.accessories_revenue, is_gift_card, is_taxable, is_shipping_required, l.fulfillment_status, o.email, o.processed_at, o.order_date, o.order_year,
  o.order_month, o.order_quarter, o.salesperson, o.order_type, o.is_product_order, o.is_sample_order, o.customer_status, o.is_new_customer,
  o.is_returning_customer, o.first_sample_order_date, o.first_product_order_date, o.days_to_order, o.sample_order_type, o.lifetime_product_orders,
  o.lifetime_product_revenue, o.lifetime_total_orders, o.lifetime_total_revenue, o.shipping_state, o.shipping_state_code, o.shipping_address_city,
  {flag('is_product_order = 1 AND order_date > first_sample_order_date')} AS is_converted_purchase,
  CASE WHEN is_product_order = 1 THEN order_date - first_sample_order_date END AS days_from_sample_to_purchase
FROM k02 l JOIN k17 o USING (order_id, store)
""")

cte("k15", f"""
SELECT k18.*, o.cancel_reason, o.financial_status, {flag('o.cancel_reason IS NOT NULL')} AS is_cancelled,
  coalesce(s.product_line, CASE WHEN k18.sku[1:6] IN ('FL-MR-', 'SA-MR-') THEN 'Modin' WHEN k18.sku[1:6] IN ('FL-SR-', 'SA-SR-') THEN 'Silvan'
    WHEN k18.sku[1:6] IN ('FL-AR-', 'SA-AR-') THEN 'Arista' WHEN k18.sku[1:6] IN ('FL-PE-', 'SA-PE-') THEN 'Provenance'
    WHEN starts_with(k18.sku, 'AC-') THEN 'Accessories' ELSE 'Other' END) AS product_line,
  s.product_category, s.bevel, s.color_code, s.color_name,
  CASE s.product_line
    WHEN 'Modin' THEN CASE WHEN s.product_category = 'Signature' AND s.bevel IN ('Enhanced', 'Micro') THEN 'Signature ' || s.bevel ELSE s.product_category END
    WHEN 'Silvan' THEN CASE WHEN starts_with(s.product_category, '7') THEN '7"' WHEN starts_with(s.product_category, '6') OR s.product_category = 'Base' THEN '6"' ELSE s.product_category END
    ELSE s.product_category END AS wbr_product_subline,
  isoyear(k18.order_date)::INTEGER AS iso_year, week(k18.order_date)::INTEGER AS iso_week, {monday('k18.order_date')} AS iso_week_start
FROM k18 LEFT JOIN feed_lookup s ON k18.sku = s.sku JOIN k17 o ON k18.order_id = o.order_id AND k18.store = o.store
""")


def _mode(column, out, where="true"):
    return f"""(SELECT email, {column} AS {out} FROM (SELECT email, {column}, count(*) AS n FROM k17 WHERE {where} GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY email ORDER BY n DESC, {column} NULLS FIRST) = 1)"""


_located = "shipping_state IS NOT NULL"
_life = [f"lifetime_{k}_{w}" for k in ("product", "sample", "total") for w in ("orders", "revenue")]
cte("k16", f"""
SELECT c.email, customer_id, first_name, last_name, phone, customer_group, customer_type, account_state, is_verified_email, store AS source_store,
  primary_store, regular_order_count, commercial_order_count, created_at AS account_created_at, first_order_at AS shopify_first_order_at,
  most_recent_order_at AS shopify_most_recent_order_at, t.first_order_date, most_recent_order_date, f.first_sample_order_date, f.first_product_order_date,
  f.first_cut_order_date, f.first_plank_order_date, f.days_to_order, f.days_cut_to_order, f.days_plank_to_order, f.sample_order_type, f.cohort_month,
  f.conversion_ind, f.converted_within_15d, f.converted_within_30d, f.converted_within_60d, f.converted_within_120d,
  {", ".join(f"coalesce(t.{m}, 0) AS {m}" for m in _life)}, {div('t.lifetime_total_revenue', 't.lifetime_total_orders', _z)} AS average_order_value,
  {div('t.lifetime_product_revenue', 't.lifetime_product_orders', _z)} AS average_product_order_value,
  DATE '2001-12-31' - most_recent_order_date AS days_since_last_order, DATE '2001-12-31' - t.first_order_date AS customer_tenure_days,
  primary_shipping_state, primary_shipping_state_code, primary_shipping_city, marketing_consent_state, marketing_opt_in_level,
  lifetime_count_orders AS shopify_lifetime_orders, lifetime_total_spent AS shopify_lifetime_spent, lifetime_total_refunded AS shopify_lifetime_refunded,
  avg_order_value AS shopify_avg_order_value, {flag('t.lifetime_product_orders > 0')} AS has_purchased_product,
  {flag('t.lifetime_sample_orders > 0')} AS has_ordered_samples, {flag('t.lifetime_product_orders > 1')} AS is_repeat_product_customer,
  CASE WHEN t.lifetime_product_revenue >= 400000 THEN 'High Value' WHEN t.lifetime_product_revenue >= 200000 THEN 'Medium Value'
    WHEN t.lifetime_product_revenue >= 60000 THEN 'Low Value' WHEN t.lifetime_sample_orders > 0 AND t.lifetime_product_orders = 0 THEN 'Sample Only'
    ELSE 'No Purchase' END AS customer_segment
FROM k03 c LEFT JOIN k13 f USING (email)
LEFT JOIN (SELECT email, {", ".join(f"max({m}) AS {m}" for m in _life)}, min(order_date) AS first_order_date, max(order_date) AS most_recent_order_date,
    count(DISTINCT order_id) FILTER (store = 'regular') AS regular_order_count, count(DISTINCT order_id) FILTER (store = 'commercial') AS commercial_order_count
  FROM k17 GROUP BY email) t USING (email)
LEFT JOIN {_mode('shipping_state', 'primary_shipping_state', _located)} USING (email)
LEFT JOIN {_mode('shipping_state_code', 'primary_shipping_state_code', _located)} USING (email)
LEFT JOIN {_mode('shipping_address_city', 'primary_shipping_city', _located)} USING (email)
LEFT JOIN {_mode('store', 'primary_store')} USING (email)
""")

# --- marts -----------------------------------------------------------------------------


def _bucket(days):
    return arms([(f"{days} IS NULL", "'No Conversion'"), (f"{days} <= 15", "'0-15 days'"), (f"{days} <= 30", "'16-30 days'"),
                 (f"{days} <= 60", "'31-60 days'"), (f"{days} <= 120", "'61-120 days'")], "'120+ days'")


_first_cols = ("order_id", "store", "salesperson", "quantity", "revenue", "shipping_state", "shipping_state_code")
_picks = ", ".join(
    f"max({k + '_' + c if c in ('quantity', 'revenue') else c}) FILTER (is_first_{k}_order = 1) AS first_{k}_{c}"
    for k in ("sample", "product") for c in _first_cols
)
_within = ", ".join(f"count(DISTINCT order_id) FILTER (order_date - first_sample_order_date <= {n}) AS product_orders_within_{n}d" for n in (15, 30, 60, 120))
_hyb = "CASE WHEN hybrid_conversion_ind = 1 THEN least(coalesce(f.days_to_order, 999999), coalesce(household_days_to_order, 999999)) END"
cte("k19", f"""
SELECT f.* EXCLUDE (first_sample_order_timestamp, first_product_order_timestamp, has_ever_purchased_product, household_first_sample_order_timestamp,
    household_first_product_order_timestamp, household_has_ever_purchased_product), a.* EXCLUDE (email),
  {", ".join(f"coalesce(product_orders_within_{n}d, 0) AS product_orders_within_{n}d" for n in (15, 30, 60, 120))},
  coalesce(product_revenue_within_60d, 0) AS product_revenue_within_60d,
  c.customer_group, c.customer_type, c.primary_shipping_state, c.primary_store, c.lifetime_product_orders, c.lifetime_sample_orders,
  c.lifetime_product_revenue, c.lifetime_sample_revenue, c.lifetime_total_revenue, c.customer_segment,
  CASE WHEN first_product_revenue IS NOT NULL THEN {div('first_product_revenue', 'first_sample_revenue')} END AS sample_to_product_revenue_ratio,
  {_bucket('f.days_to_order')} AS conversion_window_bucket, {_bucket('household_days_to_order')} AS household_conversion_window_bucket,
  {_bucket(_hyb)} AS hybrid_conversion_window_bucket
FROM k13 f JOIN k16 c USING (email)
LEFT JOIN (SELECT email, {_picks} FROM k17 WHERE is_first_sample_order = 1 OR is_first_product_order = 1 GROUP BY email) a USING (email)
LEFT JOIN (SELECT email, {_within}, coalesce(sum(product_revenue) FILTER (order_date - first_sample_order_date <= 60), 0) AS product_revenue_within_60d
  FROM k17 WHERE is_product_order = 1 AND first_sample_order_date IS NOT NULL GROUP BY email) USING (email)
WHERE f.first_sample_order_date IS NOT NULL
""")


def _cal(day, prefix=""):
    return (
        f"year({day})::INTEGER AS {prefix}year, month({day})::INTEGER AS {prefix}month, quarter({day})::INTEGER AS {prefix}quarter, "
        f"{sunday(day)} AS {prefix}week_start_date, {month(day)} AS {prefix}month_start_date"
    )


cte("k25", f"""
SELECT *, {_cal('date_day')}, {div('conversions_value', 'conversions', _z)} AS revenue_per_conversion, {div('conversions', 'clicks', _z)} AS click_conversion_rate
FROM (SELECT date_day, channel, campaign_id, campaign_name, ad_set_name, ad_name, clicks, impressions, spend, conversions, conversions_value, ctr, cpc, roas, cpa FROM k05
  UNION ALL SELECT date_day, channel, campaign_id, campaign_name, NULL, NULL, clicks, impressions, spend, conversions, conversions_value, ctr, cpc, roas, cpa FROM k06)
""")
cte("ad_days", """
SELECT date_day, sum(spend) AS total_ad_spend, coalesce(sum(spend) FILTER (channel = 'Facebook'), 0) AS facebook_spend,
  coalesce(sum(spend) FILTER (channel = 'Google'), 0) AS google_spend, sum(conversions) AS total_ad_conversions,
  sum(conversions_value) AS total_ad_conversion_value, sum(clicks)::BIGINT AS total_ad_clicks, sum(impressions)::BIGINT AS total_ad_impressions
FROM k25 GROUP BY date_day
""")
_adcols = "total_ad_spend facebook_spend google_spend total_ad_conversions total_ad_conversion_value total_ad_clicks total_ad_impressions".split()
cte("k20", f"""
SELECT *, {_cal('date_day')}, (dayofweek(date_day) + 1)::INTEGER AS day_of_week, dayname(date_day) AS day_name, {ratio('total_ad_spend', 'new_customers', otherwise=_z)} AS cac,
  {ratio('total_revenue', 'total_ad_spend', otherwise=_z)} AS roas, {pct('product_orders', 'total_orders', _z)} AS product_order_rate,
  {pct('new_customers', 'total_customers', _z)} AS new_customer_rate, total_revenue - total_ad_spend AS contribution_margin_excl_cogs
FROM (
  SELECT d.*, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _adcols)}
  FROM (SELECT order_date AS date_day, store, count(DISTINCT order_id) AS total_orders, sum(is_product_order)::BIGINT AS product_orders,
      sum(is_sample_order)::BIGINT AS sample_orders, sum(is_accessory_only)::BIGINT AS accessory_orders, count(DISTINCT email) AS total_customers,
      count(DISTINCT email) FILTER (is_new_customer = 1) AS new_customers, count(DISTINCT email) FILTER (is_returning_customer = 1) AS returning_customers,
      sum(net_sales) AS total_revenue, coalesce(sum(net_sales) FILTER (is_product_order = 1), 0) AS product_revenue,
      coalesce(sum(net_sales) FILTER (is_sample_order = 1), 0) AS sample_revenue, sum(total_discounts) AS total_discounts,
      sum(product_quantity)::BIGINT AS total_product_quantity, sum(sample_quantity)::BIGINT AS total_sample_quantity,
      sum(accessories_quantity)::BIGINT AS total_accessories_quantity, CAST(sum(net_sales) AS DOUBLE) / count(net_sales) AS average_order_value,
      CAST(sum(net_sales) FILTER (is_product_order = 1) AS DOUBLE) / count(net_sales) FILTER (is_product_order = 1) AS average_product_order_value
    FROM k17 GROUP BY order_date, store) d
  LEFT JOIN ad_days USING (date_day))
""")

cte("k21", f"""
SELECT *, year(week_start_date)::INTEGER AS year, month(week_start_date)::INTEGER AS month, quarter(week_start_date)::INTEGER AS quarter, {month('week_start_date')} AS month_start_date,
  {ratio('total_revenue', 'order_count', otherwise=_z)} AS revenue_per_order, {ratio('total_revenue', 'unique_customers', otherwise=_z)} AS revenue_per_customer,
  {ratio('total_revenue', 'total_quantity', otherwise=_z)} AS revenue_per_unit, {pct('total_discount', 'total_revenue', _z)} AS discount_rate,
  {pct('converted_purchases', 'line_item_count', _z)} AS conversion_rate
FROM (SELECT {sunday('order_date')} AS week_start_date, sku, title, color, line_item_type, store, count(DISTINCT order_id) AS order_count,
    sum(quantity)::BIGINT AS total_quantity, count(DISTINCT order_line_id) AS line_item_count, sum(line_total) AS total_revenue,
    CAST(sum(price) AS DOUBLE) / count(price) AS average_price, sum(total_discount) AS total_discount, count(DISTINCT email) AS unique_customers,
    count(DISTINCT email) FILTER (is_new_customer = 1) AS new_customers, count(DISTINCT email) FILTER (is_returning_customer = 1) AS returning_customers,
    sum(is_converted_purchase)::BIGINT AS converted_purchases,
    CASE WHEN count(days_from_sample_to_purchase) > 0 THEN CAST(sum(days_from_sample_to_purchase) AS DOUBLE) / count(days_from_sample_to_purchase) END AS avg_days_from_sample
  FROM k18 GROUP BY ALL)
""")

cte("cohort_base", f"SELECT email, {month('first_product_order_date')} AS cohort_month, primary_store FROM k16 WHERE first_product_order_date IS NOT NULL")
cte("k22", f"""
SELECT m.* EXCLUDE (value), cohort_size, {pct('active_customers', 'cohort_size', _z)} AS retention_rate, value AS cohort_revenue,
  {ratio('value', 'active_customers', otherwise=_z)} AS avg_revenue_per_active_customer, {ratio('value', 'cohort_size', otherwise=_z)} AS avg_revenue_per_cohort_customer,
  sum(value) OVER (PARTITION BY cohort_month, primary_store ORDER BY months_since_first_order ROWS UNBOUNDED PRECEDING) AS cumulative_ltv,
  CAST(cohort_month + to_months(months_since_first_order) AS DATE) AS calendar_month
FROM (
  SELECT cohort_month, primary_store, months_since_first_order, count(DISTINCT email) AS active_customers, sum(n)::BIGINT AS total_orders, sum(value) AS value
  FROM (SELECT email, cohort_month, primary_store, datediff('month', cohort_month, {month('order_date')})::INTEGER AS months_since_first_order,
      count(DISTINCT order_id) AS n, sum(net_sales) AS value
    FROM cohort_base JOIN k17 USING (email) WHERE order_type = 'Product Order' GROUP BY ALL)
  GROUP BY ALL) m
JOIN (SELECT cohort_month, primary_store, count(DISTINCT email) AS cohort_size FROM cohort_base GROUP BY ALL) USING (cohort_month, primary_store)
""")

cte("k23", f"""
SELECT *, {pct('discount_amount', 'gross_revenue', _z)} AS discount_rate_pct, net_sales - allocated_ad_spend AS contribution_margin_before_cogs,
  {pct('(net_sales - allocated_ad_spend)', 'net_sales', _z)} AS contribution_margin_pct, {pct('allocated_ad_spend', 'net_sales', _z)} AS ad_spend_pct
FROM (
  SELECT o.order_id, o.email, o.order_date, o.store, order_type, customer_status, salesperson, shipping_state, shipping_address_country,
    subtotal_price AS gross_revenue, o.total_discounts AS discount_amount, subtotal_price - o.total_discounts AS net_sales, lifetime_product_revenue,
    CAST(CASE WHEN customer_status IN ('New Customer', 'New Customer Sample') THEN coalesce({ratio('total_ad_spend', 'new_customers')}, 0) ELSE 0 END AS DECIMAL(18,2)) AS allocated_ad_spend
  FROM k17 o LEFT JOIN k20 d ON d.date_day = o.order_date AND d.store = o.store WHERE order_type = 'Product Order')
""")

_s = "PARTITION BY store, sku ORDER BY date_day, line_item_type, color"
_avg = ", ".join(
    f"CAST(sum(quantity_sold) OVER ({_s} ROWS {n - 1} PRECEDING) AS DOUBLE) / count(*) OVER ({_s} ROWS {n - 1} PRECEDING) AS quantity_sold_avg_{n}d"
    for n in (7, 28, 90)
)
cte("k24", f"""
SELECT * EXCLUDE (sum_28, rows_28), {pct('(quantity_sold - quantity_sold_lag_7d)', 'quantity_sold_lag_7d')} AS quantity_change_pct_7d,
  {ratio('(quantity_sold * rows_28)', 'sum_28')} AS seasonality_index_28d, round(quantity_sold_stddev_28d / quantity_sold_avg_28d, 2) AS demand_volatility_cv
FROM (
  SELECT s.*, (dayofweek(date_day) + 1)::INTEGER AS day_of_week, day(date_day)::INTEGER AS day_of_month, strftime(date_day, '%U')::INTEGER AS week_of_year,
    month(date_day)::INTEGER AS month_of_year, quarter(date_day)::INTEGER AS quarter_of_year, year(date_day)::INTEGER AS year, dayofyear(date_day)::INTEGER AS day_of_year,
    {flag('dayofweek(date_day) IN (0, 6)')} AS is_weekend, {flag('day(date_day) = 1')} AS is_month_start, {flag('day(date_day + 1) = 1')} AS is_month_end,
    CASE strftime(date_day, '%m%d') WHEN '0101' THEN 'New Years' WHEN '0704' THEN 'July 4th' WHEN '1225' THEN 'Christmas'
      ELSE CASE WHEN month(date_day) = 11 THEN CASE WHEN dayname(date_day) = 'Thursday' AND day(date_day) BETWEEN 22 AND 28 THEN 'Thanksgiving'
        WHEN dayname(date_day) = 'Friday' AND day(date_day) BETWEEN 23 AND 29 THEN 'Black Friday'
        WHEN dayname(date_day) = 'Monday' AND day(date_day) >= 25 THEN 'Cyber Monday' END END END AS holiday_name,
    {flag("month(date_day) IN (1, 7, 11, 12) AND (day(date_day) IN (1, 4, 25) OR (month(date_day) = 11 AND day(date_day) BETWEEN 22 AND 29))")} AS is_holiday_week,
    {", ".join(f"lag(quantity_sold, {n}) OVER ({_s}) AS quantity_sold_lag_{n}d" for n in (7, 14, 28))}, {_avg},
    sum(quantity_sold) OVER ({_s} ROWS 27 PRECEDING) AS sum_28, count(*) OVER ({_s} ROWS 27 PRECEDING) AS rows_28,
    stddev_samp(quantity_sold) OVER ({_s} ROWS 27 PRECEDING) AS quantity_sold_stddev_28d,
    date_day - min(date_day) OVER (PARTITION BY store, sku) AS days_since_first_sale, date_day - lag(date_day) OVER ({_s}) AS days_since_last_sale,
    coalesce(total_ad_spend, 0) AS daily_ad_spend, coalesce(new_customers, 0) AS daily_new_customers
  FROM (SELECT order_date AS date_day, store, sku, line_item_type, color, sum(quantity)::BIGINT AS quantity_sold, sum(line_total) AS revenue,
      count(DISTINCT order_id) AS order_count, count(DISTINCT email) AS unique_customers, CAST(sum(price) AS DOUBLE) / count(price) AS avg_unit_price
    FROM k18 WHERE line_item_type = 'Product' AND order_type = 'Product Order' AND sku IS NOT NULL GROUP BY ALL) s
  LEFT JOIN (SELECT date_day, store, total_ad_spend, new_customers FROM k20) USING (date_day, store))
""")

_mailcols = (
    "recipients, received, opened, clicked, converters, orders, revenue, net_revenue, open_rate, click_rate, click_to_open_rate, conversion_rate, "
    "revenue_per_converter, revenue_per_recipient, average_order_value, unsubscribed, unsubscribe_rate, bounced, bounce_rate, marked_spam, channel"
)
cte("k26", f"""
SELECT *, {_cal('sent_date', 'sent_')}
FROM (SELECT campaign_id AS email_id, 'Campaign' AS email_type, campaign_name AS email_name, campaign_category AS email_category, sent_at,
    CAST(sent_at AS DATE) AS sent_date, subject, from_email, from_name, {_mailcols} FROM k07
  UNION ALL SELECT flow_id, 'Flow', flow_name, flow_category, NULL, NULL, NULL, NULL, NULL, {_mailcols} FROM k08)
""")

_stages = ("homepage", "plp", "pdp", "add_to_cart", "begin_checkout", "purchase")
_names = ("Homepage", "Product List", "Product Detail", "Add to Cart", "Begin Checkout", "Purchase")
_pages = ", ".join(
    "max(" + flag(f"page_type = '{p}'") + f") AS reached_{n}, count(*) FILTER (page_type = '{p}') AS {n}_views"
    for n, p in (("homepage", "homepage"), ("plp", "product_list"), ("pdp", "product_detail"))
)
cte("k14", f"""
SELECT *, list_max([{", ".join(f"reached_{s} * {i}" for i, s in enumerate(_stages, 1))}]) AS funnel_stage_depth,
  ['Other', {", ".join(f"'{n}'" for n in _names)}][list_max([{", ".join(f"reached_{s} * {i}" for i, s in enumerate(_stages, 1))}]) + 1] AS deepest_funnel_stage,
  reached_purchase AS is_converted_session, datesub('minute', session_start_time, session_end_time) AS session_duration_minutes,
  {", ".join(f"reached_{a} * (1 - reached_{b}) AS dropped_at_{n}" for a, b, n in zip(_stages, _stages[1:], ("homepage", "plp", "pdp", "cart", "checkout")))},
  CAST(session_start_time AS DATE) AS session_date
FROM (SELECT user_pseudo_id, ga_session_id, min(event_timestamp_pt) AS session_start_time, max(event_timestamp_pt) AS session_end_time,
    {_pages},
    {", ".join(f"max(is_{s}) AS reached_{s}, sum(is_{s})::BIGINT AS {s}_events" for s in _stages[3:])},
    max(transaction_id) FILTER (is_purchase = 1) AS transaction_id, max(transaction_value) FILTER (is_purchase = 1) AS transaction_value,
    count(*) AS total_events, count(DISTINCT event_name) AS unique_event_types
  FROM k04_full WHERE user_pseudo_id IS NOT NULL AND ga_session_id IS NOT NULL GROUP BY ALL)
""")

_r = ("homepage", "plp", "pdp", "cart", "checkout", "purchase")
cte("k27", f"""
SELECT * EXCLUDE (value, mins, evs, pdps), CAST(round(value, 2) AS DECIMAL(18,2)) AS total_revenue, {ratio('value', 'converted_sessions', otherwise=_z)} AS avg_order_value,
  {", ".join(f"{pct(f'sessions_reached_{b}', f'sessions_reached_{a}', _z)} AS {a}_to_{b}_rate" for a, b in zip(_r, _r[1:]))},
  {pct('converted_sessions', 'total_sessions', _z)} AS overall_conversion_rate,
  {", ".join(f"{pct(f'sessions_dropped_at_{d}', f'sessions_reached_{d}', _z)} AS {d}_dropoff_rate" for d in _r[:-1])},
  {ratio('mins', 'total_sessions')} AS avg_session_duration_minutes, {ratio('evs', 'total_sessions')} AS avg_events_per_session,
  {ratio('pdps', 'total_sessions')} AS avg_pdp_views_per_session
FROM (SELECT session_date, deepest_funnel_stage, funnel_stage_depth, count(*) AS total_sessions, count(DISTINCT user_pseudo_id) AS unique_users,
    {", ".join(f"sum(reached_{s})::BIGINT AS sessions_reached_{r}" for s, r in zip(_stages, _r))},
    {", ".join(f"sum(dropped_at_{d})::BIGINT AS sessions_dropped_at_{d}" for d in _r[:-1])}, sum(is_converted_session)::BIGINT AS converted_sessions,
    sum(CAST(transaction_value AS DECIMAL(24,6))) AS value, sum(session_duration_minutes) AS mins, sum(total_events) AS evs, sum(pdp_views) AS pdps
  FROM k14 GROUP BY ALL)
""")

cte("k28", f"""
SELECT *, {_cal('pickup_date', 'pickup_')}, {flag('is_on_time')} AS on_time_delivery_count, {flag('NOT is_on_time')} AS late_delivery_count,
  {flag('cost_variance > 0')} AS over_budget_count, {flag('cost_variance < 0')} AS under_budget_count FROM k09
""")

# --- weekly reports ----------------------------------------------------------------------

_iso = f"isoyear(order_date)::INTEGER AS iso_year, week(order_date)::INTEGER AS iso_week, {monday('order_date')} AS week_start"
cte("k29", f"""
SELECT c.*, total_net_sales, total_orders, {safe('channel_net_sales', 'total_net_sales')} AS pct_of_total,
  lag(channel_net_sales) OVER w AS prev_week_channel_sales, {change('channel_net_sales', 'lag(channel_net_sales) OVER w')} AS wow_change_pct
FROM (SELECT iso_year, iso_week, week_start, wbr_channel, sum(net_sales) AS channel_net_sales, count(DISTINCT order_id) AS channel_orders FROM channel_orders_base GROUP BY ALL) c
JOIN (SELECT iso_year, iso_week, sum(net_sales) AS total_net_sales, count(DISTINCT order_id) AS total_orders FROM channel_orders_base GROUP BY ALL) USING (iso_year, iso_week)
WINDOW w AS (PARTITION BY wbr_channel ORDER BY week_start)
""")
cte("channel_orders_base", f"""
SELECT order_id, net_sales, {_iso}, CASE WHEN store = 'commercial' THEN 'Comm.' WHEN salesperson = 'DTC' THEN 'DTC'
  WHEN regexp_matches(lower(salesperson), 'msr|installer|multi') THEN 'MSR' ELSE 'Ind. Retail' END AS wbr_channel
FROM k17 WHERE cancel_reason IS NULL
""")

cte("sales_weeks", f"""
SELECT {_iso}, sum(net_sales) AS net_sales, count(DISTINCT order_id) AS total_orders, count(DISTINCT email) AS unique_customers
FROM k17 WHERE cancel_reason IS NULL GROUP BY ALL
""")
cte("k30", f"""
SELECT 'weekly' AS grain, a.iso_year, a.iso_week, a.week_start AS period_start, NULL::DATE AS month_start, a.net_sales, a.total_orders, a.unique_customers,
  lag(a.net_sales) OVER w AS prev_week_net_sales, {change('a.net_sales', 'lag(a.net_sales) OVER w')} AS wow_change_pct,
  b.net_sales AS prior_year_net_sales, {change('a.net_sales', 'b.net_sales')} AS yoy_change_pct
FROM sales_weeks a LEFT JOIN sales_weeks b ON b.iso_week = a.iso_week AND b.iso_year = a.iso_year - 1 WINDOW w AS (ORDER BY a.week_start)
UNION ALL
SELECT 'monthly', year(month_start)::INTEGER, NULL, NULL, month_start, net_sales, total_orders, unique_customers, NULL, NULL, NULL, NULL
FROM (SELECT {month('order_date')} AS month_start, sum(net_sales) AS net_sales, count(DISTINCT order_id) AS total_orders, count(DISTINCT email) AS unique_customers
  FROM k17 WHERE cancel_reason IS NULL GROUP BY ALL)
""")

cte("sold_lines", "SELECT *, iso_week_start AS week_start FROM k15 WHERE line_item_type = 'Product' AND is_cancelled = 0 AND store = 'regular'")
_sold = "sum(line_total) AS revenue, count(DISTINCT order_id) AS order_count, sum(quantity)::BIGINT AS units_sold"
_perf = f"""{safe('revenue', 'total_revenue')} AS pct_of_total, lag(revenue) OVER w AS prev_week_revenue, revenue - lag(revenue) OVER w AS wow_change_dollars,
  {change('revenue', 'lag(revenue) OVER w')} AS wow_change_pct, sum(revenue) OVER (w ROWS 5 PRECEDING) AS t6w_revenue"""
cte("line_weeks", f"SELECT iso_year, iso_week, week_start, product_line, {_sold} FROM sold_lines GROUP BY ALL")
cte("k31", f"""
SELECT 'product_line' AS grain, a.iso_year, a.iso_week, week_start, product_line, NULL::VARCHAR AS wbr_product_subline, revenue, order_count, units_sold, total_revenue, {_perf}
FROM line_weeks a JOIN (SELECT iso_year, iso_week, sum(revenue) AS total_revenue FROM line_weeks GROUP BY ALL) USING (iso_year, iso_week)
WINDOW w AS (PARTITION BY product_line ORDER BY week_start)
UNION ALL
SELECT 'subline', iso_year, iso_week, week_start, product_line, wbr_product_subline, revenue, order_count, units_sold, total_revenue, {_perf}
FROM (SELECT s.*, p.revenue AS total_revenue FROM (SELECT iso_year, iso_week, week_start, product_line, wbr_product_subline, {_sold} FROM sold_lines GROUP BY ALL) s
  JOIN line_weeks p ON p.iso_year = s.iso_year AND p.iso_week = s.iso_week AND p.product_line = s.product_line)
WINDOW w AS (PARTITION BY product_line, wbr_product_subline ORDER BY week_start)
""")


def _rk(column):
    return f"row_number() OVER (PARTITION BY iso_year, iso_week ORDER BY {column} DESC NULLS LAST, sku, product_line, {{}} NULLS FIRST)"


_sub = "wbr_product_subline"
cte("sku_weeks", f"""
SELECT *, {_rk('net_dollars').format(_sub)} AS weekly_rank
FROM (SELECT iso_year, iso_week, week_start, sku, product_line, wbr_product_subline, sum(line_total) AS net_dollars, count(DISTINCT order_id) AS order_count,
  sum(quantity)::BIGINT AS units_sold FROM sold_lines GROUP BY ALL)
""")
cte("sku_rolled", f"""
SELECT *, lag(net_dollars) OVER w AS prev_week_net_dollars, lag(order_count) OVER w AS prev_week_orders, net_dollars - lag(net_dollars) OVER w AS wow_delta_dollars,
  {change('net_dollars', 'lag(net_dollars) OVER w')} AS wow_change_pct, lag(weekly_rank) OVER w AS prev_week_rank,
  sum(net_dollars) OVER (w ROWS 5 PRECEDING) AS t6w_net_dollars, (sum(order_count) OVER (w ROWS 5 PRECEDING))::BIGINT AS t6w_orders,
  sum(net_dollars) OVER (w ROWS BETWEEN 11 PRECEDING AND 6 PRECEDING) AS p6w_net_dollars,
  (sum(order_count) OVER (w ROWS BETWEEN 11 PRECEDING AND 6 PRECEDING))::BIGINT AS p6w_orders, count(*) OVER (w ROWS 5 PRECEDING) AS t6w_week_count
FROM sku_weeks WINDOW w AS (PARTITION BY sku ORDER BY week_start, product_line, wbr_product_subline NULLS FIRST)
""")
_moved = change("t6w_net_dollars", "p6w_net_dollars")
cte("k32", f"""
SELECT r.*, t6w_net_dollars - p6w_net_dollars AS t6w_delta_dollars, {_moved} AS t6w_change_pct, {_rk('t6w_net_dollars').format(_sub)} AS t6w_rank,
  {_rk('p6w_net_dollars').format(_sub)} AS p6w_rank, dtc_benchmark_pct, {_moved} - dtc_benchmark_pct AS delta_vs_dtc_pct
FROM sku_rolled r JOIN (SELECT iso_year, iso_week, {change('sum(t6w_net_dollars)', 'sum(p6w_net_dollars)')} AS dtc_benchmark_pct FROM sku_rolled GROUP BY ALL) USING (iso_year, iso_week)
""")

cte("sampled_lines", "SELECT *, iso_week_start AS week_start FROM k15 WHERE line_item_type = 'Sample' AND is_cancelled = 0")
cte("sample_weeks", f"""
SELECT coalesce(a.iso_year, b.iso_year) AS iso_year, coalesce(a.iso_week, b.iso_week) AS iso_week, coalesce(a.week_start, b.week_start) AS week_start,
  coalesce(sample_order_count, 0) AS sample_order_count, coalesce(sample_sku_count, 0) AS sample_sku_count
FROM (SELECT {_iso}, count(DISTINCT order_id) AS sample_order_count FROM k17 WHERE is_sample_order = 1 AND cancel_reason IS NULL GROUP BY ALL) a
FULL JOIN (SELECT iso_year, iso_week, week_start, sum(quantity)::BIGINT AS sample_sku_count FROM sampled_lines GROUP BY ALL) b ON a.week_start = b.week_start
""")
cte("k33", f"""
SELECT 'weekly' AS grain, a.iso_year, a.iso_week, a.week_start AS period_start, NULL::DATE AS month_start, a.sample_order_count, a.sample_sku_count,
  {safe('a.sample_sku_count', 'a.sample_order_count')} AS skus_per_order, lag(a.sample_order_count) OVER w AS prev_week_sample_orders,
  {change('a.sample_order_count', 'lag(a.sample_order_count) OVER w')} AS sample_orders_wow_pct, lag(a.sample_sku_count) OVER w AS prev_week_sample_skus,
  {change('a.sample_sku_count', 'lag(a.sample_sku_count) OVER w')} AS sample_skus_wow_pct, b.sample_order_count AS prior_year_sample_orders,
  {change('a.sample_order_count', 'b.sample_order_count')} AS sample_orders_yoy_pct, b.sample_sku_count AS prior_year_sample_skus,
  {change('a.sample_sku_count', 'b.sample_sku_count')} AS sample_skus_yoy_pct
FROM sample_weeks a LEFT JOIN sample_weeks b ON b.iso_week = a.iso_week AND b.iso_year = a.iso_year - 1 WINDOW w AS (ORDER BY a.week_start)
UNION ALL
SELECT 'monthly', year(month_start)::INTEGER, NULL, NULL, month_start, sample_order_count, coalesce(sample_sku_count, 0),
  {safe('coalesce(sample_sku_count, 0)', 'sample_order_count')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM (SELECT {month('order_date')} AS month_start, count(DISTINCT order_id) AS sample_order_count FROM k17 WHERE is_sample_order = 1 AND cancel_reason IS NULL GROUP BY ALL)
LEFT JOIN (SELECT {month('order_date')} AS month_start, sum(quantity)::BIGINT AS sample_sku_count FROM sampled_lines GROUP BY ALL) USING (month_start)
""")

_rs = "row_number() OVER (PARTITION BY iso_year, iso_week ORDER BY {} DESC NULLS LAST, sku, product_line)".format
cte("k34", f"""
SELECT *, t6w_qty - p6w_qty AS t6w_delta, {_rs('t6w_qty')} AS t6w_rank, {_rs('p6w_qty')} AS p6w_rank
FROM (SELECT *, lag(qty_ordered) OVER w AS prev_week_qty, lag(weekly_rank) OVER w AS prev_week_rank, qty_ordered - lag(qty_ordered) OVER w AS wow_delta,
    (sum(qty_ordered) OVER (w ROWS 5 PRECEDING))::BIGINT AS t6w_qty, (sum(qty_ordered) OVER (w ROWS BETWEEN 11 PRECEDING AND 6 PRECEDING))::BIGINT AS p6w_qty
  FROM (SELECT *, {_rs('qty_ordered')} AS weekly_rank FROM (SELECT iso_year, iso_week, week_start, sku, product_line, sum(quantity)::BIGINT AS qty_ordered,
      count(DISTINCT order_id) AS order_count FROM sampled_lines GROUP BY ALL))
  WINDOW w AS (PARTITION BY sku ORDER BY week_start, product_line))
""")

cte("launch_days", """
SELECT order_date, sku, product_line, color_code, color_name, CASE WHEN contains(sku, '75') THEN '7.5"' WHEN contains(sku, '105') THEN '10"' ELSE 'Unknown' END AS size_variant,
  count(*) AS sample_line_count, sum(quantity)::BIGINT AS qty_ordered, count(DISTINCT order_id) AS order_count
FROM sampled_lines WHERE product_line = 'Provenance' GROUP BY ALL
""")
cte("k35", """
SELECT *, (sum(sample_line_count) OVER (PARTITION BY order_date, size_variant))::BIGINT AS size_daily_total,
  (sum(sample_line_count) OVER (PARTITION BY order_date))::BIGINT AS daily_grand_total,
  (sum(sample_line_count) OVER (PARTITION BY sku ORDER BY order_date))::BIGINT AS sku_cumulative,
  (sum(sample_line_count) OVER (PARTITION BY size_variant ORDER BY order_date))::BIGINT AS size_cumulative
FROM launch_days
""")
