"""The feeds of `shoploom.sources.sample_shop` in SQL."""

from oracle.sql import cte

_money = "CAST({} AS DECIMAL(18,2))".format


def _share(amount: str, factor: str) -> str:
    return f"CAST(round({amount} * CAST({factor} AS DECIMAL(6,3)), 2) AS DECIMAL(18,2))"


def _email(key: str) -> str:
    return (
        f"CASE WHEN {key} % 97 <> 0 THEN 'Cust' || {key} || "
        f"CASE WHEN {key} % 50 = 0 THEN '@amazon.com' ELSE '@Example.com' END END"
    )


def _store(key: str) -> str:
    return f"CASE WHEN {key} % 5 = 0 THEN 'commercial' ELSE 'regular' END"


_sub = _money("o_totalprice")
_refund = (
    f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 400 = 0 THEN {_share(_sub, '1.2')} "
    f"WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN {_share(_sub, '0.1')} END"
)

cte("feed_orders", f"""
SELECT o_orderkey AS order_id, {_store('o_orderkey')} AS store, o_custkey AS customer_id, {_email('o_custkey')} AS email,
  o_orderdate + to_hours(o_orderkey % 24) AS placed, copy, {_sub} AS subtotal, {_share(_sub, '0.08')} AS tax,
  CASE WHEN o_orderstatus = 'F' THEN {_share(_sub, '0.05')} ELSE 0.00::DECIMAL(18,2) END AS discounts, {_refund} AS refund,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN 'customer' END AS cancel, o_orderstatus,
  CASE WHEN o_custkey % 41 <> 0 THEN (o_custkey % 300) || [' Main St.', ' main st', ' Main  Street', ' North main st, Suite #2'][o_custkey % 4 + 1] END AS street,
  CASE WHEN o_custkey % 41 <> 0 THEN (c_nationkey + 90000) || CASE WHEN o_custkey % 2 = 1 THEN '-1234' ELSE '' END END AS zip,
  CASE WHEN c_nationkey < 20 THEN 'US' ELSE 'CA' END AS country,
  CASE WHEN o_orderkey % 17 <> 0 THEN 'City ' || ((o_custkey + o_orderkey) % 4) END AS city,
  CASE WHEN o_orderkey % 13 <> 0 THEN ((c_nationkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 25)::VARCHAR END AS state_no,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Salesperson: MSR Team,' WHEN '2-HIGH' THEN 'Salesperson: Retail Dealer,'
    WHEN '3-MEDIUM' THEN 'Salesperson: Jo' WHEN '5-LOW' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'vip, Salesperson: Ann Lee, net30' END END AS tags
FROM (SELECT *, 0 AS copy FROM orders UNION ALL SELECT *, 1 AS copy FROM orders WHERE o_orderkey % 100 = 0)
JOIN customer ON o_custkey = c_custkey
""")

cte("feed_parts", """
SELECT *,
  CASE p_type WHEN 'PROMO' THEN 'SA-' WHEN 'SMALL' THEN 'KIT' WHEN 'STANDARD' THEN 'FL-' WHEN 'LARGE' THEN 'FL-'
    WHEN 'ECONOMY' THEN 'AC-' ELSE 'XX-' END || ['MR', 'SR', 'AR', 'PE'][p_size % 4 + 1] || '-' || p_partkey || '-'
    || ['S', 'B', 'C', '7', 'X'][p_size % 5 + 1] || '-'
    || ['S', 'B', 'C', '7', '7T', '7210', '4805', '1'][p_partkey % 8 + 1] AS sku,
  p_name || CASE p_size % 25 WHEN 0 THEN ' Nosing' WHEN 3 THEN ' Plank' WHEN 7 THEN ' Cut' ELSE '' END AS title
FROM part
""")

cte("feed_lines", f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT)) AS order_line_id,
  l_orderkey AS order_id, p_partkey AS product_id, sku, title, p_name, CAST(l_quantity AS BIGINT) AS quantity,
  {_money('p_retailprice')} AS price, {_money('l_extendedprice')} AS line_total,
  CAST(round({_money('l_extendedprice')} * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS total_discount,
  p_brand AS vendor, CASE WHEN l_linestatus = 'F' THEN 'fulfilled' END AS fulfillment_status, l_linenumber, l_shipdate,
  {_store('l_orderkey')} AS store
FROM lineitem JOIN feed_parts ON l_partkey = p_partkey
""")

cte("feed_lookup", """
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'retired-' || sku ELSE sku END AS sku, ['Modin', 'Silvan', 'Arista', 'Provenance'][p_size % 4 + 1] AS product_line,
  CASE WHEN p_partkey % 7 = 0 THEN 'Herringbone' ELSE ['Signature', 'Base', 'Craftsman', '7 inch', '6 inch'][p_size % 5 + 1] END AS product_category,
  CASE WHEN p_partkey % 2 = 0 THEN 'Enhanced' ELSE 'Micro' END AS bevel,
  CASE WHEN p_partkey % 11 <> 0 THEN upper(p_name[1:3]) END AS color_code,
  CASE WHEN p_partkey % 11 <> 0 THEN split_part(p_name, ' ', 1) END AS color_name
FROM feed_parts
""")

cte("feed_customers", f"""
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 83 = 0 THEN 'old-' || {_email('c_custkey')} ELSE {_email('c_custkey')} END AS email, c_custkey AS k, copy, {_money('c_acctbal')} AS balance,
  TIMESTAMP '1994-06-01 08:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS made,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Trade,Customer Type: Builder,' WHEN 'MACHINERY' THEN 'Pending,' WHEN 'HOUSEHOLD' THEN 'Retail' WHEN 'AUTOMOBILE' THEN '' END AS tags,
  CASE WHEN copy = 1 THEN 'commercial' ELSE 'regular' END AS store
FROM (SELECT *, 0 AS copy FROM customer UNION ALL SELECT *, 1 AS copy FROM customer WHERE c_custkey % 10 = 0)
""")

cte("feed_events", """
SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
  lag(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS previous_ts,
  event_type = 'purchase' AS bought
FROM events
""")

_ads = """
  sum(l_quantity)::BIGINT AS clicks, sum(CASE WHEN l_suppkey % 20 = 7 THEN 0 ELSE l_quantity * 50 END)::BIGINT AS impressions,
  CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 0.01::DECIMAL(3,2), 2) AS DECIMAL(18,2)) AS spend,
  CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS conversions,
  CAST(round(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0) * 0.05::DECIMAL(3,2), 2) AS DECIMAL(18,2)) AS conversions_value
"""
cte("feed_social", f"""
SELECT CAST(l_shipdate AS DATE) AS date_day, l_suppkey % 20 AS campaign_id, {_ads}
FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL
""")
cte("feed_search", f"""
SELECT CAST(l_shipdate AS DATE) AS date_day, l_suppkey % 20 AS campaign_id, ['MOBILE', 'DESKTOP', 'TABLET'][l_linenumber % 3 + 1] AS device, {_ads}
FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL
""")
cte("feed_campaigns", """
SELECT CASE WHEN s_suppkey % 20 = 13 THEN 113 ELSE s_suppkey % 20 END AS campaign_id, 'Search ' || campaign_id AS campaign_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'PAUSED' ELSE 'ENABLED' END AS status
FROM supplier
QUALIFY row_number() OVER (PARTITION BY s_suppkey % 20 ORDER BY s_suppkey DESC) = 1
""")

_price = _money("p_retailprice")
cte("feed_mail", f"""
SELECT p_partkey, p_partkey % 4 = 0 AS is_flow, p_type AS trigger_type,
  p_name || CASE p_size % 7 WHEN 0 THEN ' Welcome' WHEN 1 THEN ' Abandon' WHEN 2 THEN ' Sample' WHEN 3 THEN ' Win Them Back'
    WHEN 4 THEN ' Promo' WHEN 5 THEN ' Newsletter' ELSE '' END AS mail_name,
  p_partkey % 9 <> 0 AS is_live, p_partkey % 25 = 1 AS is_archived, p_size * 110::BIGINT AS recipients,
  CASE WHEN p_size = 1 THEN 0 ELSE p_size * 100::BIGINT END AS received, CASE WHEN p_size = 1 THEN 0 ELSE p_size * 30::BIGINT END AS opened,
  p_size * 7::BIGINT AS clicked, CAST(p_size % 3 AS BIGINT) AS marked_spam, CAST(p_size % 4 AS BIGINT) AS unsubscribed,
  p_size * 45::BIGINT AS total_opens, p_size * 9::BIGINT AS total_clicks, CAST(p_size % 11 AS BIGINT) AS converters,
  CASE WHEN p_size % 11 > 0 THEN CAST(p_size % 11 + p_size % 2 AS BIGINT) ELSE 0 END AS orders,
  {_price} * (p_size % 11) AS revenue, {_price} * 2 AS checkout_started_value,
  CASE WHEN p_partkey % 3 = 0 THEN {_share(_price, '0.1')} END AS refunded_revenue,
  CASE WHEN p_partkey % 5 = 0 THEN {_share(_price, '0.2')} END AS cancelled_revenue,
  TIMESTAMP '1999-12-01 10:00:00' + to_hours(p_partkey % 20000) AS created_at
FROM part
""")

_quote = "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))"
cte("feed_shipments", f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT)) AS shipment_id,
  o_orderdate + to_hours(l_linenumber) AS created, CASE WHEN l_partkey % 211 <> 0 THEN o_orderdate END AS pickup,
  l_linestatus = 'O' AND l_linenumber = 1 AS moving,
  CASE WHEN NOT (l_linestatus = 'O' AND l_linenumber = 1) THEN l_shipdate + to_hours(l_linenumber) END AS delivered,
  'Carrier ' || (l_suppkey % 6) AS carrier, CASE WHEN l_linenumber % 2 = 0 THEN 'LTL' ELSE 'Parcel' END AS service_type,
  CASE WHEN l_suppkey % 37 <> 0 THEN CAST(l_suppkey % 80 + 20 AS INTEGER) END AS estimated_transit_days,
  {_quote} AS quoted_rate,
  CASE WHEN l_returnflag <> 'N' THEN CAST(round({_quote} * (0.95::DECIMAL(4,2) + CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) END AS invoiced_amount,
  'Town ' || s_nationkey AS origin_city, 'S' || s_nationkey AS origin_state, 'Town ' || c_nationkey AS destination_city, 'S' || c_nationkey AS destination_state
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
""")
