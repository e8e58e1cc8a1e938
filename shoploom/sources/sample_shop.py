"""Shop, ads, mail, web and freight feeds derived from star-schema tables.

The feeds have the input schemas of `schemas.py`. Every formula is deterministic, so the same
feeds can be written in SQL. Each feed reads its tables once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shoploom.sources import schemas
from shoploom.sources.tables import source

AS_OF_ORDERS = "2001-12-31"
AS_OF_EVENTS = "2024-01-31"
STORE_THRESHOLDS = {"regular": 955, "commercial": 940}
MIN_SUBTOTAL = 100000
SEGMENTS = ((400000, "High Value"), (200000, "Medium Value"), (60000, "Low Value"))


def _case(value: Column, pairs, otherwise=None) -> Column:
    out = None
    for key, result in pairs:
        result = result if isinstance(result, Column) else F.lit(result)
        out = F.when(value == key, result) if out is None else out.when(value == key, result)
    return out if otherwise is None else out.otherwise(otherwise)


def _money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(schemas.MONEY)


def _share(c: Column, factor: str) -> Column:
    """`c * factor` to the cent."""
    return F.round(c * F.lit(factor).cast("decimal(6,3)"), 2).cast(schemas.MONEY)


def _after(ts: Column, days=0, hours=0, minutes=0) -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    return ts + F.make_dt_interval(lit(days), lit(hours), lit(minutes))


def _email(key: Column) -> Column:
    host = F.when(key % 50 == 0, "@amazon.com").otherwise("@Example.com")
    return F.when(key % 97 != 0, F.concat(F.lit("Cust"), key.cast("string"), host))


def _store(order_key: Column) -> Column:
    return F.when(order_key % 5 == 0, "commercial").otherwise("regular")


def _repeat(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition occur twice, the second with `copy` 1."""
    return df.withColumn("copy", F.explode(F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of both stores; every hundredth was synced again a day later."""
    o = source(spark, folder, "orders")
    c = source(spark, folder, "customer").select("c_custkey", "c_nationkey")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    df = _repeat(o, key % 100 == 0).join(c, F.col("o_custkey") == F.col("c_custkey"))
    placed = _after(F.col("o_orderdate"), hours=(key % 24).cast("int"))
    subtotal = _money("o_totalprice")
    tax = _share(subtotal, "0.080")
    partly, failed = F.col("o_orderstatus") == "P", F.col("o_orderstatus") == "F"
    refund = F.when(partly & (key % 400 == 0), _share(subtotal, "1.200")).when(
        partly & (key % 4 == 0), _share(subtotal, "0.100")
    )
    cancel = F.when(failed & (key % 7 == 0), "customer")
    has_address = cust % 41 != 0
    nation = F.col("c_nationkey")
    street = _case(cust % 4, ((0, " Main St."), (1, " main st"), (2, " Main  Street")), F.lit(" North main st, Suite #2"))
    state_no = F.pmod(nation + F.when(key % 7 == 0, 1).otherwise(0), F.lit(25))
    address = {
        "address_1": F.when(has_address, F.concat((cust % 300).cast("string"), street)),
        "address_2": F.lit(None),
        "city": F.when(key % 17 != 0, F.concat(F.lit("City "), ((cust + key) % 4).cast("string"))),
        "province": F.when(key % 13 != 0, F.concat(F.lit("State "), state_no.cast("string"))),
        "province_code": F.when(key % 13 != 0, F.concat(F.lit("S"), state_no.cast("string"))),
        "zip": F.when(
            has_address,
            F.concat((nation + 90000).cast("string"), F.when(cust % 2 == 1, "-1234").otherwise("")),
        ),
        "country": F.when(nation < 20, "US").otherwise("CA"),
        "country_code": F.when(nation < 20, "US").otherwise("CA"),
    }
    tag = _case(
        F.col("o_orderpriority"),
        (
            ("1-URGENT", "Salesperson: MSR Team,"),
            ("2-HIGH", "Salesperson: Retail Dealer,"),
            ("3-MEDIUM", "Salesperson: Jo"),
            ("5-LOW", F.when(key % 3 == 0, "vip, Salesperson: Ann Lee, net30")),
        ),
    )
    out = df.select(
        key.alias("order_id"), cust.alias("customer_id"), F.lit(None).alias("user_id"), _email(cust).alias("email"),
        placed.alias("processed_timestamp"), _after(placed, minutes=-5).alias("created_timestamp"),
        F.when(cancel.isNotNull(), _after(placed, days=1)).alias("cancelled_timestamp"),
        F.when(F.col("o_orderstatus") == "O", _after(placed, days=3)).alias("closed_timestamp"),
        placed.alias("updated_timestamp"), subtotal.alias("subtotal_price_pres_amount"),
        (subtotal + tax).alias("total_price_pres_amount"),
        F.when(failed, _share(subtotal, "0.050")).otherwise(F.lit(0)).alias("total_discounts_pres_amount"),
        tax.alias("total_tax_pres_amount"), F.lit(0).alias("total_tip_received_pres_amount"),
        refund.alias("refund_subtotal"), F.lit(None).alias("refund_total_tax"),
        F.lit(None).alias("order_adjustment_amount"),
        (subtotal + tax - F.coalesce(refund, F.lit(0))).alias("order_adjusted_total"),
        F.concat(F.lit("#"), key.cast("string")).alias("name"), key.alias("number"),
        F.when(F.col("copy") == 1, "resync").alias("note"), F.lit("web").alias("source_name"),
        _case(F.col("o_orderstatus"), (("O", "paid"), ("P", "refunded"), ("F", "pending"))).alias("financial_status"),
        _case(F.col("o_orderstatus"), (("O", "fulfilled"), ("P", "partial"))).alias("fulfillment_status"),
        cancel.alias("cancel_reason"), F.lit(None).alias("location_id"),
        *[v.alias(f"{side}_address_{k}") for side in ("billing", "shipping") for k, v in address.items()],
        tag.alias("order_tags"), _after(placed, days=F.col("copy")).alias("_fivetran_synced"),
        F.concat(F.lit("shop_"), _store(key)).alias("source_relation"), _store(key).alias("store"),
    )
    return schemas.conform(out, schemas.ORDERS)


def _sku(part_key: Column) -> Column:
    prefix = _case(
        F.col("p_type"),
        (("PROMO", "SA-"), ("SMALL", "KIT"), ("STANDARD", "FL-"), ("LARGE", "FL-"), ("ECONOMY", "AC-")),
        F.lit("XX-"),
    )
    size = F.col("p_size")
    line = _case(size % 4, ((0, "MR"), (1, "SR"), (2, "AR")), F.lit("PE"))
    category = _case(size % 5, ((0, "S"), (1, "B"), (2, "C"), (3, "7")), F.lit("X"))
    tail = F.element_at(F.array(*[F.lit(v) for v in ("S", "B", "C", "7", "7T", "7210", "4805", "1")]), (part_key % 8 + 1).cast("int"))
    return F.concat_ws("-", F.concat(prefix, line), part_key.cast("string"), category, tail)


def _title() -> Column:
    extra = _case(F.col("p_size") % 25, ((0, " Nosing"), (3, " Plank"), (7, " Cut")), F.lit(""))
    return F.concat(F.col("p_name"), extra)


def _line_id() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("bigint"),
    )


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with sku and title, built once per part before any join."""
    return source(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size", _money("p_retailprice").alias("price"),
        _sku(F.col("p_partkey")).alias("sku"), _title().alias("title"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    li, part = source(spark, folder, "lineitem"), _parts(spark, folder)
    df = li.join(part, li.l_partkey == part.p_partkey)
    total = _money("l_extendedprice")
    out = df.select(
        _line_id().alias("order_line_id"), F.col("l_orderkey").alias("order_id"), F.col("p_partkey").alias("product_id"),
        F.col("p_partkey").alias("variant_id"), "sku", "title",
        F.col("p_name").alias("name"), F.col("l_quantity").alias("quantity"), F.col("price").alias("variant_price"),
        total.alias("price_pres_amount"),
        F.round(total * F.col("l_discount").cast("decimal(4,2)"), 2).alias("total_discount_pres_amount"),
        F.col("p_brand").alias("vendor"), F.lit(None).alias("variant_title"), F.lit(False).alias("is_gift_card"),
        F.lit(True).alias("is_taxable"), F.lit(True).alias("is_shipping_required"),
        _case(F.col("l_linestatus"), (("F", "fulfilled"),)).alias("fulfillment_status"),
        F.col("l_linenumber").alias("index"), F.col("l_shipdate").alias("_fivetran_synced"),
        F.concat(F.lit("shop_"), _store(F.col("l_orderkey"))).alias("source_relation"),
        _store(F.col("l_orderkey")).alias("store"),
    )
    return schemas.conform(out, schemas.ORDER_LINES)


def sku_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup row per part; every third has a sku that no line carries, so that the prefix fallback is used too."""
    key, size = F.col("p_partkey"), F.col("p_size")
    line = _case(size % 4, ((0, "Modin"), (1, "Silvan"), (2, "Arista")), F.lit("Provenance"))
    category = F.when(key % 7 == 0, "Herringbone").otherwise(
        _case(size % 5, ((0, "Signature"), (1, "Base"), (2, "Craftsman"), (3, "7 inch")), F.lit("6 inch"))
    )
    sku = F.when(key % 3 == 0, F.concat(F.lit("retired-"), F.col("sku"))).otherwise(F.col("sku"))
    out = _parts(spark, folder).select(
        sku.alias("sku"), line.alias("product_line"), category.alias("product_category"),
        F.when(key % 2 == 0, "Enhanced").otherwise("Micro").alias("bevel"),
        F.when(key % 11 != 0, F.upper(F.substring("p_name", 1, 3))).alias("color_code"),
        F.when(key % 11 != 0, F.split_part("p_name", F.lit(" "), F.lit(1))).alias("color_name"),
    )
    return schemas.conform(out, schemas.SKU_LOOKUP)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of both stores; a tenth also has a commercial record, updated later. Some order under another address
    than the one on record, so that they have no customer and these records no orders."""
    key, balance = F.col("c_custkey"), _money("c_acctbal")
    df = _repeat(source(spark, folder, "customer"), key % 10 == 0)
    commercial = F.col("copy") == 1
    email = F.when(key % 83 == 0, F.concat(F.lit("old-"), _email(key))).otherwise(_email(key))
    made = _after(F.lit("1994-06-01 08:00:00").cast("timestamp_ntz"), days=(key % 365).cast("int"))
    tag = _case(
        F.col("c_mktsegment"),
        (("BUILDING", "Trade,Customer Type: Builder,"), ("MACHINERY", "Pending,"), ("HOUSEHOLD", "Retail"), ("AUTOMOBILE", "")),
    )
    out = df.select(
        key.alias("customer_id"), email.alias("email"), F.lit("Cust").alias("first_name"),
        key.cast("string").alias("last_name"), F.lit(None).alias("phone"), F.lit(None).alias("note"),
        F.lit("ENABLED").alias("account_state"), F.lit(False).alias("is_tax_exempt"),
        (key % 2 == 0).alias("is_verified_email"), F.lit("USD").alias("currency"),
        F.when(key % 3 == 0, "SUBSCRIBED").otherwise("NOT_SUBSCRIBED").alias("marketing_consent_state"),
        F.lit("SINGLE_OPT_IN").alias("marketing_opt_in_level"), F.lit(None).alias("marketing_consent_updated_at"),
        made.alias("created_timestamp"), _after(made, days=F.col("copy") + 1).alias("updated_timestamp"),
        _after(made, days=10).alias("first_order_timestamp"), _after(made, days=100).alias("most_recent_order_timestamp"),
        tag.alias("customer_tags"), (key % 12).alias("lifetime_count_orders"), balance.alias("lifetime_total_spent"),
        _share(balance, "0.100").alias("lifetime_total_refunded"), _share(balance, "0.900").alias("lifetime_total_net"),
        _share(balance, "0.080").alias("lifetime_total_tax"), _share(balance, "0.050").alias("lifetime_total_discount"),
        F.when(~commercial, key % 4).alias("lifetime_abandoned_checkouts"),
        _share(balance, "0.250").alias("avg_order_value"), (key % 5 + F.lit(0.5)).alias("avg_quantity_per_order"),
        _share(balance, "0.020").alias("avg_tax_per_order"),
        _after(made, days=F.col("copy") + 2).alias("_fivetran_synced"),
        F.concat(F.lit("shop_"), F.when(commercial, "commercial").otherwise("regular")).alias("source_relation"),
        F.when(commercial, "commercial").otherwise("regular").alias("store"),
    )
    return schemas.conform(out, schemas.CUSTOMERS)


# Fixed value: the column that the commercial store's customers lack.
LACKING = {"commercial": ("lifetime_abandoned_checkouts",)}


def by_store(feed: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """A feed as each store delivers it: without the store's name and the columns that the store lacks."""
    lacking = LACKING if "lifetime_abandoned_checkouts" in feed.columns else {}
    return {name: feed.filter(F.col("store") == name).drop("store", *lacking.get(name, ())) for name in names}


def _entry(key: str, string=None, integer=None, double=None) -> Column:
    def part(value, kind):
        return (F.lit(None) if value is None else value).cast(kind)

    value = F.struct(
        part(string, "string").alias("string_value"), part(integer, "bigint").alias("int_value"),
        part(double, "double").alias("double_value"),
    )
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Web events; a user's day is a session. Some lack a session id or a user."""
    e = source(spark, folder, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    day = F.date_format("ts", "yyyyMMdd")
    previous = F.lag("ts").over(W.partitionBy("user_id", day).orderBy("ts", "event_id"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    name = _case(
        F.col("event_type"),
        (("view", "view_item"), ("click", "add_to_cart"), ("signup", "begin_checkout"), ("purchase", "purchase")),
        F.lit("page_view"),
    )
    page = _case(
        k % 7,
        (
            (0, "https://shop.example.com/products/oak"), (1, "https://shop.example.com/collections/oak/products/a"),
            (2, "https://shop.example.com/collections/oak"), (3, "https://shop.example.com/cart"),
            (4, F.when(k % 2 == 0, "https://shop.example.com/checkout").otherwise("https://shop.example.com/pages/samples")),
            (5, F.when(k % 2 == 0, "https://shop.example.com/").otherwise("/")),
        ),
        F.lit("https://shop.example.com/about"),
    )
    user, eid, bought = F.col("user_id"), F.col("event_id"), F.col("event_type") == "purchase"
    none = F.array().cast("array<struct<key: string, value: struct<string_value: string, int_value: bigint, double_value: double>>>")
    params = F.concat(
        F.array(_entry("page_location", string=page)),
        F.when(eid % 50 != 0, F.array(_entry("ga_session_id", integer=day.cast("bigint")))).otherwise(none),
        F.when(
            bought,
            F.array(
                _entry("transaction_id", string=F.concat(F.lit("T"), eid.cast("string"))),
                _entry("value", double=F.col("value")),
            ),
        ).otherwise(none),
        F.when(
            k % 3 == 0,
            F.array(_entry("engagement_time_msec", integer=k * 130), _entry("price", integer=k)),
        ).otherwise(none),
    )
    out = e.select(
        day.alias("event_date"), F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("event_timestamp"),
        name.alias("event_name"), eid.alias("event_bundle_sequence_id"),
        F.timestamp_diff("MICROSECOND", epoch, previous).alias("event_previous_timestamp"),
        F.when(bought, F.col("value")).alias("event_value_in_usd"), F.lit(None).alias("user_id"),
        F.when(eid % 61 != 0, user.cast("string")).alias("user_pseudo_id"), F.lit(None).alias("user_first_touch_timestamp"),
        F.struct(
            _case(user % 3, ((0, "mobile"), (1, "desktop")), F.lit("tablet")).alias("category"),
            F.lit("Acme").alias("mobile_brand_name"), F.lit(None).cast("string").alias("mobile_model_name"),
            F.lit("Web").alias("operating_system"), F.lit("1").alias("operating_system_version"), F.lit("en").alias("language"),
            F.struct(
                F.when(user % 2 == 0, "Chrome").otherwise("Safari").alias("browser"), F.lit("9").alias("browser_version")
            ).alias("web_info"),
        ).alias("device"),
        F.struct(
            F.lit("Americas").alias("continent"), F.when(user % 5 == 0, "CA").otherwise("US").alias("country"),
            F.lit(None).cast("string").alias("region"), F.concat(F.lit("City "), (user % 9).cast("string")).alias("city"),
            F.lit(None).cast("string").alias("metro"),
        ).alias("geo"),
        F.struct(
            F.lit("(direct)").alias("name"), F.when(user % 4 == 0, "cpc").otherwise("organic").alias("medium"),
            F.lit("search").alias("source"),
        ).alias("traffic_source"),
        F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("version")).alias("app_info"),
        F.lit("WEB").alias("platform"),
        F.struct(F.lit("Yes").alias("analytics_storage"), F.lit("No").alias("ads_storage")).alias("privacy_info"),
        F.struct(
            F.when(bought, F.concat(F.lit("T"), eid.cast("string"))).alias("transaction_id"),
            F.when(bought, F.col("value")).alias("purchase_revenue"),
        ).alias("ecommerce"),
        params.alias("event_params"), none.alias("user_properties"),
    )
    return schemas.conform(out, schemas.EVENTS)


def _ad_rows(spark, folder, status, *keys):
    price, returned = _money("l_extendedprice"), F.col("l_returnflag") == "R"
    return (
        source(spark, folder, "lineitem")
        .filter(F.col("l_linestatus") == status)
        .groupBy(F.to_date("l_shipdate").alias("day"), (F.col("l_suppkey") % 20).alias("campaign"), *keys)
        .agg(
            F.sum("l_quantity").cast("bigint").alias("clicks"), F.sum(price).cast("decimal(20,2)").alias("gross"),
            F.count_if(returned).alias("returned"),
            F.coalesce(F.sum(F.when(returned, price)), F.lit(0)).cast("decimal(20,2)").alias("returned_gross"),
        )
        .withColumn("impressions", F.when(F.col("campaign") == 7, 0).otherwise(F.col("clicks") * 50))
        .withColumn("spend", F.round(F.col("gross") * F.lit("0.01").cast("decimal(3,2)"), 2))
        .withColumn("value", F.round(F.col("returned_gross") * F.lit("0.05").cast("decimal(3,2)"), 2))
    )


def social_ads(spark: SparkSession, folder: str) -> DataFrame:
    campaign = F.col("campaign").cast("string")
    out = _ad_rows(spark, folder, "O").select(
        F.col("day").alias("date_day"), F.lit("A1").alias("account_id"), F.lit("Main").alias("account_name"),
        F.col("campaign").alias("campaign_id"), F.concat(F.lit("Social "), campaign).alias("campaign_name"),
        F.concat(F.lit("S"), campaign).alias("ad_set_id"), F.concat(F.lit("Set "), campaign).alias("ad_set_name"),
        F.concat(F.lit("D"), campaign).alias("ad_id"), F.concat(F.lit("Ad "), campaign).alias("ad_name"),
        F.lit("shop.example.com").alias("conversion_domain"), "clicks", "impressions", "spend",
        F.col("returned").alias("conversions"), F.col("value").alias("conversions_value"),
        F.lit("social").alias("source_relation"),
    )
    return schemas.conform(out, schemas.SOCIAL_ADS)


def search_stats(spark: SparkSession, folder: str) -> DataFrame:
    device = _case(F.col("l_linenumber") % 3, ((0, "MOBILE"), (1, "DESKTOP")), F.lit("TABLET")).alias("device")
    out = _ad_rows(spark, folder, "F", device).select(
        F.col("day").alias("segments_date"), F.col("campaign").alias("campaign_id"), F.lit(1).alias("customer_id"),
        F.col("clicks").alias("metrics_clicks"), F.col("impressions").alias("metrics_impressions"),
        (F.col("spend") * 1000000).alias("metrics_cost_micros"), F.col("returned").alias("metrics_conversions"),
        F.col("value").alias("metrics_conversions_value"), F.col("clicks").alias("metrics_interactions"),
        F.lit(0).alias("metrics_view_through_conversions"), F.lit("SEARCH").alias("segments_ad_network_type"),
        F.col("device").alias("segments_device"), F.col("day").alias("_DATA_DATE"),
        F.lit("2001-12-31").cast("date").alias("_LATEST_DATE"),
    )
    return schemas.conform(out, schemas.SEARCH_STATS)


def search_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign snapshots, several dates each; what would be campaign 13 has a number that no ad carries."""
    key = F.col("s_suppkey")
    campaign = F.when(key % 20 == 13, 113).otherwise(key % 20)
    out = source(spark, folder, "supplier").select(
        campaign.alias("campaign_id"), F.lit(1).alias("customer_id"),
        F.concat(F.lit("Search "), campaign.cast("string")).alias("campaign_name"),
        F.lit("SEARCH").alias("campaign_advertising_channel_type"), F.lit(None).alias("campaign_advertising_channel_sub_type"),
        F.when(key % 3 == 0, "PAUSED").otherwise("ENABLED").alias("campaign_status"),
        F.date_add(F.lit("1990-01-01").cast("date"), key.cast("int")).alias("_DATA_DATE"),
    )
    return schemas.conform(out, schemas.SEARCH_CAMPAIGNS)


def _mail_base(spark: SparkSession, folder: str, live: str, wanted: Column) -> DataFrame:
    key, size, price = F.col("p_partkey"), F.col("p_size").cast("bigint"), _money("p_retailprice")
    word = _case(
        size % 7,
        ((0, " Welcome"), (1, " Abandon"), (2, " Sample"), (3, " Win Them Back"), (4, " Promo"), (5, " Newsletter")),
        F.lit(""),
    )
    reached = F.when(size == 1, 0).otherwise(size * 100)
    buyers = size % 11
    made = _after(F.lit("1999-12-01 10:00:00").cast("timestamp_ntz"), hours=(key % 20000).cast("int"))
    return source(spark, folder, "part").filter(wanted).select(
        key, F.concat("p_name", word).alias("mail_name"), F.col("p_type").alias("trigger_type"),
        F.when(key % 9 != 0, live).otherwise("draft").alias("status"), (key % 25 == 1).alias("is_archived"),
        (size * 110).alias("total_count_unique_people"), reached.alias("unique_count_received_email"),
        F.when(size == 1, 0).otherwise(size * 30).alias("unique_count_opened_email"),
        (size * 7).alias("unique_count_clicked_email"), (size % 3).alias("unique_count_marked_email_as_spam"),
        (size % 4).alias("unique_count_unsubscribed"), (size * 45).alias("count_opened_email"),
        (size * 9).alias("count_clicked_email"), buyers.alias("unique_count_placed_order"),
        F.when(buyers > 0, buyers + size % 2).otherwise(0).alias("count_placed_order"),
        (price * buyers).alias("sum_revenue_placed_order"), (price * buyers).alias("sum_revenue_ordered_product"),
        (price * 2).alias("sum_revenue_checkout_started"),
        F.when(key % 3 == 0, _share(price, "0.100")).alias("sum_revenue_refunded_order"),
        F.when(key % 5 == 0, _share(price, "0.200")).alias("sum_revenue_cancelled_order"),
        F.lit(0).alias("unique_count_received_sms"), F.lit(0).alias("unique_count_clicked_sms"),
        made.alias("created_at"), _after(made, days=1).alias("updated_at"),
    )


def email_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    out = _mail_base(spark, folder, "sent", key % 4 != 0).select(
        "*", key.alias("campaign_id"), F.concat(F.lit("v"), key.cast("string")).alias("campaign_variation_key"),
        F.lit(None).alias("variation_id"), F.col("mail_name").alias("campaign_name"),
        F.concat(F.lit("About "), F.col("mail_name")).alias("subject"), F.lit("email").alias("campaign_type"),
        F.lit("hello@example.com").alias("from_email"), F.lit("Shop").alias("from_name"),
        F.lit(None).alias("email_template_id"),
        F.when(key % 50 != 2, _after(F.col("created_at"), hours=2)).alias("sent_at"), F.col("created_at").alias("scheduled_at"),
    )
    return schemas.conform(out, schemas.EMAIL_CAMPAIGNS)


def email_flows(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    out = _mail_base(spark, folder, "live", key % 4 == 0).select(
        "*", key.alias("flow_id"), F.col("mail_name").alias("flow_name")
    )
    return schemas.conform(out, schemas.EMAIL_FLOWS)


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    li, o = source(spark, folder, "lineitem"), source(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    s = source(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("from_nation"))
    c = source(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("to_nation"))
    df = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(c, o.o_custkey == c.c_custkey)
    )
    number = F.col("l_linenumber")
    on_the_way = (F.col("l_linestatus") == "O") & (number == 1)
    quote = F.round(_money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(18,2)")
    billed = F.round(quote * (F.lit("0.95").cast("decimal(4,2)") + F.col("l_discount").cast("decimal(4,2)")), 2)
    out = df.select(
        _line_id().alias("id"), _after(F.col("o_orderdate"), hours=number).alias("created_date"),
        F.when(F.col("l_partkey") % 211 != 0, F.col("o_orderdate")).alias("pickup_date"),
        F.when(~on_the_way, _after(F.col("l_shipdate"), hours=number)).alias("tracking_delivery_date_actual"),
        F.when(on_the_way, "in-transit").otherwise("delivered").alias("status"),
        F.when(on_the_way, "moving").otherwise("done").alias("tracking_status"),
        F.concat(F.lit("Carrier "), (F.col("l_suppkey") % 6).cast("string")).alias("rate_carrier"),
        F.when(number % 2 == 0, "LTL").otherwise("Parcel").alias("rate_service_type"),
        F.when(F.col("l_suppkey") % 37 != 0, F.col("l_suppkey") % 80 + 20).alias("rate_transit_days"),
        quote.alias("rate_total"), F.when(F.col("l_returnflag") != "N", billed).alias("invoice_amount"),
        F.concat(F.lit("Town "), F.col("from_nation").cast("string")).alias("origin_city"),
        F.concat(F.lit("S"), F.col("from_nation").cast("string")).alias("origin_state"),
        F.concat(F.lit("Town "), F.col("to_nation").cast("string")).alias("destination_city"),
        F.concat(F.lit("S"), F.col("to_nation").cast("string")).alias("destination_state"),
    )
    return schemas.conform(out, schemas.SHIPMENTS)
