import pytest
from helpers import by, day, frame, ts
from shoploom.plans import staging as s
from shoploom.operators.relational import union_stores
from shoploom.sources import schemas
from shoploom.sources.sample_shop import by_store
from pyspark.sql import functions as F


def order(n, store="regular", synced="2024-01-05 00:00", **more):
    base = dict(order_id=n, store=store, email="A@X.com", processed_timestamp=ts("2024-01-05 03:00"),
                subtotal_price_pres_amount=100, _fivetran_synced=ts(synced))
    return base | more


def test_newest_copy_per_store_wins(spark):
    feed = frame(spark, schemas.ORDERS, [
        order(1, note="old"), order(1, synced="2024-01-06 00:00", note="new"), order(1, "commercial", note="other"),
        order(2, email=None, order_tags=""), order(3, order_tags="vip, Salesperson: Ann Lee, x", refund_subtotal=5),
    ])
    got = by(s.stage_orders(feed), "order_id", "store")
    assert len(got) == 4
    assert got[1, "regular"]["note"] == "new" and got[1, "commercial"]["note"] == "other"
    assert got[1, "regular"]["email"] == "a@x.com" and got[2, "regular"]["email"] is None
    assert got[1, "regular"]["order_date"] == day("2024-01-04")  # evening before, Pacific
    assert (got[1, "regular"]["salesperson"], got[1, "commercial"]["salesperson"]) == ("DTC", "Commercial")
    assert (got[1, "regular"]["product_price_threshold"], got[1, "commercial"]["product_price_threshold"]) == (55, 40)
    assert got[3, "regular"]["salesperson"] == "Ann Lee"
    assert float(got[3, "regular"]["refund_subtotal"]) == 5 and float(got[1, "regular"]["refund_subtotal"]) == 0


LINES = [  # sku, title, price, store, type, sample type, color
    ("SA-MR-1", "Oak Board", 5, "regular", "Sample", None, "Oak"),
    ("KIT9", "Oak Kit", 5, "regular", "Sample", None, "Oak"),
    ("sa-1", "Oak Board", 5, "regular", "Accessories", None, "Oak"),  # prefixes are matched as written
    ("X1", "Elm CUT", 5, "regular", "Sample", "Sample - Cut", "Elm"),
    ("X1", "Elm Sample", 99, "regular", "Sample", "Sample - Cut", "Elm"),
    ("X1", "Elm plank", 5, "regular", "Sample", "Sample - Plank", "Elm"),
    ("x-full", "Elm", 5, "regular", "Sample", "Sample - Plank", "Elm"),
    ("x-cut", "Elm plank", 5, "regular", "Sample", "Sample - Cut", "Elm"),
    ("FL-1", "Pine Nosing", 5, "regular", "Product", None, "Pine"),
    ("X1", "Pine", 55, "regular", "Accessories", None, "Pine"),
    ("X1", "Pine", 56, "regular", "Product", None, "Pine"),
    ("X1", "Pine", 41, "commercial", "Product", None, "Pine"),
    ("X1", "Pine nosing", 56, "regular", "Accessories", None, "Pine"),
    ("AC-1", "Glue", 5, "regular", "Accessories", None, "Glue"),
    ("AC-1", "Glue", 70, "regular", "Product", None, "Glue"),  # price comes before the accessory prefix
    ("X1", None, 99, "regular", "Accessories", None, None),
    (None, "Pine", 99, "regular", "Product", None, "Pine"),
    ("FL-2", " Pine", 5, "regular", "Product", None, " Pine"),  # the first word must hold a character
]


def test_line_classification(spark):
    rows = [dict(order_line_id=str(i), order_id=1, sku=a, title=b, variant_price=p, store=st, quantity=3, price_pres_amount=12)
            for i, (a, b, p, st, *_) in enumerate(LINES)]
    got = by(s.stage_order_lines(frame(spark, schemas.ORDER_LINES, rows)), "order_line_id")
    for i, (sku, title, price, store, kind, sample, color) in enumerate(LINES):
        r = got[str(i)]
        assert (r["line_item_type"], r["sample_type"], r["color"]) == (kind, sample, color), LINES[i]
        assert [r[f"{k}_quantity"] for k in ("sample", "product", "accessories")] == [
            3 * (kind == k) for k in ("Sample", "Product", "Accessories")]


def test_customer_groups_and_newest_record(spark):
    def row(n, email, updated, tags=None, store="regular", synced="2024-01-01 00:00"):
        return dict(customer_id=n, email=email, updated_timestamp=ts(updated), customer_tags=tags, store=store, _fivetran_synced=ts(synced))

    feed = frame(spark, schemas.CUSTOMERS, [
        row(1, "A@x.com", "2024-01-01 00:00", "Trade"), row(2, "a@X.com", "2024-01-02 00:00", "Trade, Pending", "commercial"),
        row(3, None, "2024-01-01 00:00"), row(4, "b@x.com", "2024-01-01 00:00", ""), row(5, "c@x.com", "2024-01-01 00:00"),
        row(6, "d@x.com", "2024-01-01 00:00", "Legacy TR,Customer Type: Builder,"), row(7, "e@x.com", "2024-01-01 00:00", "Guest"),
        row(8, "f@x.com", "2024-01-01 00:00", "other"), row(9, "g@x.com", "2024-01-01 00:00", "x", synced="2024-01-01 00:00"),
        row(10, "g@x.com", "2024-01-01 00:00", "x", synced="2024-01-03 00:00"),
    ])
    got = by(s.stage_customers(feed), "email")
    assert set(got) == {f"{c}@x.com" for c in "abcdefg"}
    assert got["a@x.com"]["customer_id"] == 2 and got["a@x.com"]["customer_group"] == "Pending Trade Rewards"
    assert got["d@x.com"]["customer_group"] == "Trade Rewards" and got["d@x.com"]["customer_type"] == "Builder"
    assert {got[f"{c}@x.com"]["customer_group"] for c in "bcef"} == {"Retail"}
    assert got["g@x.com"]["customer_id"] == 10 and got["b@x.com"]["customer_type"] == "DTC"


def test_union_pads_missing_columns(spark):
    a = frame(spark, "customer_id bigint, abandoned bigint", [dict(customer_id=1, abandoned=2)])
    b = frame(spark, "customer_id bigint", [dict(customer_id=1)])
    got = by(union_stores({"regular": a, "commercial": b}), "store")
    assert got["regular"]["abandoned"] == 2 and got["commercial"]["abandoned"] is None


def test_stages_stack_the_stores(spark):
    """One feed per store gives what the tagged rows of both give; a column that a store lacks is NULL, in its type."""
    rows = [dict(customer_id=n, email=f"{e}@x.com", updated_timestamp=ts(t), lifetime_abandoned_checkouts=a, store=store)
            for n, e, t, a, store in ((1, "A", "2024-01-01 00:00", 3, "regular"), (2, "a", "2024-01-02 00:00", None, "commercial"),
                                      (3, "b", "2024-01-01 00:00", 4, "regular"), (4, "c", "2024-01-01 00:00", None, "commercial"))]
    tagged = frame(spark, schemas.CUSTOMERS, rows)
    feeds = by_store(tagged, ["regular", "commercial"])
    assert "lifetime_abandoned_checkouts" not in feeds["commercial"].columns and "store" not in feeds["regular"].columns
    whole, got = s.stage_customers(tagged), s.stage_customers(feeds)
    assert got.schema["lifetime_abandoned_checkouts"].dataType == whole.schema["lifetime_abandoned_checkouts"].dataType
    assert by(got, "email") == by(whole.select(got.columns), "email")
    assert by(s.stage_customers({"commercial": feeds["commercial"], "regular": feeds["regular"]}), "email")["b@x.com"]["lifetime_abandoned_checkouts"] == 4

    tagged = frame(spark, schemas.ORDERS, [order(1, note="old"), order(1, synced="2024-01-06 00:00"), order(1, "commercial"), order(2)])
    feeds = by_store(tagged, ["regular", "commercial"])
    assert by(s.stage_orders(feeds), "order_id", "store") == by(s.stage_orders(tagged), "order_id", "store")
    empty = feeds["commercial"].limit(0)
    assert set(by(s.stage_orders(feeds | {"commercial": empty}), "order_id", "store")) == {(1, "regular"), (2, "regular")}
    with pytest.raises(ValueError, match="outlet"):
        s.stage_orders(feeds | {"outlet": empty})
    with pytest.raises(ValueError, match="no feed"):
        s.stage_order_lines({})


def event(n, shard="20240105", params=(), **more):
    entries = [(k, (v if t == "s" else None, v if t == "i" else None, v if t == "d" else None)) for k, t, v in params]
    return dict(event_date=shard, event_bundle_sequence_id=n, event_timestamp=1704423600000000, event_name="purchase", event_params=entries) | more


def test_events(spark):
    pages = [
        ("https://s/collections/a/products/b", "product_detail"), ("https://s/collections/a", "product_list"), ("https://s/cart/1", "cart"),
        ("https://s/checkout/x", "checkout"), ("https://s/pages/samples", "samples"), ("https://s/sample-box", "samples"), ("/", "homepage"),
        ("https://shop.example.com/", "homepage"), ("https://s/about", "other"), (None, "other"),
    ]
    rows = [event(i, params=[("page_location", "s", p)] if p else []) for i, (p, _) in enumerate(pages)]
    rows += [
        event(90, shard="20230901"), event(91, params=[("value", "i", 5), ("ga_session_id", "i", 7), ("engagement_time_msec", "i", 1500)]),
        event(92, event_previous_timestamp=1704423598999000, event_name="page_view"),
    ]
    as_of = F.lit("2024-01-31").cast("date")
    got = by(s.stage_events(frame(spark, schemas.EVENTS, rows), as_of), "event_bundle_sequence_id")
    assert 90 not in got and len(got) == len(pages) + 2
    assert [got[i]["page_type"] for i in range(len(pages))] == [t for _, t in pages]
    assert got[0]["event_timestamp_pt"] == ts("2024-01-04 19:00") and got[0]["event_date_pt"] == day("2024-01-04")
    assert got[91]["transaction_value"] is None and got[91]["ga_session_id"] == 7 and got[91]["engagement_time_seconds"] == 1.5
    assert got[92]["seconds_since_previous_event"] == 2 and got[0]["seconds_since_previous_event"] is None
    assert (got[92]["is_page_view"], got[92]["is_purchase"]) == (1, 0)


def test_ads(spark):
    social = s.stage_social_ads(frame(spark, schemas.SOCIAL_ADS, [
        dict(ad_id="a", clicks=5, impressions=1000, spend=10, conversions=2.0, conversions_value=30),
        dict(ad_id="b", clicks=0, impressions=0, spend=0, conversions=0.0, conversions_value=0),
    ]))
    got = by(social, "ad_id")
    assert [got["a"][c] for c in ("ctr", "cpc", "roas", "cpa")] == [0.5, 2.0, 3.0, 5.0]
    assert [got["b"][c] for c in ("ctr", "cpc", "roas", "cpa")] == [None] * 4
    stats = frame(spark, schemas.SEARCH_STATS, [
        dict(campaign_id=1, customer_id=9, metrics_clicks=4, metrics_impressions=8, metrics_cost_micros=2500000),
        dict(campaign_id=2, customer_id=9, metrics_clicks=4, metrics_cost_micros=1)])
    campaigns = frame(spark, schemas.SEARCH_CAMPAIGNS, [
        dict(campaign_id=1, customer_id=9, campaign_name="old", _DATA_DATE=day("2024-01-01")),
        dict(campaign_id=1, customer_id=9, campaign_name="new", _DATA_DATE=day("2024-02-01")),
        dict(campaign_id=2, customer_id=8, campaign_name="other account", _DATA_DATE=day("2024-02-01"))])
    rows = s.stage_search_ads(stats, campaigns).collect()
    assert len(rows) == 2  # snapshots do not multiply rows
    got = {r.campaign_id: r for r in rows}
    assert got[1].campaign_name == "new" and float(got[1].spend) == 2.5 and got[1].cpc == 0.63
    assert got[2].campaign_name is None and float(got[2].spend) == 0.000001


def test_mail(spark):
    def mail(n, name, received=100, **more):
        return dict(campaign_id=n, campaign_name=name, status="sent", is_archived=False, unique_count_received_email=received,
                    unique_count_opened_email=30, unique_count_clicked_email=3, unique_count_placed_order=0, sum_revenue_placed_order=50) | more

    got = by(s.stage_email_campaigns(frame(spark, schemas.EMAIL_CAMPAIGNS, [
        mail(1, "WELCOME sample"), mail(2, "Cart promo", received=0), mail(3, "We win you back", sum_revenue_refunded_order=5),
        mail(4, "Re-engage", is_archived=True), mail(5, "x", status="draft"), mail(6, "x", is_archived=None), mail(7, None),
    ])), "campaign_id")
    assert set(got) == {1, 2, 3, 7}
    assert [got[i]["campaign_category"] for i in (1, 2, 3, 7)] == ["Welcome Series", "Cart Abandonment", "Winback", "Other"]
    assert (got[1]["open_rate"], got[1]["click_to_open_rate"], got[1]["bounce_rate"]) == (30.0, 10.0, None)
    assert (got[2]["open_rate"], got[2]["bounce_rate"], got[1]["revenue_per_converter"]) == (0.0, 0.0, 0.0)
    assert float(got[3]["net_revenue"]) == 45
    flows = by(s.stage_email_flows(frame(spark, schemas.EMAIL_FLOWS, [
        dict(flow_id=1, flow_name="Browse abandonment", status="live", is_archived=False),
        dict(flow_id=2, flow_name="Post purchase thanks", status="live", is_archived=False),
        dict(flow_id=3, flow_name="Birthday", status="live", is_archived=False)])), "flow_id")
    assert [flows[i]["flow_category"] for i in (1, 2, 3)] == ["Cart Abandonment", "Post-Purchase", "Lifecycle"]


def test_shipments(spark):
    def ship(n, pickup="2024-01-01 00:00", delivered="2024-01-06 02:00", days=5, quote=10, invoice=None):
        return dict(id=n, pickup_date=pickup and ts(pickup), tracking_delivery_date_actual=delivered and ts(delivered),
                    rate_transit_days=days, rate_total=quote, invoice_amount=invoice)

    got = by(s.stage_shipments(frame(spark, schemas.SHIPMENTS, [
        ship("a"), ship("b", days=4, invoice=12), ship("c", delivered=None), ship("d", days=None), ship("e", pickup=None)])), "shipment_id")
    assert [got[i]["is_on_time"] for i in "abcde"] == [True, False, None, None, None]
    assert got["a"]["actual_delivery_date"] == day("2024-01-06") and got["a"]["actual_delivery_at"] == ts("2024-01-05 18:00")
    assert (float(got["a"]["shipping_cost"]), float(got["b"]["shipping_cost"])) == (10, 12)
    assert got["a"]["cost_variance"] is None and float(got["b"]["cost_variance"]) == 2
    assert (got["b"]["transit_variance_days"], got["d"]["transit_variance_days"]) == (1, None)
