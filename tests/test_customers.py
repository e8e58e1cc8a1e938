import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import by, day, frame, ts
from shoploom.functions import rules
from shoploom.operators.windows import running_totals
from shoploom.plans import customers as c
from shoploom.plans import staging as s
from shoploom.sources import schemas


def order(n, email="a@x.com", when="2024-01-05 20:00", store="regular", subtotal=1000, **more):
    return dict(order_id=n, store=store, email=email, processed_timestamp=ts(when), subtotal_price_pres_amount=subtotal,
                total_discounts_pres_amount=10, refund_subtotal=None, _fivetran_synced=ts(when),
                shipping_address_address_1="1 Main St.", shipping_address_zip="90001", shipping_address_country="US") | more


def line(n, order_id, sku="FL-MR-1-S-1", title="Oak Board", store="regular", qty=2, total=100, price=1):
    return dict(order_line_id=str(n), order_id=order_id, store=store, sku=sku, title=title, quantity=qty, price_pres_amount=total, variant_price=price)


def classified(spark, orders, lines):
    o = s.stage_orders(frame(spark, schemas.ORDERS, orders))
    return c.classify_orders(o, s.stage_order_lines(frame(spark, schemas.ORDER_LINES, lines)))


SAMPLE, ACCESSORY = "SA-MR-1-B-1", "AC-1"


def test_order_types(spark):
    orders = [order(i) for i in range(1, 7)] + [order(7, subtotal=250), order(8, store="commercial"), order(8), order(9, subtotal=0)]
    lines = [
        line(1, 1), line(2, 1, SAMPLE), line(3, 2, SAMPLE, "Oak Cut"), line(4, 2, SAMPLE, "Elm Plank"), line(5, 3, ACCESSORY),
        line(6, 4, ACCESSORY), line(7, 4, SAMPLE), line(8, 5, qty=0), line(9, 7), line(10, 8, store="commercial"),
        line(11, 9), line(12, 2, SAMPLE, "Elm Plank"), line(13, 99),
    ]
    got = by(classified(spark, orders, lines), "order_id", "store")
    types = {k: v["order_type"] for k, v in got.items()}
    assert types == {
        (1, "regular"): "Product Order", (2, "regular"): "Sample Order", (3, "regular"): "Accessory Only", (4, "regular"): "Sample Order",
        (5, "regular"): "Other", (6, "regular"): "Other", (7, "regular"): "Other", (8, "commercial"): "Product Order",
        (8, "regular"): "Other", (9, "regular"): "Other",
    }
    two, six, nine = got[2, "regular"], got[6, "regular"], got[9, "regular"]
    assert (two["line_item_count"], two["distinct_sku_count"], two["sample_color_count"], two["product_color_count"]) == (3, 1, 2, 0)
    assert (two["cut_sample_quantity"], two["plank_sample_quantity"], two["sampled_base"], two["sampled_silvan"]) == (2, 4, 1, 0)
    assert (six["line_item_count"], six["distinct_sku_count"], six["total_line_items_revenue"], six["avg_unit_price"]) == (0, 0, 0, 0.0)
    assert (nine["discount_rate"], two["discount_rate"], two["line_item_discount"]) == (0.0, 0.01, 10.0)


def test_households(spark):
    rows = [
        order(1), order(2, email="b@x.com", shipping_address_address_1="1  main st", shipping_address_zip="90001-1234"),
        order(3, email="c@x.com", shipping_address_zip="90002"), order(4, email=None), order(5, email="z@amazon.com"),
        order(6, shipping_address_address_1=None), order(7, shipping_address_country="CA", shipping_address_zip="V6B 1A1"),
    ]
    got = by(c.households(s.stage_orders(frame(spark, schemas.ORDERS, rows))), "order_id")
    assert set(got) == {1, 2, 3, 7}
    assert got[1]["household_key"] == got[2]["household_key"] == "1 main st|90001"
    assert got[1]["household_id"] == got[2]["household_id"] != got[3]["household_id"]
    assert got[7]["household_key"] == "1 main st|v6b1a1"


def funnel_of(spark, history):
    """history: rows of (email, day offset, kind, sampled category or None, address)"""
    orders, lines = [], []
    for i, (email, offset, kind, category, address) in enumerate(history):
        when = (dt.datetime(2024, 1, 1, 20) + dt.timedelta(days=offset)).isoformat()
        orders.append(order(i, email=email, when=when, shipping_address_address_1=address))
        if kind == "product":
            lines.append(line(f"{i}", i))
        elif kind:
            lines.append(line(f"{i}", i, f"SA-{category}-1", f"Oak {kind}"))
    return by(c.customer_funnel(classified(spark, orders, lines)), "email")


def test_conversion_windows(spark):
    history = []
    for gap in (15, 16, 30, 31, 60, 61, 120, 121, -3, 0):
        history += [(f"g{gap}", 200, "cut", "MR-S", None), (f"g{gap}", 200 + gap, "product", None, None)]
    history += [("only", 0, "plank", "MR-B", None), ("never", 0, "product", None, None)]
    got = funnel_of(spark, history)
    for gap in (15, 16, 30, 31, 60, 61, 120, 121, -3, 0):
        r = got[f"g{gap}"]
        assert r["days_to_order"] == gap
        assert [r[f"converted_within_{n}d"] for n in (15, 30, 60, 120)] == [int(gap <= n) for n in (15, 30, 60, 120)]
        assert r["conversion_ind"] == 1 and r["household_conversion_ind"] is None and r["hybrid_conversion_ind"] == 1
        # The first sample must come strictly before the purchase.
        assert r["sample_order_type"] == ("Signature Sample Only" if gap > 0 else "No Samples")
    assert got["only"]["days_to_order"] is None and got["only"]["converted_within_120d"] == 0
    assert got["only"]["cohort_month"] == day("2024-01-01") and got["never"]["sample_order_type"] == "No Samples"


def test_households_convert_across_emails(spark):
    got = funnel_of(spark, [
        ("work", 0, "cut", "MR-B", "9 Elm"), ("home", 10, "product", None, "9 Elm."),
        ("mover", 0, "cut", "MR-C", "9 Elm"), ("mover", 5, "cut", "MR-B", "7 Oak"), ("x@amazon.com", 1, "product", None, "7 Oak"),
    ])
    assert set(got) == {"work", "home", "mover"}
    assert (got["work"]["conversion_ind"], got["work"]["household_conversion_ind"], got["work"]["hybrid_conversion_ind"]) == (0, 1, 1)
    assert got["work"]["household_email_count"] == 3 and got["work"]["household_days_to_order"] == 10
    # The newest order decides the household; there nobody bought.
    assert got["mover"]["household_email_count"] == 1 and got["mover"]["hybrid_conversion_ind"] == 0
    assert got["mover"]["sample_order_type"] == "Base and Craftsman Sample Only"


def test_sample_order_types(spark):
    mixes = {
        ("B",): "Base Sample Only", ("S",): "Signature Sample Only", ("C",): "Craftsman Sample Only", ("7",): "Silvan Sample Only",
        ("B", "S"): "Base and Signature Sample Only", ("B", "C"): "Base and Craftsman Sample Only",
        ("S", "C"): "Signature and Craftsman Sample Only", ("B", "7"): "Mixed or Other", ("B", "S", "C"): "Mixed or Other", ("X",): "Mixed or Other",
    }
    history = [("-".join(m).lower(), i, "cut", f"MR-{k}", None) for m in mixes for i, k in enumerate(m)]
    got = funnel_of(spark, history)
    assert {k: got["-".join(k).lower()]["sample_order_type"] for k in mixes} == mixes


def random_orders(seed, n=120):
    rnd = random.Random(seed)
    orders, lines = [], []
    for i in range(n):
        email = rnd.choice(["hot@x.com"] * 4 + [f"e{k}@x.com" for k in range(8)] + [None])
        when = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 9))
        orders.append(order(i, email=email, when=when.isoformat(), subtotal=rnd.choice([100, 300, 900])))
        for k in range(rnd.randrange(3)):
            lines.append(line(f"{i}-{k}", i, rnd.choice(["FL-1", SAMPLE, ACCESSORY]), total=rnd.randrange(1, 500)))
    return orders, lines


def test_lifetime_matches_brute_force(spark):
    orders = classified(spark, *random_orders(7))
    rows = [r.asDict() for r in orders.collect() if r.email]
    got = by(c.lifetime_metrics(orders), "order_id")
    assert set(got) == {r["order_id"] for r in rows}
    history = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["processed_at"], r["order_id"])):
        past = history[r["email"]]
        past.append(r)
        g = got[r["order_id"]]
        assert g["order_sequence_number"] == g["lifetime_total_orders"] == len(past)
        assert g["lifetime_product_orders"] == sum(p["is_product_order"] for p in past)
        assert g["lifetime_total_revenue"] == sum(p["net_sales"] for p in past)
        assert g["lifetime_sample_revenue"] == sum(p["sample_revenue"] for p in past)
        for kind in ("product", "sample"):
            same = [p for p in past if p[f"is_{kind}_order"] == r[f"is_{kind}_order"]]
            assert g[f"{kind}_order_sequence_number"] == len(same)
            assert g[f"is_first_{kind}_order"] == int(r[f"is_{kind}_order"] == 1 and len(same) == 1)
        assert g["days_since_first_order"] == (r["order_date"] - past[0]["order_date"]).days


def test_running_totals_equal_one_window(spark):
    df = spark.range(5000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k", "cast(id * 7919 % 97 AS int) AS step", "id % 11 AS v"
    )
    got = running_totals(df, "k", "step", ["step", "id"], {"total": F.col("v"), "n": F.lit(1)}, {"low": F.col("id")})
    want = df.selectExpr(
        "id", "sum(v) OVER (PARTITION BY k ORDER BY step, id ROWS UNBOUNDED PRECEDING) AS total",
        "row_number() OVER (PARTITION BY k ORDER BY step, id) AS n", "min(id) OVER (PARTITION BY k) AS low",
    )
    assert got.select("id", "total", "n", "low").exceptAll(want.selectExpr("id", "total", "cast(n AS bigint) n", "low")).isEmpty()
    assert got.count() == 5000


def test_order_and_line_facts(spark):
    orders = classified(spark, [
        order(1, when="2024-01-05 20:00"), order(2, when="2024-01-07 20:00"), order(3, when="2024-01-07 21:00"),
        order(4, when="2024-01-09 20:00"), order(5, when="2024-01-10 20:00"), order(6, email="b@x.com"), order(7, email=None),
    ], [line(1, 1, SAMPLE), line(2, 2), line(3, 3), line(4, 4, SAMPLE), line(5, 5), line(6, 6, ACCESSORY), line(7, 7)])
    facts = c.fct_orders(orders, c.customer_funnel(orders))
    got = by(facts, "order_id")
    assert {k: v["customer_status"] for k, v in got.items()} == {
        1: "New Customer Sample", 2: "New Customer", 3: "Other", 4: "Returning Sample", 5: "Returning Customer", 6: "Other"}
    assert [got[k]["is_returning_customer"] for k in (2, 3, 5)] == [0, 0, 1]
    lines = frame(spark, schemas.ORDER_LINES, [line(2, 2), line(5, 5), line(5, 5), line(1, 1, SAMPLE), line(8, 2, store="commercial"), line(9, 99)])
    rows = c.fct_order_lines(s.stage_order_lines(lines), facts).collect()
    assert sorted(r.order_line_id for r in rows) == ["1", "2", "5", "5"]
    flags = {r.order_line_id: (r.is_converted_purchase, r.days_from_sample_to_purchase) for r in rows}
    assert flags == {"1": (0, None), "2": (1, 2), "5": (1, 5)}


def test_customer_dimension(spark):
    orders = classified(spark, [
        order(1, when="2024-01-05 20:00", shipping_address_province="CA", shipping_address_city=None),
        order(2, when="2024-01-06 20:00", shipping_address_province="CA", shipping_address_city=None, store="commercial"),
        order(3, when="2024-01-07 20:00", shipping_address_province="AZ", shipping_address_city="Yuma"),
        order(4, when="2024-01-08 20:00", shipping_address_city="Nowhere", store="commercial"),
        order(5, email="b@x.com"),
    ], [line(1, 1, total=300), line(2, 2, store="commercial", total=300), line(3, 5, SAMPLE)])
    funnel = c.customer_funnel(orders)
    people = s.stage_customers(frame(spark, schemas.CUSTOMERS, [
        dict(email=e, store="regular", updated_timestamp=ts("2024-01-01 00:00")) for e in ("a@x.com", "b@x.com", "none@x.com")]))
    got = by(c.dim_customers(people, funnel, c.fct_orders(orders, funnel), F.lit(day("2024-02-01"))), "email")
    a, b, none = got["a@x.com"], got["b@x.com"], got["none@x.com"]
    assert (a["primary_shipping_state"], a["primary_shipping_city"]) == ("CA", None)  # NULL counts as a value
    assert a["primary_store"] == "commercial"  # a tie takes the lowest name
    assert (a["regular_order_count"], a["commercial_order_count"], a["is_repeat_product_customer"]) == (2, 2, 1)
    assert a["customer_segment"] == "Low Value" and a["average_product_order_value"] == 300.0
    assert a["days_since_last_order"] == 24 and a["customer_tenure_days"] == 27
    assert b["customer_segment"] == "Sample Only" and b["has_ordered_samples"] == 1
    assert none["customer_segment"] == "No Purchase" and none["lifetime_total_orders"] == 0 and none["days_since_last_order"] is None
    assert len(got) == 3 and rules.SEGMENTS[2][0] == 500
    assert isinstance(a["lifetime_total_revenue"], Decimal)
