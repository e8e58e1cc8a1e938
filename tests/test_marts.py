

import pytest
from pyspark.sql import functions as F

from helpers import by, day, frame, ts
from shoploom.plans import consumers as u
from shoploom.plans import customers as c
from shoploom.plans import extensions as e
from shoploom.plans import marts as m
from shoploom.plans import reports as r
from shoploom.plans import staging as s
from shoploom.sources import schemas
from test_customers import classified, random_orders


@pytest.fixture(scope="module")
def small(spark):
    """A small random shop with a hot customer."""
    orders_rows, line_rows = random_orders(11, 200)
    orders = classified(spark, orders_rows, line_rows)
    funnel = c.customer_funnel(orders)
    facts = c.fct_orders(orders, funnel).cache()
    lines = s.stage_order_lines(frame(spark, schemas.ORDER_LINES, line_rows))
    extra = ("cancel_reason", "financial_status")
    emails = {o["email"] for o in orders_rows if o["email"]}
    people = s.stage_customers(frame(spark, schemas.CUSTOMERS, [
        dict(email=x, store="regular", updated_timestamp=ts("2024-01-01 00:00")) for x in emails]))
    dim = c.dim_customers(people, funnel, facts, F.lit(day("2024-02-01"))).cache()
    yield dict(orders=orders, funnel=funnel.cache(), facts=facts, lines=c.fct_order_lines(lines, facts, extra).cache(), dim=dim)
    spark.catalog.clearCache()


def ads(spark, rows):
    return frame(spark, "date_day date, channel string, spend decimal(18,2), conversions double, conversions_value decimal(18,2), clicks bigint, impressions bigint", rows)


def test_daily_counts_match_plain_distinct(spark, small):
    day_ads = ads(spark, [dict(date_day=day("2024-01-03"), channel="Facebook", spend=30, clicks=1)])
    got = m.daily_performance(small["facts"], day_ads)
    plain = small["facts"].groupBy(F.col("order_date").alias("date_day"), "store").agg(
        F.count_distinct("order_id").alias("total_orders"), F.count_distinct("email").alias("total_customers"),
        F.count_distinct(F.when(F.col("is_new_customer") == 1, F.col("email"))).alias("new_customers"),
        F.count_distinct(F.when(F.col("is_returning_customer") == 1, F.col("email"))).alias("returning_customers"),
        F.sum("net_sales").alias("total_revenue"), F.sum("product_quantity").alias("total_product_quantity"),
    )
    assert got.select(plain.columns).exceptAll(plain).isEmpty() and got.count() == plain.count()
    rows = by(got, "date_day")
    assert float(rows[day("2024-01-03")]["facebook_spend"]) == 30 and float(rows[day("2024-01-04")]["total_ad_spend"]) == 0
    assert rows[day("2024-01-04")]["roas"] == 0.0


def test_ad_spend_repeats_per_store_and_feeds_economics(spark):
    base = dict(order_date=day("2024-01-03"), order_type="Product Order", subtotal_price=100, total_discounts=20, lifetime_product_revenue=0)
    ddl = ("order_id bigint, email string, order_date date, store string, order_type string, customer_status string, salesperson string, "
           "shipping_state string, shipping_address_country string, subtotal_price decimal(18,2), total_discounts decimal(18,2), "
           "lifetime_product_revenue decimal(18,2)")
    orders = frame(spark, ddl, [
        base | dict(order_id=1, store="regular", customer_status="New Customer"), base | dict(order_id=1, store="commercial", customer_status="Other"),
        base | dict(order_id=2, store="regular", customer_status="New Customer", order_date=day("2024-01-09")),
        base | dict(order_id=3, store="regular", customer_status="New Customer", order_type="Other"),
        base | dict(order_id=4, store="regular", customer_status="Returning Customer", subtotal_price=0, total_discounts=0)])
    daily = frame(spark, "date_day date, store string, total_ad_spend decimal(18,2), new_customers bigint", [
        dict(date_day=day("2024-01-03"), store=x, total_ad_spend=100, new_customers=n) for x, n in (("regular", 3), ("commercial", 0))])
    got = by(m.unit_economics(orders, daily), "order_id", "store")
    assert len(got) == 4  # no fan-out where both stores use an id
    one = got[1, "regular"]
    assert float(one["allocated_ad_spend"]) == 33.33 and float(one["net_sales"]) == 80
    assert (one["contribution_margin_pct"], one["ad_spend_pct"], one["discount_rate_pct"]) == (58.34, 41.66, 20.0)
    assert float(got[2, "regular"]["allocated_ad_spend"]) == 0 and got[4, "regular"]["contribution_margin_pct"] == 0.0


def test_weekly_sales_match_plain_distinct(small):
    group = ["week_start_date", "sku", "title", "color", "line_item_type", "store"]
    lines = small["lines"].unionByName(small["lines"].limit(5))  # lines are not deduplicated
    got = m.weekly_product_sales(lines)
    plain = lines.withColumn("week_start_date", F.date_sub("order_date", F.dayofweek("order_date") - 1)).groupBy(*group).agg(
        F.count_distinct("order_id").alias("order_count"), F.count_distinct("order_line_id").alias("line_item_count"),
        F.count_distinct("email").alias("unique_customers"), F.sum("quantity").alias("total_quantity"),
        F.count_distinct(F.when(F.col("is_new_customer") == 1, F.col("email"))).alias("new_customers"),
        F.sum("is_converted_purchase").alias("converted_purchases"), F.sum("line_total").cast("double").alias("total_revenue"),
    )
    shown = got.withColumn("total_revenue", F.col("total_revenue").cast("double")).select(plain.columns)
    assert shown.exceptAll(plain).isEmpty() and got.count() == plain.count()


def test_cohorts(small):
    got = m.monthly_cohorts(small["dim"], small["facts"])
    rows = got.collect()
    assert rows and all(r.active_customers <= r.cohort_size for r in rows)
    firsts = [r for r in rows if r.months_since_first_order == 0]
    assert all(r.active_customers == r.cohort_size and r.retention_rate == 100.0 for r in firsts)
    assert all(r.calendar_month == r.cohort_month for r in firsts)
    assert sum(r.cohort_size for r in firsts) == small["dim"].filter("first_product_order_date IS NOT NULL").count()


def test_conversions_match_plain_distinct(small):
    got = by(m.sample_conversions(small["funnel"], small["dim"], small["facts"]), "email")
    assert set(got) == {r.email for r in small["funnel"].collect() if r.first_sample_order_date}
    orders = [r for r in small["facts"].collect() if r.is_product_order == 1]
    for email, row in got.items():
        gaps = [(o.order_date - row["first_sample_order_date"]).days for o in orders if o.email == email]
        for n in (15, 30, 60, 120):
            assert row[f"product_orders_within_{n}d"] == sum(g <= n for g in gaps)
        assert row["hybrid_conversion_ind"] >= max(row["conversion_ind"], row["household_conversion_ind"] or 0)
        if row["days_to_order"] is None:
            assert row["conversion_window_bucket"] == "No Conversion"


def test_hybrid_bucket_without_gaps(spark, small):
    """A household that bought but never sampled lands in the last bucket."""
    one = small["funnel"].filter("first_sample_order_date IS NOT NULL").limit(1).withColumns({
        "days_to_order": F.lit(None).cast("int"), "household_days_to_order": F.lit(None).cast("int"),
        "conversion_ind": F.lit(0), "household_conversion_ind": F.lit(1), "hybrid_conversion_ind": F.lit(1)})
    row = m.sample_conversions(one, small["dim"], small["facts"]).first()
    assert row.hybrid_conversion_window_bucket == "120+ days" and row.conversion_window_bucket == "No Conversion"


@pytest.mark.parametrize("text, name, week", [
    ("2024-01-01", "New Years", 1), ("2024-07-04", "July 4th", 1), ("2024-12-25", "Christmas", 1), ("2024-11-28", "Thanksgiving", 1),
    ("2024-11-29", "Black Friday", 1), ("2024-12-02", None, 0), ("2023-11-27", "Cyber Monday", 1), ("2024-11-25", "Cyber Monday", 1),
    ("2024-01-04", None, 1), ("2024-07-01", None, 1), ("2024-12-01", None, 1), ("2024-11-21", None, 0), ("2024-11-30", None, 0),
])
def test_holidays(spark, text, name, week):
    lines = frame(spark, "order_date date, store string, sku string, line_item_type string, color string, email string, order_id bigint, "
                         "order_type string, quantity bigint, line_total decimal(18,2), price decimal(18,2)",
                  [dict(order_date=day(text), store="regular", sku="FL-1", line_item_type="Product", order_type="Product Order", order_id=1, quantity=1)])
    daily = frame(spark, "date_day date, store string, total_ad_spend decimal(18,2), new_customers bigint", [])
    row = m.demand_features(lines, daily).first()
    assert (row.holiday_name, row.is_holiday_week) == (name, week)
    assert row.quantity_sold_stddev_28d is None and row.demand_volatility_cv is None and row.daily_ad_spend == 0


def test_demand_lags_count_rows(spark):
    ddl = ("order_date date, store string, sku string, line_item_type string, color string, email string, order_id bigint, "
           "order_type string, quantity bigint, line_total decimal(18,2), price decimal(18,2)")
    days = [f"2024-01-{d:02d}" for d in range(1, 30, 2)]
    base = dict(store="regular", sku="FL-1", line_item_type="Product", order_type="Product Order")
    rows = [base | dict(order_date=day(d), order_id=i, email=f"e{i % 2}", quantity=i + 1) for i, d in enumerate(days)]
    rows += [base | dict(order_date=day(days[0]), order_id=0, email="e0", quantity=4), base | dict(order_date=day(days[0]), order_id=50, email="e0", quantity=0),
             base | dict(order_date=day(days[1]), order_id=77, quantity=9, line_item_type="Sample"), base | dict(order_date=day(days[1]), order_id=78, sku=None, quantity=9)]
    daily = frame(spark, "date_day date, store string, total_ad_spend decimal(18,2), new_customers bigint", [])
    got = by(m.demand_features(frame(spark, ddl, rows), daily), "date_day")
    first, eighth = got[day(days[0])], got[day(days[7])]
    assert (first["quantity_sold"], first["order_count"], first["unique_customers"]) == (5, 2, 1)
    assert eighth["quantity_sold_lag_7d"] == 5 and eighth["quantity_change_pct_7d"] == 60.0
    assert eighth["days_since_first_sale"] == 14 and eighth["days_since_last_sale"] == 2
    assert eighth["quantity_sold_avg_7d"] == sum(range(2, 9)) / 7


def test_sessions(spark):
    ddl = ("user_pseudo_id string, ga_session_id bigint, event_timestamp_pt timestamp_ntz, page_type string, event_name string, is_add_to_cart int, "
           "is_begin_checkout int, is_purchase int, transaction_id string, transaction_value double")

    def ev(user, session, at, page="other", name="page_view", **more):
        return dict(user_pseudo_id=user, ga_session_id=session, event_timestamp_pt=ts(f"2024-01-01 {at}"), page_type=page, event_name=name,
                    is_add_to_cart=0, is_begin_checkout=0, is_purchase=0) | more

    events = frame(spark, ddl, [
        ev("a", 1, "10:00:00", "homepage"), ev("a", 1, "10:01:59", "product_list"), ev("a", 1, "10:02:30", name="purchase", is_purchase=1,
                                                                                     transaction_id="T1", transaction_value=9.5),
        ev("a", 2, "10:00:00", is_begin_checkout=1), ev("b", 1, "10:00:00"), ev(None, 1, "10:00:00"), ev("b", None, "10:00:00"),
    ])
    got = by(m.session_funnel(events), "user_pseudo_id", "ga_session_id")
    assert set(got) == {("a", 1), ("a", 2), ("b", 1)}
    full = got["a", 1]
    assert (full["deepest_funnel_stage"], full["funnel_stage_depth"], full["is_converted_session"]) == ("Purchase", 6, 1)
    assert (full["session_duration_minutes"], full["dropped_at_plp"], full["dropped_at_homepage"], full["unique_event_types"]) == (2, 1, 0, 2)
    assert got["a", 2]["reached_add_to_cart"] == 0 and got["a", 2]["dropped_at_checkout"] == 1
    assert (got["b", 1]["deepest_funnel_stage"], got["b", 1]["funnel_stage_depth"]) == ("Other", 0)
    daily = by(m.web_funnel(m.session_funnel(events)), "deepest_funnel_stage")
    assert daily["Purchase"]["overall_conversion_rate"] == 100.0 and daily["Purchase"]["avg_order_value"] == 9.5
    assert daily["Other"]["homepage_to_plp_rate"] == 0.0 and daily["Begin Checkout"]["checkout_dropoff_rate"] == 100.0


WEEKLY = "order_date date, store string, sku string, line_item_type string, order_id bigint, quantity bigint, line_total decimal(18,2), cancel_reason string, financial_status string"


def weekly_lines(spark, rows):
    lookup = frame(spark, schemas.SKU_LOOKUP, [
        dict(sku="FL-MR-1", product_line="Modin", product_category="Signature", bevel="Micro"),
        dict(sku="FL-SR-1", product_line="Silvan", product_category="Base"), dict(sku="FL-SR-2", product_line="Silvan", product_category="7 inch"),
        dict(sku="FL-AR-1", product_line="Arista", product_category="Wide")])
    return r.enrich_lines(frame(spark, WEEKLY, rows), lookup)


def sold(sku, date, total, order=1, kind="Product", **more):
    return dict(order_date=day(date), store="regular", sku=sku, line_item_type=kind, order_id=order, quantity=1, line_total=total) | more


def test_product_lines(spark):
    got = by(weekly_lines(spark, [sold(x, "2024-12-30", 1) for x in
                                  ("FL-MR-1", "FL-SR-1", "FL-SR-2", "FL-AR-1", "FL-MR-9", "SA-PE-9", "AC-9", "ZZ", "fl-mr-9")]), "sku")
    assert {k: (v["product_line"], v["wbr_product_subline"]) for k, v in got.items()} == {
        "FL-MR-1": ("Modin", "Signature Micro"), "FL-SR-1": ("Silvan", '6"'), "FL-SR-2": ("Silvan", '7"'), "FL-AR-1": ("Arista", "Wide"),
        "FL-MR-9": ("Modin", None), "SA-PE-9": ("Provenance", None), "AC-9": ("Accessories", None), "ZZ": ("Other", None), "fl-mr-9": ("Other", None)}
    assert (got["ZZ"]["iso_year"], got["ZZ"]["iso_week"], got["ZZ"]["iso_week_start"]) == (2025, 1, day("2024-12-30"))


def test_sku_ranks_and_frames(spark):
    import datetime as dt
    weeks = [(dt.date(2024, 1, 1) + dt.timedelta(weeks=w)).isoformat() for w in range(13) if w != 3]  # a missing week
    rows = [sold("FL-MR-1", d, 10 + i, order=i) for i, d in enumerate(weeks)]
    rows += [sold("FL-SR-1", d, 11, order=i) for i, d in enumerate(weeks[:2])]
    rows += [sold("FL-MR-1", weeks[0], 999, order=98, cancel_reason="x"), sold("FL-MR-1", weeks[0], 999, store="commercial"), sold("SA-1", weeks[0], 9, kind="Sample")]
    got = by(r.sku_performance(weekly_lines(spark, rows)), "sku", "week_start")
    last = got["FL-MR-1", day(weeks[-1])]
    assert float(last["t6w_net_dollars"]) == sum(range(16, 22)) and float(last["p6w_net_dollars"]) == sum(range(10, 16))
    assert last["t6w_week_count"] == 6 and float(last["wow_delta_dollars"]) == 1
    assert got["FL-MR-1", day(weeks[5])]["p6w_net_dollars"] is None and got["FL-MR-1", day(weeks[6])]["t6w_change_pct"] == (81 - 10) / 10
    first, second = got["FL-MR-1", day(weeks[0])], got["FL-SR-1", day(weeks[0])]
    assert (first["weekly_rank"], second["weekly_rank"], first["prev_week_rank"]) == (2, 1, None)
    tie = [got[x, day(weeks[1])] for x in ("FL-MR-1", "FL-SR-1")]
    assert [t["weekly_rank"] for t in tie] == [1, 2] and [t["prev_week_rank"] for t in tie] == [2, 1]
    assert last["delta_vs_dtc_pct"] == 0.0


def test_net_sales_weeks_and_years(spark):
    ddl = "order_id bigint, email string, order_date date, store string, net_sales decimal(18,2), cancel_reason string"
    rows = [dict(order_id=i, email="a", order_date=day(d), store="regular", net_sales=v) for i, (d, v) in enumerate(
        [("2023-01-04", 50), ("2024-01-03", 100), ("2024-01-10", 0), ("2024-01-24", 30), ("2024-12-31", 7)])]
    rows.append(dict(order_id=9, order_date=day("2024-01-03"), net_sales=999, cancel_reason="x"))
    got = by(r.net_sales(frame(spark, ddl, rows)), "grain", "period_start", "month_start")
    w = got["weekly", day("2024-01-01"), None]
    assert (float(w["prior_year_net_sales"]), w["yoy_change_pct"], w["wow_change_pct"]) == (50, 1.0, 1.0)
    assert got["weekly", day("2024-01-08"), None]["wow_change_pct"] == -1.0
    assert got["weekly", day("2024-01-22"), None]["wow_change_pct"] is None  # the week before holds zero
    assert got["weekly", day("2024-12-30"), None]["iso_year"] == 2025
    assert float(got["weekly", day("2024-12-30"), None]["prior_year_net_sales"]) == 100
    assert float(got["monthly", None, day("2024-01-01")]["net_sales"]) == 130 and got["monthly", None, day("2024-12-01")]["iso_year"] == 2024


def test_channels(spark):
    rows = [("commercial", "x", "Comm."), ("regular", "DTC", "DTC"), ("regular", "MSR Team", "MSR"), ("regular", "Multi Ind", "MSR"),
            ("regular", "Indy", "Ind. Retail"), ("regular", "Jo Lee", "Ind. Retail"), ("regular", None, "DTC"), ("other", "Jo", "DTC")]
    df = frame(spark, "store string, salesperson string, want string", [dict(store=a, salesperson=b, want=w) for a, b, w in rows])
    assert df.filter(~r.channel().eqNullSafe(F.col("want"))).isEmpty()


def test_launch_running_totals(spark):
    rows = [sold("SA-PE-75-A", "2024-01-01", 1, kind="Sample"), sold("SA-PE-75-B", "2024-01-01", 1, kind="Sample"),
            sold("SA-PE-75-A", "2024-01-03", 1, 2, kind="Sample"), sold("SA-PE-105", "2024-01-02", 1, kind="Sample"), sold("SA-PE-X", "2024-01-02", 1, kind="Sample")]
    got = by(r.launch_sampling(weekly_lines(spark, rows)), "sku", "order_date")
    a = got["SA-PE-75-A", day("2024-01-01")]
    assert (a["size_variant"], a["size_daily_total"], a["size_cumulative"], a["sku_cumulative"]) == ('7.5"', 2, 2, 1)
    later = got["SA-PE-75-A", day("2024-01-03")]
    assert (later["size_cumulative"], later["sku_cumulative"]) == (3, 2)
    assert got["SA-PE-105", day("2024-01-02")]["daily_grand_total"] == 2 and got["SA-PE-X", day("2024-01-02")]["size_variant"] == "Unknown"


def test_share_of_week_adds_up(small):
    rows = r.channel_mix(small["facts"]).collect()
    totals = {}
    for x in rows:
        totals[x.iso_week] = totals.get(x.iso_week, 0) + x.pct_of_total
    assert all(abs(v - 1) < 1e-9 for v in totals.values())


def test_product_category_codes(spark):
    rows = [("FL-MR-1-S", "Product", "Signature"), ("FL-MR-7210", "Product", "Signature"), ("FL-4805", "Product", "Base"), ("FL-7T", "Product", "Silvan Hardwood"),
            ("SA-X-7-CUT", "Sample", "Silvan Hardwood"), ("SA-1-C-2", "Sample", "Craftsman"), ("SA-1", "Sample", "Other"), ("AC-S", "Accessories", "Other")]
    df = frame(spark, "sku string, line_item_type string, want string", [dict(sku=a, line_item_type=b, want=w) for a, b, w in rows])
    assert df.withColumn("got", e.product_category(e.category_code())).filter("got <> want").isEmpty()


def test_consumer_queries_on_small_shop(small):
    conversions = m.sample_conversions(small["funnel"], small["dim"], small["facts"])
    lift = u.conversion_lift(conversions, F.lit(day("2020-01-01"))).first()
    assert lift.total_samplers == conversions.count() and lift.conversion_rate_lift >= 0
    homes = u.multi_email_households(conversions).collect()
    assert homes and all(len(h.emails_in_household.split(", ")) <= h.household_email_count for h in homes)
