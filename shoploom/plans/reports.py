"""Weekly business reports. All weeks are ISO weeks; lags and frames count weeks present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.functions import rules
from shoploom.operators.ranges import Ranged
from shoploom.operators.relational import stack
from shoploom.operators.windows import prior, same_week_last_year, trailing

WEEK = ["iso_year", "iso_week", "week_start"]
TRAILING_WEEKS = 6


def with_iso_week(df: DataFrame, day: str = "order_date", start: str = "week_start") -> DataFrame:
    return df.withColumns({"iso_year": x.iso_year(day), "iso_week": x.iso_week(day), start: x.iso_week_start(day)})


# Column names.
ATTRIBUTES = ["product_line", "product_category", "bevel", "color_code", "color_name"]


def look_up(lines: DataFrame, sku_lookup: DataFrame) -> DataFrame:
    """Lines with the attributes of their sku. The lookup is joined without a hint: Spark broadcasts it while its measured size
    allows, and else shuffles lines by sku, which costs less before they carry their order's context.
    """
    return lines.join(sku_lookup.select("sku", *ATTRIBUTES), "sku", "left")


def enrich_lines(lines: DataFrame, sku_lookup: DataFrame | None = None) -> DataFrame:
    """Lines with product line, sub-line, cancellation and ISO week.

    `lines` is the line fact carrying `cancel_reason` and `financial_status` of its order, and, if there is no `sku_lookup`,
    the attributes of its sku.
    """
    fallback = x.ladder([(x.like_any("sku", patterns), label) for label, patterns in rules.PRODUCT_LINES], "Other")
    arms = []
    for line, category, bevel, label in rules.SUBLINES:
        hit = (F.col("product_line") == line) & F.col("product_category").like(category)
        arms.append((hit if bevel is None else hit & (F.col("bevel") == bevel), label))
    joined = (lines if sku_lookup is None else look_up(lines, sku_lookup)).withColumns({
        "is_cancelled": x.flag(F.col("cancel_reason").isNotNull()),
        "wbr_product_subline": x.ladder(arms, F.col("product_category")),
    })
    return with_iso_week(
        joined.withColumn("product_line", F.coalesce("product_line", fallback)), start="iso_week_start"
    )


def _not_cancelled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("cancel_reason").isNull())


def channel(rows=rules.CHANNELS) -> Column:
    """Sales channel from store and salesperson; other named sellers of the regular store are retail."""
    seller = F.lower("salesperson")
    return x.ladder(
        [
            (F.col("store") == "commercial", rules.COMMERCIAL_CHANNEL),
            (F.col("salesperson") == "DTC", rules.DIRECT_CHANNEL),
            *[(x.like_any(seller, patterns), label) for label, patterns in rows],
            ((F.col("store") == "regular") & (F.col("salesperson") != "DTC"), rules.NAMED_SELLER_CHANNEL),
        ],
        rules.DIRECT_CHANNEL,
    )


def channel_mix(orders: DataFrame) -> DataFrame:
    """Week and channel: net sales, orders, share of the week, change on the week before.

    Both grains start from the same totals per order and channel, so facts are read and shuffled once.
    """
    tagged = with_iso_week(_not_cancelled(orders)).withColumn("wbr_channel", channel())
    per_order = tagged.groupBy(*WEEK, "wbr_channel", "order_id").agg(F.sum("net_sales").alias("net_sales"))
    by_channel = per_order.groupBy(*WEEK, "wbr_channel").agg(
        F.sum("net_sales").alias("channel_net_sales"), F.count("order_id").alias("channel_orders")
    )
    by_week = per_order.groupBy("iso_year", "iso_week").agg(
        F.sum("net_sales").alias("total_net_sales"), F.count_distinct("order_id").alias("total_orders")
    )
    w = W.partitionBy("wbr_channel").orderBy("week_start")
    before = F.lag("channel_net_sales").over(w)
    return by_channel.join(by_week, ["iso_year", "iso_week"]).withColumns({
        "pct_of_total": x.safe_divide("channel_net_sales", "total_net_sales"),
        "prev_week_channel_sales": before,
        "wow_change_pct": x.relative_change("channel_net_sales", before),
    })


def net_sales(orders: DataFrame) -> DataFrame:
    """Weekly net sales with change on the week and the year before, and monthly net sales.

    Facts are read once: an order counts as itself, with its sales, and for its email. Tasks bring these narrow rows down
    to one per day and order or email before they are shuffled; weeks and months start from them.
    """
    as_order = F.struct(F.lit("order").alias("kind"), F.col("order_id").cast("string").alias("value"), F.col("net_sales").alias("amount"))
    as_email = F.struct(F.lit("email").alias("kind"), F.col("email").alias("value"), F.lit(None).cast("decimal(19,2)").alias("amount"))
    daily = (
        _not_cancelled(orders).select("order_date", F.explode(F.array(as_order, as_email)).alias("one")).select("order_date", "one.*")
        .groupBy("order_date", "kind", "value").agg(F.sum("amount").alias("amount"))
    )

    def per_period(days: DataFrame, *period: str) -> DataFrame:
        known = F.col("value").isNotNull()
        return days.groupBy(*period, "kind", "value").agg(F.sum("amount").alias("amount")).groupBy(*period).agg(
            F.sum("amount").alias("net_sales"), F.count_if(known & (F.col("kind") == "order")).alias("total_orders"),
            F.count_if(known & (F.col("kind") == "email")).alias("unique_customers"),
        )

    weekly = per_period(with_iso_week(daily, start="period_start"), "iso_year", "iso_week", "period_start")
    before = F.lag("net_sales").over(W.orderBy("period_start"))  # one row per week
    weekly = weekly.withColumns({
        "grain": F.lit("weekly"),
        "prev_week_net_sales": before, "wow_change_pct": x.relative_change("net_sales", before),
        "prior_year_net_sales": same_week_last_year("net_sales"),
    }).withColumn("yoy_change_pct", x.relative_change("net_sales", "prior_year_net_sales"))
    monthly = per_period(daily.withColumn("month_start", x.month_start("order_date")), "month_start").withColumns({
        "grain": F.lit("monthly"), "iso_year": F.year("month_start"),
    })
    return stack(weekly, monthly)


def product_performance(lines: DataFrame) -> DataFrame:
    """Product line and sub-line by week: revenue, share, change on the week before, trailing six weeks.

    Both grains start from the same totals per order, so lines are read and shuffled once.
    """
    sold = lines.filter(
        (F.col("line_item_type") == rules.PRODUCT) & (F.col("is_cancelled") == 0) & (F.col("store") == "regular")
        & F.col("product_line").isNotNull()
    ).withColumn("week_start", F.col("iso_week_start"))
    per_order = sold.groupBy(*WEEK, "product_line", "wbr_product_subline", "order_id").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units_sold")
    )
    sums = [F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold")]
    by_line = per_order.groupBy(*WEEK, "product_line").agg(*sums, F.count_distinct("order_id").alias("order_count"))
    by_subline = per_order.groupBy(*WEEK, "product_line", "wbr_product_subline").agg(
        *sums, F.count("order_id").alias("order_count")
    )
    week, parent = W.partitionBy("iso_year", "iso_week"), W.partitionBy("iso_year", "iso_week", "product_line")

    def enriched(df, grain, total, *keys):
        w = W.partitionBy(*keys).orderBy("week_start")
        before = F.lag("revenue").over(w)
        return df.withColumn("total_revenue", total).withColumns({
            "grain": F.lit(grain),
            "pct_of_total": x.safe_divide("revenue", "total_revenue"),
            "prev_week_revenue": before,
            "wow_change_dollars": F.col("revenue") - before,
            "wow_change_pct": x.relative_change("revenue", before),
            "t6w_revenue": trailing("revenue", w, TRAILING_WEEKS),
        })

    return stack(
        enriched(by_line, "product_line", F.sum("revenue").over(week), "product_line"),
        enriched(by_subline, "subline", F.sum("revenue").over(parent), "product_line", "wbr_product_subline"),
    )


def _by_week(df: DataFrame, *order: str) -> Ranged:
    """Rows in order within their week. Ties go by sku, then by the remaining key. A week's skus are ranked by several tasks."""
    return Ranged(df, ["iso_year", "iso_week"], order)


def sku_performance(lines: DataFrame) -> DataFrame:
    """Sku by week: rank, change, trailing and prior six weeks with ranks, change against all skus.

    Ranks are found across ranges, which are written on the way.
    """
    group = [*WEEK, "sku", "product_line", "wbr_product_subline"]
    weekly = (
        lines.filter((F.col("line_item_type") == rules.PRODUCT) & (F.col("is_cancelled") == 0) & (F.col("store") == "regular"))
        .withColumn("week_start", F.col("iso_week_start"))
        .groupBy(*group)
        .agg(
            F.sum("line_total").alias("net_dollars"), F.count_distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("units_sold"),
        )
    )
    ties = ["sku", "product_line", "wbr_product_subline"]
    ranked = _by_week(weekly, "-net_dollars", *ties).ranked("weekly_rank")
    w = W.partitionBy("sku").orderBy("week_start", "product_line", "wbr_product_subline")
    before = F.lag("net_dollars").over(w)
    rolled = ranked.withColumns({
        "prev_week_net_dollars": before, "prev_week_orders": F.lag("order_count").over(w),
        "wow_delta_dollars": F.col("net_dollars") - before, "wow_change_pct": x.relative_change("net_dollars", before),
        "prev_week_rank": F.lag("weekly_rank").over(w),
        "t6w_net_dollars": trailing("net_dollars", w, TRAILING_WEEKS), "t6w_orders": trailing("order_count", w, TRAILING_WEEKS),
        "p6w_net_dollars": prior("net_dollars", w, TRAILING_WEEKS), "p6w_orders": prior("order_count", w, TRAILING_WEEKS),
        "t6w_week_count": F.count("*").over(w.rowsBetween(1 - TRAILING_WEEKS, 0)),
    })
    trailed = _by_week(rolled, "-t6w_net_dollars", *ties)
    totals = trailed.rows.groupBy("iso_year", "iso_week").agg(
        F.sum("t6w_net_dollars").alias("_all_now"), F.sum("p6w_net_dollars").alias("_all_before")
    )
    both = trailed.running({"t6w_rank": F.lit(1)}, beside=totals).withColumns({
        "t6w_rank": F.col("t6w_rank").cast("int"),
        "t6w_delta_dollars": F.col("t6w_net_dollars") - F.col("p6w_net_dollars"),
        "t6w_change_pct": x.relative_change("t6w_net_dollars", "p6w_net_dollars"),
        "dtc_benchmark_pct": x.relative_change(F.col("_all_now"), F.col("_all_before")),
    }).drop("_all_now", "_all_before")
    return _by_week(both, "-p6w_net_dollars", *ties).ranked("p6w_rank").withColumn(
        "delta_vs_dtc_pct", F.col("t6w_change_pct") - F.col("dtc_benchmark_pct")
    )


def sample_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Weekly and monthly sample orders and sampled units, with change on the week and the year before.

    Orders are read once, to one row per day and order, and lines once, to one row per day. Each of these rows then counts
    for its week and for its month.
    """
    valid = _not_cancelled(orders).filter(F.col("is_sample_order") == 1).select("order_date", "order_id").distinct()
    sampled = lines.filter((F.col("line_item_type") == rules.SAMPLE) & (F.col("is_cancelled") == 0)).groupBy(
        "order_date"
    ).agg(F.sum("quantity").alias("quantity"))
    month = F.struct(F.lit("monthly").alias("grain"), x.month_start("order_date").alias("start"))
    week = F.struct(F.lit("weekly").alias("grain"), x.iso_week_start("order_date").alias("start"))

    def both_periods(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(F.explode(F.array(week, month)).alias("period"), *columns).select("period.*", *columns)

    ordered = both_periods(valid, "order_id").distinct().select("grain", "start", F.lit(1).alias("orders"))
    found = stack(ordered, both_periods(sampled, "quantity")).groupBy("grain", "start").agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("sample_order_count"), F.coalesce(F.sum("quantity"), F.lit(0)).alias("sample_sku_count"),
        F.count("orders").alias("_ordered"),
    )
    weekly = with_iso_week(found.filter("grain = 'weekly'"), day="start").drop("grain", "start", "_ordered")
    # A month has a row if samples were ordered in it.
    monthly = found.filter("grain = 'monthly' AND _ordered > 0").select(
        "grain", F.col("start").alias("month_start"), F.year("start").alias("iso_year"), "sample_order_count", "sample_sku_count"
    )
    w = W.orderBy("week_start")  # one row per week
    both = (("sample_order_count", "sample_orders"), ("sample_sku_count", "sample_skus"))
    weekly = weekly.withColumns({
        "grain": F.lit("weekly"),
        **{f"prev_week_{name}": F.lag(c).over(w) for c, name in both},
        **{f"prior_year_{name}": same_week_last_year(c) for c, name in both},
    }).withColumns({
        **{f"{name}_wow_pct": x.relative_change(c, f"prev_week_{name}") for c, name in both},
        **{f"{name}_yoy_pct": x.relative_change(c, f"prior_year_{name}") for c, name in both},
    }).withColumnRenamed("week_start", "period_start")
    return stack(weekly, monthly).withColumn("skus_per_order", x.safe_divide("sample_sku_count", "sample_order_count"))


def sample_sku_ranking(lines: DataFrame) -> DataFrame:
    """Sample skus by week: units, ranks, change, trailing and prior six weeks."""
    weekly = (
        lines.filter((F.col("line_item_type") == rules.SAMPLE) & (F.col("is_cancelled") == 0))
        .withColumn("week_start", F.col("iso_week_start"))
        .groupBy(*WEEK, "sku", "product_line")
        .agg(F.sum("quantity").alias("qty_ordered"), F.count_distinct("order_id").alias("order_count"))
    )
    ties = ["sku", "product_line"]
    w = W.partitionBy("sku").orderBy("week_start", "product_line")
    rolled = _by_week(weekly, "-qty_ordered", *ties).ranked("weekly_rank").withColumns({
        "prev_week_qty": F.lag("qty_ordered").over(w), "prev_week_rank": F.lag("weekly_rank").over(w),
        "wow_delta": F.col("qty_ordered") - F.lag("qty_ordered").over(w),
        "t6w_qty": trailing("qty_ordered", w, TRAILING_WEEKS), "p6w_qty": prior("qty_ordered", w, TRAILING_WEEKS),
    })
    trailed = _by_week(rolled, "-t6w_qty", *ties).ranked("t6w_rank")
    return _by_week(trailed, "-p6w_qty", *ties).ranked("p6w_rank").withColumn("t6w_delta", F.col("t6w_qty") - F.col("p6w_qty"))


def size_variant(sizes: Sequence = rules.SIZE_VARIANTS) -> Column:
    return x.ladder([(x.like_any("sku", patterns), label) for label, patterns in sizes], "Unknown")


def launch_sampling(lines: DataFrame, line: str = rules.LAUNCH_LINE) -> DataFrame:
    """Daily samples of one product line by sku and size, with day totals and running totals.

    Windows run on one row per day and sku of a single line. A size may hold all of them: its running total, which all rows
    of a day share, is carried across ranges of days.
    """
    daily = (
        lines.filter(
            (F.col("line_item_type") == rules.SAMPLE) & (F.col("product_line") == line) & (F.col("is_cancelled") == 0)
        )
        .groupBy("order_date", "sku", "product_line", "color_code", "color_name", size_variant().alias("size_variant"))
        .agg(
            F.count("*").alias("sample_line_count"), F.sum("quantity").alias("qty_ordered"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )
    n = F.sum("sample_line_count")
    running = Ranged(daily, ["size_variant"], ["order_date"]).running({"size_cumulative": F.col("sample_line_count")}, peers=True)
    return running.withColumns({
        "size_daily_total": n.over(W.partitionBy("order_date", "size_variant")),
        "daily_grand_total": n.over(W.partitionBy("order_date")),
        "sku_cumulative": n.over(W.partitionBy("sku").orderBy("order_date")),
    })
