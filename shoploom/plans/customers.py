"""Orders rolled up from lines, then customers: lifetime totals, households, sample-to-purchase funnel."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.functions import rules
from shoploom.functions.farm import farm_fingerprint
from shoploom.operators.frequent import usual_values
from shoploom.operators.relational import left_join_sparse, most_common, zero_fill
from shoploom.operators.windows import running_totals

ORDER_KEY = ["order_id", "store"]

_LINE_SUMS = {
    "sample_quantity": "sample_quantity", "product_quantity": "product_quantity",
    "accessories_quantity": "accessories_quantity", "total_quantity": "quantity", "sample_revenue": "sample_revenue",
    "product_revenue": "product_revenue", "accessories_revenue": "accessories_revenue",
    "total_line_items_revenue": "line_total",
}


def roll_up_lines(lines: DataFrame) -> DataFrame:
    """One row per order: sums by type, counts, cut and plank samples, sampled categories.

    Lines are read and shuffled once. Skus and colors are told apart in sets, which hold no more than an order's lines.
    """
    def of_type(kind):
        return F.sum(F.when(F.col("sample_type") == kind, F.col("sample_quantity")).otherwise(0))

    is_sample = F.col("line_item_type") == rules.SAMPLE
    counts = {
        "distinct_sku_count": F.col("sku"),
        "sample_color_count": F.when(F.col("sample_quantity") > 0, F.col("color")),
        "product_color_count": F.when(F.col("product_quantity") > 0, F.col("color")),
    }
    return lines.groupBy(*ORDER_KEY).agg(
        *[F.sum(c).alias(out) for out, c in _LINE_SUMS.items()], F.count("*").alias("line_item_count"),
        of_type(rules.SAMPLE_CUT).alias("cut_sample_quantity"), of_type(rules.SAMPLE_PLANK).alias("plank_sample_quantity"),
        *[
            F.max(x.flag(is_sample & x.like_any("sku", patterns))).alias(f"sampled_{name}")
            for name, _, patterns in rules.CATEGORIES
        ],
        *[F.size(F.collect_set(value)).cast("bigint").alias(out) for out, value in counts.items()],
    )


def with_household(orders: DataFrame, abbreviations: bool = False) -> DataFrame:
    """Adds normalised address and ZIP and the household key; all NULL without address, ZIP or usable email.

    Groups and joins go by the key. The id, its 64-bit fingerprint, is made where it is shown: among billions of addresses
    two may share one.
    """
    email = F.col("email")
    known = (
        F.col("shipping_address_line1").isNotNull() & F.col("shipping_address_zip").isNotNull()
        & email.isNotNull() & ~email.like(rules.MARKETPLACE_EMAIL)
    )
    address = x.normalised_address("shipping_address_line1", abbreviations)
    zip_code = x.normalised_zip("shipping_address_zip", "shipping_address_country")
    return (
        orders.withColumns({"normalized_address": F.when(known, address), "normalized_zip": F.when(known, zip_code)})
        .withColumn("household_key", F.when(known, x.household_key("normalized_address", "normalized_zip")))
    )


def households(orders: DataFrame, abbreviations: bool = False) -> DataFrame:
    """Orders that have a household, with the address they were matched on."""
    found = with_household(orders, abbreviations).filter(F.col("household_key").isNotNull())
    return found.withColumn("household_id", farm_fingerprint("household_key")).select(
        "order_id", "email", "processed_at", "order_date", "store", "shipping_address_line1", "shipping_address_line2",
        "shipping_address_city", "shipping_state", "shipping_address_zip", "shipping_address_country",
        "normalized_address", "normalized_zip", "household_key", "household_id",
    )


# Column names.
ORDER_HEADER = [
    "order_id", "email", "customer_id", "processed_at", "order_date", "order_year", "order_month", "order_quarter",
    "store", "product_price_threshold", "default_salesperson", "salesperson", "subtotal_price", "total_price",
    "total_discounts", "total_tax", "total_tip_received", "refund_subtotal", "refund_total_tax",
    "order_adjustment_amount", "order_name", "order_number", "note", "source_name", "financial_status",
    "fulfillment_status", "cancel_reason", "billing_state", "billing_state_code", "billing_address_city",
    "billing_address_zip", "billing_address_country", "billing_address_country_code", "shipping_state",
    "shipping_state_code", "shipping_address_city", "shipping_address_zip", "shipping_address_country",
    "shipping_address_country_code",
]


# The columns of classified orders that lifetime totals and the funnel read.
ORDER_CORE = [
    "order_id", "store", "email", "processed_at", "order_date", "is_product_order", "is_sample_order", "has_cut_samples",
    "has_plank_samples", "product_revenue", "sample_revenue", "net_sales", "household_key",
    *[f"sampled_{name}" for name, _, _ in rules.CATEGORIES],
]


def classify_orders(
    orders: DataFrame, lines: DataFrame, min_subtotal: float = rules.MIN_PRODUCT_SUBTOTAL
) -> DataFrame:
    """Orders with their line totals, order type, net sales and averages; lineless orders hold zeros.

    Two column groups ride along for the customer funnel, so that it needs no second pass over
    lines or addresses: `sampled_<category>` flags and the household of the order.
    """
    rolled = roll_up_lines(lines)
    measures = [c for c in rolled.columns if c not in ORDER_KEY]
    with_keys = with_household(orders).select(*ORDER_HEADER, "household_key")
    joined = zero_fill(with_keys.join(rolled, ORDER_KEY, "left"), measures)
    has_sample, has_product = F.col("sample_quantity") > 0, F.col("product_quantity") > 0
    is_product = has_product & (F.col("subtotal_price") > min_subtotal)
    is_sample = has_sample & (F.col("product_quantity") == 0)
    is_accessory = (F.col("accessories_quantity") > 0) & (F.col("sample_quantity") == 0) & (F.col("product_quantity") == 0)
    return joined.withColumns({
        "order_type": x.ladder(
            [(is_product, "Product Order"), (is_sample, "Sample Order"), (is_accessory, "Accessory Only")], "Other"
        ),
        "is_product_order": x.flag(is_product),
        "is_sample_order": x.flag(is_sample),
        "is_accessory_only": x.flag(is_accessory),
        "has_cut_samples": x.flag(F.col("cut_sample_quantity") > 0),
        "has_plank_samples": x.flag(F.col("plank_sample_quantity") > 0),
        "net_sales": F.col("subtotal_price") - F.col("refund_subtotal"),
        "avg_line_item_value": x.plain_ratio("subtotal_price", "line_item_count", 0),
        "avg_unit_price": x.plain_ratio("subtotal_price", "total_quantity", 0),
        "discount_rate": x.plain_ratio("total_discounts", "subtotal_price", 0),
        "line_item_discount": x.plain_ratio("total_discounts", "distinct_sku_count", 0),
    })


def lifetime_metrics(orders: DataFrame, beside: DataFrame | None = None) -> DataFrame:
    """Classified orders with an email, plus running counts and revenue of their customer.

    Every sequence number follows from a running sum: the n-th product order has n product
    orders up to it, and an order that is none comes after `count - sum` others like it.
    `beside` adds columns known per email.
    """
    known = orders.filter(F.col("email").isNotNull())
    one = F.lit(1).cast("bigint")
    totals = {
        "lifetime_product_orders": F.col("is_product_order").cast("bigint"),
        "lifetime_sample_orders": F.col("is_sample_order").cast("bigint"),
        "lifetime_total_orders": one,
        "lifetime_product_revenue": F.col("product_revenue"),
        "lifetime_sample_revenue": F.col("sample_revenue"),
        "lifetime_total_revenue": F.col("net_sales"),
    }
    run = running_totals(
        known, "email", "order_date", ["processed_at", "order_id", "store"], totals,
        {"_first_day": F.col("order_date")}, beside,
    )

    def sequence(kind):
        so_far = F.col(f"lifetime_{kind}_orders")
        return F.when(F.col(f"is_{kind}_order") == 1, so_far).otherwise(F.col("lifetime_total_orders") - so_far)

    numbered = run.withColumns({
        "order_sequence_number": F.col("lifetime_total_orders"),
        "product_order_sequence_number": sequence("product"),
        "sample_order_sequence_number": sequence("sample"),
    })
    def first(kind):
        return x.flag((F.col(f"{kind}_order_sequence_number") == 1) & (F.col(f"is_{kind}_order") == 1))

    return numbered.withColumns({
        "is_first_order": x.flag(F.col("order_sequence_number") == 1),
        "is_first_product_order": first("product"),
        "is_first_sample_order": first("sample"),
        "avg_order_value_to_date": x.safe_divide("lifetime_total_revenue", "lifetime_total_orders"),
        "days_since_first_order": F.datediff("order_date", "_first_day"),
    }).drop("_first_day")


def _first_dates(prefix: str) -> list[Column]:
    def first(flag, column):
        return F.min(F.when(F.col(flag) == 1, F.col(column)))

    return [
        F.min("order_date").alias(f"{prefix}first_order_date"),
        first("is_sample_order", "order_date").alias(f"{prefix}first_sample_order_date"),
        first("is_sample_order", "processed_at").alias(f"{prefix}first_sample_order_timestamp"),
        first("is_product_order", "order_date").alias(f"{prefix}first_product_order_date"),
        first("is_product_order", "processed_at").alias(f"{prefix}first_product_order_timestamp"),
        first("has_cut_samples", "order_date").alias(f"{prefix}first_cut_order_date"),
        first("has_plank_samples", "order_date").alias(f"{prefix}first_plank_order_date"),
        F.max("is_product_order").alias(f"{prefix}has_ever_purchased_product"),
    ]


def _gaps(df: DataFrame, prefix: str, windows: Sequence[int]) -> DataFrame:
    """Day gaps between the first dates, and one flag per window; a purchase before the sample counts as within."""
    def gap(later, earlier):
        return F.datediff(f"{prefix}first_{later}_order_date", f"{prefix}first_{earlier}_order_date")

    out = df.withColumns({
        f"{prefix}days_to_order": gap("product", "sample"), f"{prefix}days_cut_to_order": gap("product", "cut"),
        f"{prefix}days_plank_to_order": gap("product", "plank"), f"{prefix}days_cut_to_plank": gap("plank", "cut"),
    })
    return out.withColumns({
        **{f"{prefix}converted_within_{n}d": x.flag(F.col(f"{prefix}days_to_order") <= n) for n in windows},
        f"{prefix}conversion_ind": x.flag(F.col(f"{prefix}has_ever_purchased_product") == 1),
    })


def _sample_order_type() -> Column:
    """Which categories were sampled before the first product order, from the first sample date of each."""
    bought = F.col("first_product_order_date")

    def before(day):
        return F.col(day).isNotNull() & (bought.isNull() | (F.col(day) < bought))

    names = [name for name, _, _ in rules.CATEGORIES]
    arms = [(~before("first_sample_order_date"), rules.NO_SAMPLES)]
    for wanted, label in rules.SAMPLE_ORDER_TYPES:
        match = F.lit(True)
        for name in names:
            match = match & (before(f"_first_{name}") if name in wanted else ~before(f"_first_{name}"))
        arms.append((match, label))
    return x.ladder(arms, rules.MIXED_SAMPLES)


def customer_funnel(orders: DataFrame, windows: Sequence[int] = rules.CONVERSION_WINDOWS) -> DataFrame:
    """Sample-to-purchase funnel per email, with the funnel of the customer's household.

    One aggregation per email yields the first dates, the newest household and the first
    sample date of each category; "some sample of this category before the purchase" is the
    same as "its first sample came before the purchase", so no join back to orders is needed.
    """
    usable = orders.filter(F.col("email").isNotNull() & ~F.col("email").like(rules.MARKETPLACE_EMAIL))
    newest = F.when(F.col("household_key").isNotNull(), F.struct("processed_at", "order_id", "store"))
    # A sample order without lines cannot exist, so the flag alone finds its categories.
    first_sampled = [
        F.min(F.when((F.col("is_sample_order") == 1) & (F.col(f"sampled_{name}") == 1), F.col("order_date"))).alias(f"_first_{name}")
        for name, _, _ in rules.CATEGORIES
    ]
    by_email = usable.groupBy("email").agg(
        *_first_dates(""), *first_sampled, F.max_by("household_key", newest).alias("household_key")
    )
    by_house = usable.filter(F.col("household_key").isNotNull()).groupBy("household_key").agg(
        *_first_dates("household_"), F.count_distinct("email").alias("household_email_count")
    ).withColumn("household_id", farm_fingerprint("household_key"))
    joined = left_join_sparse(_gaps(by_email, "", windows), _gaps(by_house, "household_", windows), "household_key")
    done = joined.withColumns({
        "hybrid_conversion_ind": x.flag((F.col("conversion_ind") == 1) | (F.col("household_conversion_ind") == 1)),
        "sample_order_type": _sample_order_type(),
        "cohort_month": x.month_start("first_sample_order_date"),
    })
    return done.drop("household_key", *[f"_first_{name}" for name, _, _ in rules.CATEGORIES])


def fct_orders(orders: DataFrame, funnel: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Classified orders with lifetime totals, funnel dates and the customer's status at that order.

    `columns` names those to return, if not all; `orders` then needs no others besides `ORDER_CORE`.

    The funnel dates travel with the carried lifetime sums, which spares the wide orders a second
    shuffle by email.
    """
    dates = funnel.select("email", "first_sample_order_date", "first_product_order_date", "days_to_order", "sample_order_type")
    later_sample = (F.col("is_sample_order") == 1) & (F.col("order_date") > F.col("first_sample_order_date"))
    later_product = (F.col("is_product_order") == 1) & (F.col("order_date") > F.col("first_product_order_date"))
    return lifetime_metrics(orders, dates).withColumns({
        "customer_status": x.ladder(
            [
                (F.col("is_first_product_order") == 1, "New Customer"),
                (F.col("is_first_sample_order") == 1, "New Customer Sample"),
                (later_sample, "Returning Sample"), (later_product, "Returning Customer"),
            ],
            "Other",
        ),
        "is_new_customer": x.flag(F.col("is_first_product_order") == 1),
        "is_returning_customer": x.flag(later_product),
    }).select(*(FCT_ORDERS if columns is None else columns))


# Column names.
FCT_ORDERS = [
    "order_id", "email", "customer_id", "processed_at", "order_date", "order_year", "order_month", "order_quarter",
    "store", "salesperson", "order_type", "is_product_order", "is_sample_order", "is_accessory_only",
    "financial_status", "fulfillment_status", "cancel_reason", "subtotal_price", "total_price", "total_discounts",
    "total_tax", "net_sales", "refund_subtotal", "refund_total_tax", "order_adjustment_amount", "discount_rate",
    "line_item_discount", "sample_quantity", "product_quantity", "accessories_quantity", "total_quantity",
    "cut_sample_quantity", "plank_sample_quantity", "sample_revenue", "product_revenue", "accessories_revenue",
    "total_line_items_revenue", "line_item_count", "distinct_sku_count", "sample_color_count", "product_color_count",
    "has_cut_samples", "has_plank_samples", "shipping_state", "shipping_state_code", "shipping_address_city",
    "shipping_address_zip", "shipping_address_country", "billing_state", "billing_state_code",
    "lifetime_product_orders", "lifetime_sample_orders", "lifetime_total_orders", "lifetime_product_revenue",
    "lifetime_sample_revenue", "lifetime_total_revenue", "order_sequence_number", "product_order_sequence_number",
    "sample_order_sequence_number", "is_first_order", "is_first_product_order", "is_first_sample_order",
    "avg_order_value_to_date", "days_since_first_order", "first_sample_order_date", "first_product_order_date",
    "days_to_order", "sample_order_type", "customer_status", "is_new_customer", "is_returning_customer",
]

# Column names.
ORDER_CONTEXT = [
    "email", "processed_at", "order_date", "order_year", "order_month", "order_quarter", "salesperson", "order_type",
    "is_product_order", "is_sample_order", "customer_status", "is_new_customer", "is_returning_customer",
    "first_sample_order_date", "first_product_order_date", "days_to_order", "sample_order_type",
    "lifetime_product_orders", "lifetime_product_revenue", "lifetime_total_orders", "lifetime_total_revenue",
    "shipping_state", "shipping_state_code", "shipping_address_city",
]
# The part of it from which the line's own columns are made.
LINE_CONTEXT = ["order_date", "is_product_order", "first_sample_order_date"]
# The columns made from it.
FOLLOWS = ["is_converted_purchase", "days_from_sample_to_purchase"]
# Column names.
_LINE_DETAIL = [
    "order_line_id", "order_id", "product_id", "variant_id", "store", "sku", "title", "line_item_name", "vendor",
    "variant_title", "line_item_type", "sample_type", "color", "quantity", "price", "line_total", "total_discount",
    "sample_quantity", "product_quantity", "accessories_quantity", "sample_revenue", "product_revenue",
    "accessories_revenue", "is_gift_card", "is_taxable", "is_shipping_required", "fulfillment_status",
]


def fct_order_lines(
    lines: DataFrame, orders: DataFrame, extra: Sequence[str] = (), context: Sequence[str] | None = None,
    typed: Callable[[DataFrame], DataFrame] = lambda joined: joined, beside: Sequence[str] = (),
) -> DataFrame:
    """Lines with the context of their order, and whether they follow a sample.

    `extra` names further order columns to carry, so later reports need no second join. `context` names the columns of the
    context to carry, if not all; `LINE_CONTEXT` must be among them. `typed` makes what named lines lack, behind the join, so that it
    is not shuffled. `beside` names further columns of the lines to carry.
    """
    wanted = [*(ORDER_CONTEXT if context is None else context), *extra]
    sampled = (F.col("is_product_order") == 1) & F.col("first_sample_order_date").isNotNull()
    joined = typed(lines.join(orders.select(*ORDER_KEY, *wanted), ORDER_KEY))
    detail = [c for c in _LINE_DETAIL if c not in ORDER_KEY]
    return joined.select(*ORDER_KEY, *detail, *wanted, *beside).withColumns({
        "is_converted_purchase": x.flag(sampled & (F.col("order_date") > F.col("first_sample_order_date"))),
        "days_from_sample_to_purchase": F.when(sampled, F.datediff("order_date", "first_sample_order_date")),
    })


def dim_customers(
    customers: DataFrame, funnel: DataFrame, orders: DataFrame, as_of: Column | None = None, segments=rules.SEGMENTS,
    approximate: bool = False,
) -> DataFrame:
    """Customers with funnel, lifetime totals, usual location and store, recency, tenure and segment.

    With `approximate`, usual values come from a frequent-items state per customer instead of counts per value.

    `orders` is the order fact, unique by (order_id, store): orders per store are plain counts.
    """
    day = F.current_date() if as_of is None else as_of
    measures = [f"lifetime_{kind}_{what}" for kind in ("product", "sample", "total") for what in ("orders", "revenue")]
    lifetime = orders.groupBy("email").agg(
        *[F.max(c).alias(c) for c in measures],
        F.max("order_date").alias("most_recent_order_date"), F.min("order_date").alias("first_order_date"),
        F.count_if(F.col("store") == "regular").alias("regular_order_count"),
        F.count_if(F.col("store") == "commercial").alias("commercial_order_count"),
    )
    located = "shipping_state IS NOT NULL"
    place = {
        "primary_shipping_state": "shipping_state", "primary_shipping_state_code": "shipping_state_code",
        "primary_shipping_city": "shipping_address_city",
    }
    usual_of = {**place, "primary_store": "store"}
    if approximate:
        usual = usual_values(orders, "email", usual_of, {c: located for c in place})
    else:
        usual = most_common(orders, "email", usual_of, {c: F.expr(located) for c in place})
    attributes = customers.select(
        "email", "customer_id", "first_name", "last_name", "phone", "customer_group", "customer_type", "account_state",
        "is_verified_email", F.col("store").alias("source_store"), F.col("created_at").alias("account_created_at"),
        F.col("first_order_at").alias("shopify_first_order_at"),
        F.col("most_recent_order_at").alias("shopify_most_recent_order_at"), "marketing_consent_state",
        "marketing_opt_in_level", F.col("lifetime_count_orders").alias("shopify_lifetime_orders"),
        F.col("lifetime_total_spent").alias("shopify_lifetime_spent"),
        F.col("lifetime_total_refunded").alias("shopify_lifetime_refunded"),
        F.col("avg_order_value").alias("shopify_avg_order_value"),
    )
    dates = funnel.select(
        "email", "first_sample_order_date", "first_product_order_date", "first_cut_order_date", "first_plank_order_date",
        "days_to_order", "days_cut_to_order", "days_plank_to_order", "sample_order_type", "cohort_month",
        "conversion_ind", *[f"converted_within_{n}d" for n in rules.CONVERSION_WINDOWS],
    )
    joined = attributes.join(dates, "email", "left").join(lifetime, "email", "left").join(usual, "email", "left")
    revenue, samples, products = (
        F.col("lifetime_product_revenue"), F.col("lifetime_sample_orders"), F.col("lifetime_product_orders")
    )
    return joined.withColumns({
        "average_order_value": x.plain_ratio("lifetime_total_revenue", "lifetime_total_orders", 0),
        "average_product_order_value": x.plain_ratio("lifetime_product_revenue", "lifetime_product_orders", 0),
        "days_since_last_order": F.datediff(day, "most_recent_order_date"),
        "customer_tenure_days": F.datediff(day, "first_order_date"),
        "has_purchased_product": x.flag(products > 0),
        "has_ordered_samples": x.flag(samples > 0),
        "is_repeat_product_customer": x.flag(products > 1),
        "customer_segment": x.ladder(
            [*[(revenue >= edge, label) for edge, label in segments], ((samples > 0) & (products == 0), "Sample Only")],
            "No Purchase",
        ),
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in measures},
    })
