"""Documented rules beside the models: product category, sample cohorts, color conversion, price fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoploom.functions import exprs as x
from shoploom.functions import rules

# Category code by sku, and the product category of each code.
SAMPLE_CODE = "[^-]-(B|C|S)-[^-]"
HARDWOOD_SAMPLE = "%7-CUT%"
CODE_CATEGORIES = {
    "lvp-S": "Signature", "lvp-7210": "Signature", "lvp-B": "Base", "lvp-4805": "Base", "lvp-C": "Craftsman",
    "lvp-7": "Silvan Hardwood", "lvp-7T": "Silvan Hardwood",
}


def category_code(sku="sku", kind="line_item_type") -> Column:
    """`lvp-` and the last sku segment of a product, or the category letter of a sample."""
    s, k = x.col(sku), x.col(kind)
    return (
        F.when(k == rules.PRODUCT, F.concat(F.lit("lvp-"), F.substring_index(s, "-", -1)))
        .when((k == rules.SAMPLE) & s.like(HARDWOOD_SAMPLE), F.lit("lvp-7T"))
        .when(k == rules.SAMPLE, F.concat(F.lit("lvp-"), x.first_group(s, SAMPLE_CODE)))
    )


def product_category(code) -> Column:
    return x.ladder([(x.col(code) == c, label) for c, label in CODE_CATEGORIES.items()], "Other")


def sampled_category(sku="sku") -> Column:
    """Category by sku pattern, as the customer funnel uses it."""
    return x.ladder([(x.like_any(sku, patterns), label) for _, label, patterns in rules.CATEGORIES], "Other")


def sample_type_counts(lines: DataFrame) -> DataFrame:
    """Distinct categories sampled per order."""
    sampled = F.when(F.col("sample_quantity") > 0, sampled_category())
    return lines.groupBy("order_id", "store").agg(F.count_distinct(sampled).alias("sample_type_count"))


def sample_cohort_retention(orders: DataFrame) -> DataFrame:
    """Cohorts by month of the first sample: customers and sales per month, relative to the first month."""
    later = orders.filter(F.col("order_date") >= F.col("first_sample_order_date"))
    monthly = (
        later.groupBy(
            x.month_start("first_sample_order_date").alias("cohort_month"),
            (x.month_gap("order_date", "first_sample_order_date") + 1).alias("retention_months"),
        )
        .agg(F.count_distinct("email").alias("customer_count"), F.sum("net_sales").alias("sales"))
    )
    w = W.partitionBy("cohort_month").orderBy("retention_months")
    return monthly.withColumns({
        "first_month_count": F.first_value("customer_count").over(w), "first_month_sales": F.first_value("sales").over(w),
    }).withColumns({
        "count_retention": x.safe_divide("customer_count", "first_month_count"),
        "sales_retention": x.safe_divide("sales", "first_month_sales"),
    })


def color_conversion(lines: DataFrame) -> DataFrame:
    """Flags product lines bought after the customer's first sample of the same color."""
    first = (
        lines.filter(F.col("sample_quantity") > 0)
        .groupBy("email", "color").agg(F.min("processed_at").alias("first_sample_of_color"))
    )
    return lines.join(first, ["email", "color"], "left").withColumn(
        "color_conversion", x.flag((F.col("product_quantity") > 0) & (F.col("processed_at") > F.col("first_sample_of_color")))
    )


def price_fields(orders: DataFrame) -> DataFrame:
    return orders.withColumns({
        "subtotal_plus_tax": F.col("subtotal_price") + F.col("total_tax"),
        "total_excl_tax": F.col("total_price") - F.col("total_tax"),
    })


def sampled_after(funnel: DataFrame, day: Column | None = None) -> DataFrame:
    """Funnel rows whose first sample came after the day the funnel analysis starts from."""
    start = F.lit("2020-12-31").cast("date") if day is None else day
    return funnel.filter(F.col("first_sample_order_date") > start)
