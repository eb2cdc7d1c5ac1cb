"""Documented headline figures and small reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key
from tillroll.functions.numbers import count, money, percent
from tillroll.model import PRIMARY_KEYS
from tillroll.operators import quality
from tillroll.operators.flat import DEDUPED
from tillroll.operators.settle import settled
from tillroll.plans.business import discount_tier_of
from tillroll.sources.tables import Tables


def repeat_buyer_rate(t: Tables, min_orders: int = 2) -> DataFrame:
    """Share of the customers with an order who have ``min_orders`` or more."""
    return (
        t.orders.groupBy("Customer_ID")
        .agg(F.count(F.lit(1)).alias("_orders"))
        .agg(
            count().alias("Buyers"),
            F.count_if(F.col("_orders") >= min_orders).alias("Repeat_Buyers"),
        )
        .withColumn("Repeat_Buyer_Pct", percent("Repeat_Buyers", "Buyers"))
    )


def margin_by_discount_tier(t: Tables) -> DataFrame:
    return (
        t.order_items.groupBy(discount_tier_of().alias("Discount_Tier"))
        .agg(
            money(F.sum("Sales")).alias("Total_Sales"), money(F.sum("Profit")).alias("Total_Profit")
        )
        .withColumn("Profit_Margin_Pct", percent("Total_Profit", "Total_Sales"))
    )


def slow_shipment_share(t: Tables, days: int = 7) -> DataFrame:
    return t.shipping.agg(
        count().alias("Shipments"), F.count_if(F.col("Delivery_Days") > days).alias("Slow_Shipments")
    ).withColumn("Slow_Shipment_Pct", percent("Slow_Shipments", "Shipments"))


def pivot_category_month(t: Tables, categories: Sequence[str] | None = None) -> DataFrame:
    """Sales per month, one column per category; the categories are looked up if not given."""
    if categories is None:
        rows = t.categories.select("Category").distinct().orderBy("Category").collect()
        categories = [r["Category"] for r in rows]
    # per order and category first: an order is one row per category when it meets its date
    sums = t.order_items.groupBy("Order_ID", "Category").agg(F.sum("Sales").alias("Sales"))
    return (
        t.orders.select("Order_ID", "Order_Date")
        .join(sums, "Order_ID")
        .groupBy(month_key("Order_Date").alias("Year_Month"))
        .pivot("Category", list(categories))
        .agg(money(F.sum("Sales")))
        .orderBy("Year_Month")
    )


def cleaning_log(t: Tables, flat: DataFrame) -> DataFrame:
    """One row per cleaning check: what was checked and how many rows it concerns.

    Of ``flat`` only the presence of values counts, but for the columns checked for outliers.
    """
    duplicates = [
        quality.duplicate_report(t[name], PRIMARY_KEYS[name], name).select(
            F.lit("duplicates").alias("step"),
            F.concat_ws(".", "table_name", "key_columns").alias("subject"),
            F.col("duplicate_rows").alias("affected_rows"),
        )
        for name in DEDUPED
    ]
    flat = settled(
        flat.select(
            *[F.col(c) if c in quality.OUTLIER_COLUMNS else F.when(F.col(c).isNotNull(), F.lit(True)).alias(c) for c in flat.columns]
        )
    )
    nulls = quality.null_counts(flat).filter("null_count > 0")
    bounds = quality.outlier_bounds(flat)
    outliers = quality.count_per_column(
        flat,
        {c: F.count_if(quality.is_outlier(c, bounds)) for c in quality.OUTLIER_COLUMNS},
        "subject",
        "affected_rows",
    )
    steps = [
        *duplicates,
        nulls.select(
            F.lit("nulls").alias("step"),
            F.col("column_name").alias("subject"),
            F.col("null_count").alias("affected_rows"),
        ),
        outliers.select(F.lit("outliers").alias("step"), "subject", "affected_rows"),
    ]
    return reduce(DataFrame.unionByName, steps)


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """The records of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def lookup_many(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The records of all keys in the ``key`` column of ``keys``."""
    return df.join(keys.select(key).distinct(), key, "left_semi")
