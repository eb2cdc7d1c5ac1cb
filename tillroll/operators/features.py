"""The 22 derived columns on the cleaned flat table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.binning import right_closed_bins
from tillroll.functions.dates import is_weekend, month_key, weekday_name
from tillroll.functions.numbers import real
from tillroll.model import DISCOUNT_TIERS
from tillroll.operators import ranking
from tillroll.operators.settle import settled

# The columns that get a code, and the class of a missing value.
ENCODED = (
    "Category",
    "Sub_Category",
    "Payment_Method",
    "Customer_Segment",
    "Income_Group",
    "Gender",
    "State",
    "Order_Status",
    "Shipping_Mode",
)
MISSING = "Not_Shipped"
BUCKET_EDGES = (-0.01, 0, 0.10, 0.20, 1.0)


def date_features(df: DataFrame) -> DataFrame:
    day = F.col("Order_Date")
    return df.withColumns(
        {
            "Order_Year": F.year(day),
            "Order_Month": F.month(day),
            "Order_Quarter": F.quarter(day),
            "Order_Weekday": weekday_name(day),
            "Is_Weekend_Order": is_weekend(day),
            "Order_YearMonth": month_key(day),
            "Days_To_Ship": F.datediff("Ship_Date", day),
        }
    )


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else 0."""
    return F.when(bottom > 0, real(top) / real(bottom)).otherwise(F.lit(0.0))


def discount_bucket(column: str = "Discount") -> Column:
    """Right-closed tiers; outside (-0.01, 1] there is none."""
    return right_closed_bins(column, BUCKET_EDGES, DISCOUNT_TIERS)


def financial_features(df: DataFrame, high_value_from: float | None = None) -> DataFrame:
    """``high_value_from`` is the upper quartile of Sales; computed from ``df`` if not given."""
    if high_value_from is None:
        high_value_from = ranking.quantiles(df, ["Sales"], [0.75])["Sales"][0]
    sales = F.col("Sales")
    high = F.coalesce(real(sales) >= F.lit(high_value_from), F.lit(False))
    return df.withColumns(
        {
            "Profit_Margin_Pct": guarded_ratio(F.col("Profit") * 100, sales),
            "Avg_Item_Value": F.try_divide(real(sales), real("Quantity")),
            "Discount_Bucket": discount_bucket(),
            "Is_High_Value_Order": high,
        }
    )


def tenure_features(df: DataFrame) -> DataFrame:
    """Tenure counts to the latest order date in the data, never to the clock."""
    last_day = df.agg(F.max("Order_Date")).scalar()
    return df.withColumns(
        {
            "Customer_Tenure_Days": F.datediff(last_day, "Customer_Since"),
            "Avg_Spend_Per_Order": guarded_ratio(F.col("Total_Spend"), F.col("Total_Orders")),
        }
    )


def label_codes(
    df: DataFrame, columns: Sequence[str], suffix: str = "_Encoded", missing: str = MISSING
) -> DataFrame:
    """Adds 0, 1, 2, ... by sorted text, one code column per column.

    One pass finds the distinct values of all columns; they are numbered in Spark, stored and joined back,
    so a vocabulary may grow with the data. As a stored table their size is known when the joins are planned,
    so Spark broadcasts small ones and leaves the rows where they are.
    """
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns}
    pairs = [F.struct(F.lit(i).alias("_i"), t.alias("_value")) for i, t in enumerate(texts.values())]
    values = settled(df.select(F.inline(F.array(*pairs))).distinct())
    numbered = settled(
        ranking.row_number(values, [F.col("_value")], "_position", within=["_i"]).select(
            "_i", "_value", (F.col("_position") - 1).cast("int").alias("_code")
        )
    )
    coded = df
    for i, (column, text) in enumerate(texts.items()):
        codes = numbered.filter(F.col("_i") == i).select(
            F.col("_value").alias("_text"), F.col("_code").alias(f"{column}{suffix}")
        )
        coded = coded.join(codes, text == F.col("_text")).drop("_text")
    return coded


def engineered(cleaned: DataFrame, high_value_from: float | None = None) -> DataFrame:
    """The cleaned table with all 22 derived columns."""
    df = financial_features(date_features(cleaned), high_value_from)
    return label_codes(tenure_features(df), ENCODED)
