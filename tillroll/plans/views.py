"""The five reporting views.

Lines are summed per order, and orders per customer, before they meet the next table. So every
shuffle carries combined rows, and a hot order, customer or product is one row by then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key
from tillroll.functions.numbers import count, money, percent, rounded_ratio
from tillroll.sources.tables import Tables


def order_sums(t: Tables) -> DataFrame:
    """Sales and profit per order that has lines."""
    return t.order_items.groupBy("Order_ID").agg(
        F.sum("Sales").alias("Sales"), F.sum("Profit").alias("Profit")
    )


def sold_orders(t: Tables) -> DataFrame:
    """Orders that have lines, with customer, date, sales and profit."""
    head = t.orders.select("Order_ID", "Customer_ID", "Order_Date")
    return head.join(order_sums(t), "Order_ID")


def customer_sums(t: Tables) -> DataFrame:
    """Orders with lines, their sales and profit, and the last order day per customer."""
    return (
        sold_orders(t)
        .groupBy("Customer_ID")
        .agg(
            count().alias("Orders"),
            F.sum("Sales").alias("Sales"),
            F.sum("Profit").alias("Profit"),
            F.max("Order_Date").alias("Last_Order_Date"),
        )
    )


def monthly_sums(t: Tables) -> DataFrame:
    """Orders with lines, sales and profit per month that has any."""
    return (
        sold_orders(t)
        .groupBy(month_key("Order_Date").alias("Year_Month"))
        .agg(
            count().alias("Order_Count"),
            money(F.sum("Sales")).alias("Total_Sales"),
            money(F.sum("Profit")).alias("Total_Profit"),
        )
    )


def order_context(t: Tables) -> DataFrame:
    """Orders with their customer; small next to the lines, so joined before them."""
    customer = t.customers.select(
        "Customer_ID", "State", "City", "Customer_Segment", "Customer_Age", "Gender"
    )
    head = t.orders.select("Order_ID", "Customer_ID", "Order_Date", "Order_Status")
    return head.join(customer, "Customer_ID")


def order_summary(t: Tables) -> DataFrame:
    return t.order_items.join(order_context(t), "Order_ID").select(
        "Order_Item_ID",
        "Order_ID",
        "Customer_ID",
        "Order_Date",
        "Order_Status",
        "Product_ID",
        "Category",
        "Sub_Category",
        "Brand",
        "Quantity",
        "Unit_Price",
        "Discount",
        "Sales",
        "Profit",
        "Return_Flag",
        "State",
        "City",
        "Customer_Segment",
        "Customer_Age",
        "Gender",
    )


def customer_ltv(t: Tables) -> DataFrame:
    """One row per customer; without orders the count is 0 and the sums are NULL."""
    head = t.orders.select("Order_ID", "Customer_ID")
    per_customer = (
        head.join(order_sums(t), "Order_ID", "left")
        .groupBy("Customer_ID")
        .agg(
            count().alias("_orders"),
            F.sum("Sales").alias("_sales"),
            F.sum("Profit").alias("_profit"),
        )
    )
    return t.customers.join(per_customer, "Customer_ID", "left").select(
        "Customer_ID",
        "First_Name",
        "Last_Name",
        "State",
        "Customer_Segment",
        "Customer_Since",
        "Churned",
        F.coalesce("_orders", F.lit(0)).cast("bigint").alias("Total_Orders"),
        money("_sales").alias("Total_Sales"),
        money("_profit").alias("Total_Profit"),
        rounded_ratio("_sales", "_orders").alias("Avg_Order_Value"),
    )


def monthly_sales(t: Tables) -> DataFrame:
    return monthly_sums(t)


def product_performance(t: Tables, fan_out: bool = True) -> DataFrame:
    """One row per product.

    Joining lines and reviews on the product pairs each line with each review, so the sums are
    multiplied by the review count; shares and means are not. ``fan_out`` keeps those sums, and
    still sums each side first instead of building the pairs. Without it the sums are plain.
    """
    lines = t.order_items.groupBy("Product_ID").agg(
        F.sum("Quantity").alias("_units"),
        F.sum("Sales").alias("_sales"),
        F.sum("Profit").alias("_profit"),
        F.count_if(F.col("Return_Flag") == "Yes").alias("_returned"),
        F.count(F.lit(1)).alias("_lines"),
    )
    reviews = t.reviews.groupBy("Product_ID").agg(
        F.count(F.lit(1)).alias("_reviews"),
        F.count("Review_Score").alias("_scores"),
        F.sum("Review_Score").alias("_score"),
    )
    times = F.greatest(F.coalesce("_reviews", F.lit(1)), F.lit(1)) if fan_out else F.lit(1)
    times = times.cast("decimal(12,0)")

    def total(column):
        return money(F.coalesce(F.col(column).cast("decimal(24,2)") * times, F.lit(0)))

    return (
        t.products.join(lines, "Product_ID", "left")
        .join(reviews, "Product_ID", "left")
        .select(
            "Product_ID",
            "Product_Name",
            "Category",
            "Sub_Category",
            "Brand",
            "Stock_Quantity",
            total("_units").cast("bigint").alias("Units_Sold"),
            total("_sales").alias("Total_Sales"),
            total("_profit").alias("Total_Profit"),
            percent("_returned", "_lines").alias("Return_Rate_Pct"),
            rounded_ratio("_score", "_scores").alias("Avg_Review_Score"),
        )
    )


def state_performance(t: Tables) -> DataFrame:
    home = t.customers.select("Customer_ID", "State")
    return (
        customer_sums(t)
        .join(home, "Customer_ID")
        .groupBy("State")
        .agg(
            count().alias("Customers"),
            F.sum("Orders").alias("Orders"),
            money(F.sum("Sales")).alias("Total_Sales"),
            money(F.sum("Profit")).alias("Total_Profit"),
        )
    )


VIEWS = {
    "vw_order_summary": order_summary,
    "vw_customer_ltv": customer_ltv,
    "vw_monthly_sales": monthly_sales,
    "vw_product_performance": product_performance,
    "vw_state_performance": state_performance,
}


def all_views(t: Tables) -> dict[str, DataFrame]:
    return {name: view(t) for name, view in VIEWS.items()}


def row_counts(frames: dict[str, DataFrame], name_column: str) -> DataFrame:
    """Name and row count of each frame, one row per frame."""
    counts = [
        df.agg(count().alias("row_count")).select(F.lit(name).alias(name_column), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)
