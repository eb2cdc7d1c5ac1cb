"""The 42 business questions. Each takes the table set; constants are parameters.

Two rules hold throughout. Rows are summed by their own key before a join, so a hot key is one
row when it is shuffled again. Windows without a group run on grouped results of calendar or
category size only; those over entities go through ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillroll.functions.binning import first_match
from tillroll.functions.numbers import count, money, percent, ratio, real, rounded_ratio
from tillroll.model import DISCOUNT_EDGES, DISCOUNT_TIERS
from tillroll.operators import ranking
from tillroll.operators.settle import settled
from tillroll.plans import views
from tillroll.sources.tables import Tables


def equals(column: str, value: str, collation: str | None = None) -> Column:
    """Equality; with a collation such as ``UTF8_LCASE`` by its rules instead of byte by byte."""
    if collation is None:
        return F.col(column) == F.lit(value)
    return F.collate(F.col(column), collation) == F.collate(F.lit(value), collation)


# -- filters and sorts -----------------------------------------------------------------------


def products_in_category(
    t: Tables, category: str = "Electronics", collation: str | None = None
) -> DataFrame:
    return (
        t.products.filter(equals("Category", category, collation))
        .select("Product_ID", "Product_Name", "Brand", "Unit_Price")
        .orderBy(F.desc("Unit_Price"), "Product_ID")
    )


def orders_in_month(t: Tables, lo: str = "2026-07-01", hi: str = "2026-07-31") -> DataFrame:
    days = F.col("Order_Date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return (
        t.orders.filter(days)
        .select("Order_ID", "Customer_ID", "Order_Date", "Total_Sales")
        .orderBy("Order_Date", "Order_ID")
    )


def customers_in_state(
    t: Tables, state: str = "Texas", collation: str | None = None
) -> DataFrame:
    return t.customers.filter(equals("State", state, collation)).select(
        "Customer_ID", "First_Name", "Last_Name", "City", "Customer_Segment"
    )


def top_priced_products(t: Tables, n: int = 10) -> DataFrame:
    return (
        t.products.select("Product_ID", "Product_Name", "Category", "Unit_Price")
        .orderBy(F.desc("Unit_Price"), "Product_ID")
        .limit(n)
    )


def cancelled_orders(
    t: Tables, status: str = "Cancelled", collation: str | None = None
) -> DataFrame:
    return t.orders.filter(equals("Order_Status", status, collation)).select(
        "Order_ID", "Customer_ID", "Order_Date", "Total_Sales"
    )


# -- grouping --------------------------------------------------------------------------------


def revenue_by_category(t: Tables) -> DataFrame:
    return (
        t.order_items.groupBy("Category")
        .agg(money(F.sum("Sales")).alias("Total_Sales"))
        .orderBy(F.desc("Total_Sales"), "Category")
    )


def orders_by_segment(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("Customer_ID").agg(count("Order_ID").alias("_orders"))
    return (
        per_customer.join(t.customers.select("Customer_ID", "Customer_Segment"), "Customer_ID")
        .groupBy("Customer_Segment")
        .agg(F.sum("_orders").alias("Order_Count"))
        .orderBy(F.desc("Order_Count"), "Customer_Segment")
    )


def review_avg_by_product(t: Tables) -> DataFrame:
    return (
        t.reviews.groupBy("Product_ID")
        .agg(
            rounded_ratio(F.sum("Review_Score"), F.count("Review_Score")).alias("Avg_Score"),
            count().alias("Review_Count"),
        )
        .orderBy(F.desc("Avg_Score"), "Product_ID")
    )


def revenue_by_state(t: Tables) -> DataFrame:
    home = t.customers.select("Customer_ID", "State")
    return (
        views.customer_sums(t)
        .join(home, "Customer_ID")
        .groupBy("State")
        .agg(money(F.sum("Sales")).alias("Total_Sales"))
        .orderBy(F.desc("Total_Sales"), "State")
    )


def orders_by_payment(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy("Payment_Method")
        .agg(count().alias("Order_Count"))
        .orderBy(F.desc("Order_Count"), "Payment_Method")
    )


def big_categories(t: Tables, min_sales: float = 1_000_000) -> DataFrame:
    return revenue_by_category(t).filter(F.col("Total_Sales") > min_sales)


def frequent_customers(t: Tables, min_orders: int = 5) -> DataFrame:
    return (
        t.orders.groupBy("Customer_ID")
        .agg(count("Order_ID").alias("Order_Count"))
        .filter(F.col("Order_Count") > min_orders)
        .orderBy(F.desc("Order_Count"), "Customer_ID")
    )


def high_aov_states(t: Tables, min_aov: float = 1200) -> DataFrame:
    per_customer = t.orders.groupBy("Customer_ID").agg(
        F.sum("Total_Sales").alias("_sales"), F.count("Total_Sales").alias("_orders")
    )
    mean = ratio("_sales", "_orders")
    return (
        per_customer.join(t.customers.select("Customer_ID", "State"), "Customer_ID")
        .groupBy("State")
        .agg(F.sum("_sales").alias("_sales"), F.sum("_orders").alias("_orders"))
        .filter(mean > min_aov)
        .select("State", rounded_ratio("_sales", "_orders").alias("Avg_Order_Value"))
        .orderBy(F.desc("Avg_Order_Value"), "State")
    )


# -- rules -----------------------------------------------------------------------------------


def discount_tier_of(column: str = "Discount", edges=DISCOUNT_EDGES) -> Column:
    """Tier of a discount; whatever no rule covers, NULL too, falls into the last tier."""
    none, low, medium = (F.lit(str(e)).cast("decimal(4,2)") for e in edges)
    discount = F.col(column)
    rules = [
        (discount == none, DISCOUNT_TIERS[0]),
        (discount <= low, DISCOUNT_TIERS[1]),
        (discount <= medium, DISCOUNT_TIERS[2]),
    ]
    return first_match(rules, DISCOUNT_TIERS[3])


def discount_tier(t: Tables, edges=DISCOUNT_EDGES) -> DataFrame:
    return t.order_items.select(
        "Order_Item_ID", "Discount", discount_tier_of("Discount", edges).alias("Discount_Tier")
    )


def value_tier(t: Tables, edges=(5000, 1500)) -> DataFrame:
    value = F.col("Customer_Lifetime_Value")
    tier = first_match(
        [(value >= edges[0], "High Value"), (value >= edges[1], "Medium Value")], "Low Value"
    )
    return t.customers.select("Customer_ID", value, tier.alias("Value_Tier"))


def delivery_speed(t: Tables, edges=(3, 6)) -> DataFrame:
    days = F.col("Delivery_Days")
    speed = first_match([(days <= edges[0], "Fast"), (days <= edges[1], "Normal")], "Slow")
    return t.orders.filter(days.isNotNull()).select("Order_ID", days, speed.alias("Delivery_Speed"))


# -- joins -----------------------------------------------------------------------------------


def order_line_detail(t: Tables) -> DataFrame:
    buyer = t.customers.select("Customer_ID", "First_Name", "Last_Name", "State")
    head = t.orders.select("Order_ID", "Customer_ID", "Order_Date").join(buyer, "Customer_ID")
    return t.order_items.join(head, "Order_ID").select(
        "Order_Item_ID", "Order_Date", "First_Name", "Last_Name", "State", "Category", "Sales"
    )


def never_ordered_products(t: Tables) -> DataFrame:
    ordered = t.order_items.select("Product_ID").distinct()
    return t.products.join(ordered, "Product_ID", "left_anti").select(
        "Product_ID", "Product_Name", "Category"
    )


def last_order_date(t: Tables) -> DataFrame:
    last = t.orders.groupBy("Customer_ID").agg(F.max("Order_Date").alias("Last_Order_Date"))
    return t.customers.join(last, "Customer_ID").select(
        "Customer_ID", "First_Name", "Last_Name", "Last_Order_Date"
    )


def order_carrier(t: Tables) -> DataFrame:
    parcel = t.shipping.select("Order_ID", "Carrier", "Shipping_Mode", "Delivery_Days")
    return t.orders.select("Order_ID").join(parcel, "Order_ID")


def order_360(t: Tables) -> DataFrame:
    buyer = t.customers.select("Customer_ID", "First_Name", "Last_Name", "State")
    head = t.orders.select("Order_ID", "Customer_ID", "Order_Date").join(buyer, "Customer_ID")
    product = t.products.select("Product_ID", "Product_Name")
    return (
        t.order_items.select("Order_ID", "Product_ID", "Quantity", "Sales", "Profit")
        .join(product, "Product_ID")
        .join(head, "Order_ID")
        .select(
            "Order_ID",
            "Order_Date",
            "First_Name",
            "Last_Name",
            "State",
            "Product_Name",
            "Quantity",
            "Sales",
            "Profit",
        )
    )


# -- comparisons with a group ----------------------------------------------------------------


def _mean(column: str) -> Column:
    return ratio(F.sum(column), F.count(column))


def above_avg_spenders(t: Tables) -> DataFrame:
    mean = t.customers.agg(_mean("Total_Spend")).scalar()
    return t.customers.filter(real("Total_Spend") > mean).select("Customer_ID", "Total_Spend")


def above_category_price(t: Tables) -> DataFrame:
    """The means are written first: with their size known, Spark broadcasts them if they are
    few, and the products are not shuffled on a handful of categories."""
    means = settled(t.products.groupBy("Category").agg(_mean("Unit_Price").alias("_mean")))
    return (
        t.products.join(means, "Category")
        .filter(real("Unit_Price") > F.col("_mean"))
        .select("Product_ID", "Product_Name", "Category", "Unit_Price")
    )


def above_avg_orders(t: Tables) -> DataFrame:
    mean = t.orders.agg(_mean("Total_Sales")).scalar()
    return t.orders.filter(real("Total_Sales") > mean).select(
        "Order_ID", "Customer_ID", "Total_Sales"
    )


def top_spender_per_state(t: Tables) -> DataFrame:
    spend = t.customers.select("State", "Customer_ID", "Total_Spend")
    best = settled(spend.groupBy("State").agg(F.max("Total_Spend").alias("Total_Spend")))
    return spend.join(best, ["State", "Total_Spend"]).select("State", "Customer_ID", "Total_Spend")


# -- months and ranks ------------------------------------------------------------------------


def mom_growth(t: Tables) -> DataFrame:
    """Growth against the previous month that has sales; NULL if that month sold nothing."""
    by_month = W.partitionBy().orderBy("Year_Month")
    return (
        views.monthly_sums(t)
        .select("Year_Month", "Total_Sales")
        .withColumn("Prev_Month_Sales", F.lag("Total_Sales").over(by_month))
        .withColumn(
            "MoM_Growth_Pct",
            percent(F.col("Total_Sales") - F.col("Prev_Month_Sales"), "Prev_Month_Sales"),
        )
        .orderBy("Year_Month")
    )


def rfm_base(t: Tables) -> DataFrame:
    last_day = t.orders.agg(F.max("Order_Date")).scalar()
    return (
        views.customer_sums(t)
        .select(
            "Customer_ID",
            F.datediff(last_day, "Last_Order_Date").alias("Recency_Days"),
            F.col("Orders").alias("Frequency"),
            money("Sales").alias("Monetary"),
        )
        .orderBy(F.desc("Monetary"), "Customer_ID")
    )


def category_profit_rank(t: Tables) -> DataFrame:
    profit = t.order_items.groupBy("Category").agg(money(F.sum("Profit")).alias("Total_Profit"))
    by_profit = W.partitionBy().orderBy(F.desc("Total_Profit"))
    return profit.withColumn("Profit_Rank", F.rank().over(by_profit))


def spend_by_churn(t: Tables) -> DataFrame:
    state = t.customers.select("Customer_ID", "Churned")
    return (
        views.customer_sums(t)
        .join(state, "Customer_ID")
        .groupBy("Churned")
        .agg(count().alias("Customer_Count"), F.sum("Sales").alias("_sales"))
        .select(
            F.when(F.col("Churned") == 1, "Churned").otherwise("Active").alias("Status"),
            "Customer_Count",
            rounded_ratio("_sales", "Customer_Count").alias("Avg_Spend"),
        )
    )


def running_total(t: Tables) -> DataFrame:
    """Total over all months so far; it does not start again with a year."""
    so_far = W.partitionBy().orderBy("Year_Month")
    return (
        views.monthly_sums(t)
        .select("Year_Month", F.col("Total_Sales").alias("Monthly_Sales"))
        .withColumn("Running_Total", money(F.sum("Monthly_Sales").over(so_far)))
        .orderBy("Year_Month")
    )


def _product_sales(t: Tables, out: str) -> DataFrame:
    return t.order_items.groupBy("Category", "Product_ID").agg(money(F.sum("Sales")).alias(out))


def rank_in_category(t: Tables) -> DataFrame:
    # one row per product, kept because the ranking reads it twice
    return ranking.rank(
        settled(_product_sales(t, "Product_Sales")),
        "Product_Sales",
        "Rank_In_Category",
        within=["Category"],
    )


def order_sequence(t: Tables) -> DataFrame:
    return ranking.row_number(
        t.orders.select("Customer_ID", "Order_ID", "Order_Date"),
        [F.col("Order_Date"), F.col("Order_ID")],
        "Order_Sequence",
        within=["Customer_ID"],
    )


def moving_avg_3m(t: Tables, window: int = 3) -> DataFrame:
    last_rows = W.partitionBy().orderBy("Year_Month").rowsBetween(1 - window, W.currentRow)
    total, rows = F.sum("Total_Sales").over(last_rows), F.count("Total_Sales").over(last_rows)
    return (
        views.monthly_sums(t)
        .select("Year_Month", "Total_Sales", rounded_ratio(total, rows).alias("Moving_Avg_3M"))
        .orderBy("Year_Month")
    )


def top5_products_per_category(t: Tables, n: int = 5) -> DataFrame:
    """Spark keeps the best ranks of each task before the shuffle, so groups arrive short."""
    by_sales = W.partitionBy("Category").orderBy(F.desc("Total_Sales"))
    return (
        _product_sales(t, "Total_Sales")
        .withColumn("Rnk", F.dense_rank().over(by_sales))
        .filter(F.col("Rnk") <= n)
        .orderBy("Category", "Rnk", "Product_ID")
    )


def top3_customers_per_state(t: Tables, n: int = 3) -> DataFrame:
    by_spend = W.partitionBy("State").orderBy(F.desc("Total_Spend"))
    return (
        views.customer_sums(t)
        .select("Customer_ID", money("Sales").alias("Total_Spend"))
        .join(t.customers.select("Customer_ID", "State"), "Customer_ID")
        .withColumn("Rnk", F.rank().over(by_spend))
        .filter(F.col("Rnk") <= n)
        .select("State", "Customer_ID", "Total_Spend", "Rnk")
        .orderBy("State", "Rnk", "Customer_ID")
    )


def spend_quartile(t: Tables, buckets: int = 4) -> DataFrame:
    return ranking.ntile(
        t.customers.select("Customer_ID", "Total_Spend"),
        buckets,
        [F.desc("Total_Spend"), F.col("Customer_ID")],
        "Spend_Quartile",
    )


# -- parameterised lookup, views, headline numbers -------------------------------------------


def customer_history(
    t: Tables, p_customer_id: str, collation: str | None = None
) -> DataFrame:
    head = t.orders.filter(equals("Customer_ID", p_customer_id, collation)).select(
        "Order_ID", "Order_Date", "Order_Status"
    )
    line = t.order_items.select(
        "Order_ID", "Order_Item_ID", "Product_ID", "Category", "Quantity", "Sales", "Profit"
    )
    return (
        head.join(line, "Order_ID")
        .orderBy(F.desc("Order_Date"), "Order_ID", "Order_Item_ID")
        .drop("Order_Item_ID")
    )


def top20_ltv(t: Tables, n: int = 20) -> DataFrame:
    return (
        views.customer_ltv(t)
        .select("Customer_ID", "First_Name", "Last_Name", "State", "Total_Sales", "Total_Orders")
        .orderBy(F.desc_nulls_last("Total_Sales"), "Customer_ID")
        .limit(n)
    )


def monthly_with_year(t: Tables) -> DataFrame:
    return (
        views.monthly_sales(t)
        .select("Year_Month", "Total_Sales", F.left("Year_Month", F.lit(4)).alias("Yr"))
        .orderBy("Year_Month")
    )


def headline_kpis(t: Tables) -> DataFrame:
    customers = t.customers.agg(count()).scalar()
    return (
        views.order_sums(t)
        .agg(
            F.sum("Sales").alias("_sales"),
            F.sum("Profit").alias("_profit"),
            count("Order_ID").alias("_orders"),
        )
        .select(
            money("_sales").alias("Total_Revenue"),
            money("_profit").alias("Total_Profit"),
            percent("_profit", "_sales").alias("Profit_Margin_Pct"),
            F.col("_orders").alias("Total_Orders"),
            customers.alias("Total_Customers"),
            rounded_ratio("_sales", "_orders").alias("Avg_Order_Value"),
        )
    )


def return_rate(t: Tables) -> DataFrame:
    return (
        t.order_items.groupBy("Category")
        .agg(
            count().alias("Total_Items"),
            F.count_if(F.col("Return_Flag") == "Yes").alias("Returned_Items"),
        )
        .withColumn("Return_Rate_Pct", percent("Returned_Items", "Total_Items"))
        .orderBy(F.desc("Return_Rate_Pct"), "Category")
    )


def churn_rate_by_segment(t: Tables) -> DataFrame:
    return (
        t.customers.groupBy("Customer_Segment")
        .agg(count().alias("Total_Customers"), F.sum("Churned").alias("Churned_Customers"))
        .withColumn("Churn_Rate_Pct", percent("Churned_Customers", "Total_Customers"))
        .orderBy(F.desc("Churn_Rate_Pct"), "Customer_Segment")
    )
