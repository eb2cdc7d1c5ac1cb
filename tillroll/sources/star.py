"""The retail tables derived from the star-schema Parquet files of the test data.

The joins run on the numeric keys of the files; the text keys of the model appear only in the
results. Nothing is hinted: Spark broadcasts a side only when its size allows it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.model import CHURN_AFTER_DAYS, SCHEMAS
from tillroll.sources.tables import Tables

# wide enough for one order or customer that holds a third of very large data
TOTAL = "decimal(18,2)"

FILES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def star_tables(spark: SparkSession, folder: str, orphans: bool = False) -> Tables:
    """The eight tables; with ``orphans`` some lines name orders that do not exist."""
    star = _Star(spark, folder, orphans)

    def declared(table: str, frame: str):
        return lambda _: getattr(star, frame).select(*SCHEMAS[table].names)

    return Tables(
        {
            "categories": lambda t: t.products.select(
                "Category_ID", "Category", "Sub_Category"
            ).distinct(),
            "products": declared("products", "products"),
            "customers": declared("customers", "customers"),
            "orders": declared("orders", "orders"),
            "order_items": declared("order_items", "lines"),
            "payments": declared("payments", "payments"),
            "shipping": declared("shipping", "shipping"),
            "reviews": declared("reviews", "reviews"),
        }
    )


def read_star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(FILES[name]).parquet(f"{folder}/{name}.parquet")


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The line items as delivered; (l_orderkey, l_linenumber) is not unique there."""
    return read_star(spark, folder, "lineitem")


def _plus_days(start: str, days):
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


class _Star:
    """The tables with the numeric keys still beside them."""

    def __init__(self, spark: SparkSession, folder: str, orphans: bool):
        self._read = lambda name: read_star(spark, folder, name)
        self._orphans = orphans

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        group = (F.col("p_size") % 5).cast("string")
        price = F.col("p_retailprice").cast("decimal(10,2)")
        rating = (F.lit(1) + (key % 9) * F.lit(0.5)).cast("decimal(2,1)")
        return self._read("part").select(
            "p_partkey",
            key.cast("string").alias("Product_ID"),
            F.col("p_name").alias("Product_Name"),
            F.concat(F.lit("CAT-"), "p_type", F.lit("-"), group).alias("Category_ID"),
            F.col("p_type").alias("Category"),
            F.concat("p_type", F.lit("/"), group).alias("Sub_Category"),
            F.col("p_brand").alias("Brand"),
            (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(10,2)").alias("Unit_Cost"),
            price.alias("Unit_Price"),
            (F.col("p_size") * 10).cast("int").alias("Stock_Quantity"),
            F.lit(100).alias("Reorder_Level"),
            F.when(key % 17 != 0, rating).alias("Product_Rating"),
            _plus_days("1994-01-01", key % 365).alias("Launch_Date"),
        )

    @cached_property
    def _order_id(self):
        key = F.col("l_orderkey").cast("string")
        return F.when(F.col("l_orderkey") % 83 == 0, F.concat(F.lit("X"), key)).otherwise(key) if self._orphans else key

    @cached_property
    def _line_id(self):
        price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
        return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price)

    @cached_property
    def lines(self) -> DataFrame:
        product = self.products.select(
            "p_partkey", "Product_ID", "Category", "Sub_Category", "Brand", "Unit_Price", "Unit_Cost"
        )
        # narrow factors keep the products of decimals within 64 bits
        quantity = F.col("l_quantity").cast("decimal(4,0)")
        left = F.lit(1).cast("decimal(1,0)") - (F.col("l_discount") * 5).cast("decimal(4,2)")
        amount = (quantity * F.col("Unit_Price")).cast("decimal(12,2)")
        sales = (amount * left).cast("decimal(12,2)")
        cost = (quantity * F.col("Unit_Cost")).cast("decimal(12,2)")
        shipping = (F.lit(5) + F.col("l_orderkey") % 20).cast("decimal(8,2)")
        returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 3 == 0)
        return (
            self._read("lineitem").join(product, F.col("l_partkey") == F.col("p_partkey"))
            .select("*", sales.alias("Sales"), shipping.alias("Shipping_Cost"))
            .select(
                "l_orderkey",
                self._line_id.alias("Order_Item_ID"),
                self._order_id.alias("Order_ID"),
                "Product_ID",
                "Category",
                "Sub_Category",
                "Brand",
                F.col("l_quantity").cast("int").alias("Quantity"),
                "Unit_Price",
                (F.col("l_discount") * 5).cast("decimal(4,2)").alias("Discount"),
                "Sales",
                "Shipping_Cost",
                (F.col("Sales") - cost - F.col("Shipping_Cost"))
                .cast("decimal(12,2)")
                .alias("Profit"),
                F.when(returned, "Yes").otherwise("No").alias("Return_Flag"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        totals = self.lines.groupBy("l_orderkey").agg(
            F.sum("Sales").alias("_sales"),
            F.sum("Profit").alias("_profit"),
            F.count(F.lit(1)).alias("_items"),
        )
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        status = (
            F.when((F.col("o_orderstatus") == "P") & (key % 2 == 0), "Processing")
            .when(key % 13 == 0, "Cancelled")
            .when(key % 11 == 0, "Returned")
            .otherwise("Delivered")
        )
        shipped = ~status.isin("Processing", "Cancelled")
        return self._read("orders").join(
            totals, F.col("o_orderkey") == F.col("l_orderkey"), "left"
        ).select(
            "o_orderkey",
            "o_custkey",
            key.cast("string").alias("Order_ID"),
            F.col("o_custkey").cast("string").alias("Customer_ID"),
            day.alias("Order_Date"),
            F.when(shipped, F.date_add(day, (1 + key % 3).cast("int"))).alias("Ship_Date"),
            status.alias("Order_Status"),
            F.when(shipped, (1 + (key * 7) % 12).cast("int")).alias("Delivery_Days"),
            F.coalesce("_sales", F.lit(0)).cast(TOTAL).alias("Total_Sales"),
            F.coalesce("_profit", F.lit(0)).cast(TOTAL).alias("Total_Profit"),
            F.coalesce("_items", F.lit(0)).cast("int").alias("Item_Count"),
            F.col("o_orderpriority").alias("Payment_Method"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        per_customer = self.orders.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("_orders"),
            F.sum("Total_Sales").alias("_spend"),
            F.max("Order_Date").alias("_last"),
        )
        key = F.col("c_custkey")
        last_day = self.orders.agg(F.max("Order_Date")).scalar()
        spend = F.coalesce("_spend", F.lit(0)).cast(TOTAL)
        growth = (F.lit(1) + (key % 5) * F.lit(0.1)).cast("decimal(3,1)")
        gender = F.when(key % 11 != 0, F.when(key % 2 == 0, "Male").otherwise("Female"))
        income = (
            F.when(F.col("c_acctbal") < 2500, "Low")
            .when(F.col("c_acctbal") < 7000, "Medium")
            .otherwise("High")
        )
        recency = F.datediff(last_day, "_last")
        active = F.coalesce(recency <= CHURN_AFTER_DAYS, F.lit(False))
        return (
            self._read("customer")
            .join(self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                key.cast("string").alias("Customer_ID"),
                F.lit("Customer").alias("First_Name"),
                F.col("c_name").alias("Last_Name"),
                gender.alias("Gender"),
                (18 + (key * 37) % 60).cast("int").alias("Customer_Age"),
                F.concat(F.lit("c"), key, F.lit("@example.com")).alias("Email"),
                F.concat(F.lit("City_"), key % 7).alias("City"),
                F.col("n_name").alias("State"),
                F.col("r_name").alias("Country"),
                income.alias("Income_Group"),
                F.col("c_mktsegment").alias("Customer_Segment"),
                _plus_days("1994-01-01", (key * 13) % 365).alias("Customer_Since"),
                F.coalesce("_orders", F.lit(0)).cast("int").alias("Total_Orders"),
                spend.alias("Total_Spend"),
                (spend * growth).cast(TOTAL).alias("Customer_Lifetime_Value"),
                recency.alias("Recency_Days"),
                F.when(active, 0).otherwise(1).alias("Churned"),
            )
        )

    @cached_property
    def payments(self) -> DataFrame:
        refunded = F.col("Order_Status") == "Cancelled"
        return self.orders.select(
            F.concat(F.lit("PAY"), "Order_ID").alias("Payment_ID"),
            "Order_ID",
            "Payment_Method",
            F.col("Total_Sales").alias("Amount_Paid"),
            F.when(refunded, "Refunded").otherwise("Completed").alias("Payment_Status"),
            F.col("Order_Date").alias("Transaction_Date"),
        )

    @cached_property
    def shipping(self) -> DataFrame:
        key = F.col("o_orderkey")
        mode = F.when(key % 3 == 0, "Standard").when(key % 3 == 1, "Express").otherwise("Same Day")
        return self.orders.filter(F.col("Ship_Date").isNotNull()).select(
            F.concat(F.lit("SHP"), "Order_ID").alias("Shipping_ID"),
            "Order_ID",
            mode.alias("Shipping_Mode"),
            F.concat(F.lit("Carrier_"), key % 4).alias("Carrier"),
            "Ship_Date",
            "Delivery_Days",
            F.concat(F.lit("City_"), F.col("o_custkey") % 7).alias("Shipping_City"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        part = F.col("l_partkey")
        product = part.cast("string")
        return self._read("lineitem").filter((F.col("l_linenumber") + part) % 2 == 0).select(
            F.concat(F.lit("R"), self._line_id).alias("Review_ID"),
            self._line_id.alias("Order_Item_ID"),
            product.alias("Product_ID"),
            (1 + (part + F.col("l_suppkey")) % 5).cast("int").alias("Review_Score"),
            F.concat(F.lit("review "), product).alias("Review_Text"),
            F.when(part % 19 != 0, F.lit("2002-01-01").cast("date")).alias("Review_Date"),
        )
