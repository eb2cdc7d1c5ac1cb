"""The retail data model: schemas, keys, references, defaults and business constants."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(name, size, required=True):
    return T.StructField(name, T.StringType(), not required, {"max_length": size})


def _money(name, precision, scale=2, required=True):
    return T.StructField(name, T.DecimalType(precision, scale), not required)


def _whole(name, required=True):
    return T.StructField(name, T.IntegerType(), not required)


def _day(name, required=True):
    return T.StructField(name, T.DateType(), not required)


# The eight tables with their columns, types and required flags.
SCHEMAS: dict[str, T.StructType] = {
    "categories": T.StructType(
        [_text("Category_ID", 10), _text("Category", 50), _text("Sub_Category", 50)]
    ),
    "products": T.StructType(
        [
            _text("Product_ID", 10),
            _text("Product_Name", 150),
            _text("Category_ID", 10),
            _text("Category", 50),
            _text("Sub_Category", 50),
            _text("Brand", 50),
            _money("Unit_Cost", 10),
            _money("Unit_Price", 10),
            _whole("Stock_Quantity"),
            _whole("Reorder_Level"),
            _money("Product_Rating", 2, 1, required=False),
            _day("Launch_Date", required=False),
        ]
    ),
    "customers": T.StructType(
        [
            _text("Customer_ID", 10),
            _text("First_Name", 50),
            _text("Last_Name", 50),
            _text("Gender", 20, required=False),
            _whole("Customer_Age"),
            _text("Email", 150, required=False),
            _text("City", 50),
            _text("State", 50),
            _text("Country", 50),
            _text("Income_Group", 20),
            _text("Customer_Segment", 20),
            _day("Customer_Since"),
            _whole("Total_Orders", required=False),
            _money("Total_Spend", 12, required=False),
            _money("Customer_Lifetime_Value", 12, required=False),
            _whole("Recency_Days", required=False),
            _whole("Churned", required=False),
        ]
    ),
    "orders": T.StructType(
        [
            _text("Order_ID", 10),
            _text("Customer_ID", 10),
            _day("Order_Date"),
            _day("Ship_Date", required=False),
            _text("Order_Status", 20),
            _whole("Delivery_Days", required=False),
            _money("Total_Sales", 12),
            _money("Total_Profit", 12),
            _whole("Item_Count"),
            _text("Payment_Method", 30),
        ]
    ),
    "order_items": T.StructType(
        [
            _text("Order_Item_ID", 12),
            _text("Order_ID", 10),
            _text("Product_ID", 10),
            _text("Category", 50),
            _text("Sub_Category", 50),
            _text("Brand", 50),
            _whole("Quantity"),
            _money("Unit_Price", 10),
            _money("Discount", 4),
            _money("Sales", 12),
            _money("Shipping_Cost", 8),
            _money("Profit", 12),
            _text("Return_Flag", 3),
        ]
    ),
    "payments": T.StructType(
        [
            _text("Payment_ID", 10),
            _text("Order_ID", 10),
            _text("Payment_Method", 30),
            _money("Amount_Paid", 12),
            _text("Payment_Status", 20),
            _day("Transaction_Date"),
        ]
    ),
    "shipping": T.StructType(
        [
            _text("Shipping_ID", 10),
            _text("Order_ID", 10),
            _text("Shipping_Mode", 20),
            _text("Carrier", 30),
            _day("Ship_Date"),
            _whole("Delivery_Days"),
            _text("Shipping_City", 50, required=False),
        ]
    ),
    "reviews": T.StructType(
        [
            _text("Review_ID", 12),
            _text("Order_Item_ID", 12),
            _text("Product_ID", 10),
            _whole("Review_Score"),
            _text("Review_Text", 500, required=False),
            _day("Review_Date", required=False),
        ]
    ),
}

TABLES = tuple(SCHEMAS)

PRIMARY_KEYS = {
    "categories": "Category_ID",
    "products": "Product_ID",
    "customers": "Customer_ID",
    "orders": "Order_ID",
    "order_items": "Order_Item_ID",
    "payments": "Payment_ID",
    "shipping": "Shipping_ID",
    "reviews": "Review_ID",
}

# child table, parent table, shared key column
FOREIGN_KEYS = (
    ("products", "categories", "Category_ID"),
    ("orders", "customers", "Customer_ID"),
    ("order_items", "orders", "Order_ID"),
    ("order_items", "products", "Product_ID"),
    ("payments", "orders", "Order_ID"),
    ("shipping", "orders", "Order_ID"),
    ("reviews", "order_items", "Order_Item_ID"),
    ("reviews", "products", "Product_ID"),
)

# What a column holds when the input file does not carry it at all.
DEFAULTS = {
    "customers": {
        "Total_Orders": 0,
        "Total_Spend": 0,
        "Customer_Lifetime_Value": 0,
        "Churned": 0,
    },
    "order_items": {"Discount": 0, "Return_Flag": "No"},
}

# Row counts documented for the original data set.
DOCUMENTED_ROWS = {
    "categories": 35,
    "products": 600,
    "customers": 6000,
    "orders": 18000,
    "order_items": 37893,
    "payments": 18000,
    "shipping": 15282,
    "reviews": 20841,
}

CHURN_AFTER_DAYS = 180
SEED = 42
REVIEW_SCORES = (1, 5)

# Labels of the four discount tiers and their inner edges.
DISCOUNT_TIERS = ("No Discount", "Low (0-10%)", "Medium (10-20%)", "High (20%+)")
DISCOUNT_EDGES = (0, 0.10, 0.20)
