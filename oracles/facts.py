"""What the retail tables are, stated here once more so that no mistake of the engine is shared."""

# The tables and their columns, in order.
COLUMNS = {
    "categories": (
        "Category_ID",
        "Category",
        "Sub_Category",
    ),
    "products": (
        "Product_ID",
        "Product_Name",
        "Category_ID",
        "Category",
        "Sub_Category",
        "Brand",
        "Unit_Cost",
        "Unit_Price",
        "Stock_Quantity",
        "Reorder_Level",
        "Product_Rating",
        "Launch_Date",
    ),
    "customers": (
        "Customer_ID",
        "First_Name",
        "Last_Name",
        "Gender",
        "Customer_Age",
        "Email",
        "City",
        "State",
        "Country",
        "Income_Group",
        "Customer_Segment",
        "Customer_Since",
        "Total_Orders",
        "Total_Spend",
        "Customer_Lifetime_Value",
        "Recency_Days",
        "Churned",
    ),
    "orders": (
        "Order_ID",
        "Customer_ID",
        "Order_Date",
        "Ship_Date",
        "Order_Status",
        "Delivery_Days",
        "Total_Sales",
        "Total_Profit",
        "Item_Count",
        "Payment_Method",
    ),
    "order_items": (
        "Order_Item_ID",
        "Order_ID",
        "Product_ID",
        "Category",
        "Sub_Category",
        "Brand",
        "Quantity",
        "Unit_Price",
        "Discount",
        "Sales",
        "Shipping_Cost",
        "Profit",
        "Return_Flag",
    ),
    "payments": (
        "Payment_ID",
        "Order_ID",
        "Payment_Method",
        "Amount_Paid",
        "Payment_Status",
        "Transaction_Date",
    ),
    "shipping": (
        "Shipping_ID",
        "Order_ID",
        "Shipping_Mode",
        "Carrier",
        "Ship_Date",
        "Delivery_Days",
        "Shipping_City",
    ),
    "reviews": (
        "Review_ID",
        "Order_Item_ID",
        "Product_ID",
        "Review_Score",
        "Review_Text",
        "Review_Date",
    ),
}

# Columns that may not be empty.
REQUIRED = {
    "categories": (
        "Category_ID",
        "Category",
        "Sub_Category",
    ),
    "products": (
        "Product_ID",
        "Product_Name",
        "Category_ID",
        "Category",
        "Sub_Category",
        "Brand",
        "Unit_Cost",
        "Unit_Price",
        "Stock_Quantity",
        "Reorder_Level",
    ),
    "customers": (
        "Customer_ID",
        "First_Name",
        "Last_Name",
        "Customer_Age",
        "City",
        "State",
        "Country",
        "Income_Group",
        "Customer_Segment",
        "Customer_Since",
    ),
    "orders": (
        "Order_ID",
        "Customer_ID",
        "Order_Date",
        "Order_Status",
        "Total_Sales",
        "Total_Profit",
        "Item_Count",
        "Payment_Method",
    ),
    "order_items": (
        "Order_Item_ID",
        "Order_ID",
        "Product_ID",
        "Category",
        "Sub_Category",
        "Brand",
        "Quantity",
        "Unit_Price",
        "Discount",
        "Sales",
        "Shipping_Cost",
        "Profit",
        "Return_Flag",
    ),
    "payments": (
        "Payment_ID",
        "Order_ID",
        "Payment_Method",
        "Amount_Paid",
        "Payment_Status",
        "Transaction_Date",
    ),
    "shipping": (
        "Shipping_ID",
        "Order_ID",
        "Shipping_Mode",
        "Carrier",
        "Ship_Date",
        "Delivery_Days",
    ),
    "reviews": (
        "Review_ID",
        "Order_Item_ID",
        "Product_ID",
        "Review_Score",
    ),
}

# Longest texts.
TEXT_LENGTHS = {
    "categories": {
        "Category_ID": 10,
        "Category": 50,
        "Sub_Category": 50,
    },
    "products": {
        "Product_ID": 10,
        "Product_Name": 150,
        "Category_ID": 10,
        "Category": 50,
        "Sub_Category": 50,
        "Brand": 50,
    },
    "customers": {
        "Customer_ID": 10,
        "First_Name": 50,
        "Last_Name": 50,
        "Gender": 20,
        "Email": 150,
        "City": 50,
        "State": 50,
        "Country": 50,
        "Income_Group": 20,
        "Customer_Segment": 20,
    },
    "orders": {
        "Order_ID": 10,
        "Customer_ID": 10,
        "Order_Status": 20,
        "Payment_Method": 30,
    },
    "order_items": {
        "Order_Item_ID": 12,
        "Order_ID": 10,
        "Product_ID": 10,
        "Category": 50,
        "Sub_Category": 50,
        "Brand": 50,
        "Return_Flag": 3,
    },
    "payments": {
        "Payment_ID": 10,
        "Order_ID": 10,
        "Payment_Method": 30,
        "Payment_Status": 20,
    },
    "shipping": {
        "Shipping_ID": 10,
        "Order_ID": 10,
        "Shipping_Mode": 20,
        "Carrier": 30,
        "Shipping_City": 50,
    },
    "reviews": {
        "Review_ID": 12,
        "Order_Item_ID": 12,
        "Product_ID": 10,
        "Review_Text": 500,
    },
}

# Primary keys.
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

# Child, parent, key.
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

# Row counts that the count check is given; that of categories holds.
EXPECTED_ROWS = {
    "categories": 30,
    "products": 600,
    "customers": 6000,
    "orders": 18000,
    "order_items": 37893,
    "payments": 18000,
    "shipping": 15282,
    "reviews": 20841,
}
