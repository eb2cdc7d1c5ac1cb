"""The retail tables as DuckDB common table expressions over the star-schema Parquet views.

Table names carry the prefix ``t_`` because a bare ``orders`` is already the raw view.
"""

import re

CTES = {
    "t_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS Product_ID, p_name AS Product_Name,
               'CAT-' || p_type || '-' || (p_size % 5) AS Category_ID, p_type AS Category,
               p_type || '/' || (p_size % 5) AS Sub_Category, p_brand AS Brand,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1))
                    AS DECIMAL(10,2)) AS Unit_Cost,
               CAST(p_retailprice AS DECIMAL(10,2)) AS Unit_Price,
               CAST(p_size * 10 AS INTEGER) AS Stock_Quantity, 100 AS Reorder_Level,
               CASE WHEN p_partkey % 17 = 0 THEN NULL
                    ELSE CAST(1 + (p_partkey % 9) * 0.5 AS DECIMAL(2,1)) END AS Product_Rating,
               DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS Launch_Date
        FROM part""",
    "t_categories": "SELECT DISTINCT Category_ID, Category, Sub_Category FROM t_products",
    "t_lines": """
        SELECT l.*, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                              CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)) AS item_id
        FROM lineitem l""",
    "t_all_items": """
        SELECT item_id AS Order_Item_ID, CAST(l_orderkey AS VARCHAR) AS Order_ID, Product_ID,
               Category, Sub_Category, Brand, CAST(l_quantity AS INTEGER) AS Quantity, Unit_Price,
               CAST(l_discount * 5 AS DECIMAL(4,2)) AS Discount,
               CAST(CAST(l_quantity AS INTEGER) * Unit_Price
                    * (1 - CAST(l_discount * 5 AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS Sales,
               CAST(5 + l_orderkey % 20 AS DECIMAL(8,2)) AS Shipping_Cost,
               Unit_Cost,
               CASE WHEN l_returnflag = 'R' AND l_linenumber % 3 = 0 THEN 'Yes' ELSE 'No' END
                   AS Return_Flag,
               l_orderkey, l_linenumber, l_partkey, l_suppkey
        FROM t_lines JOIN t_products ON CAST(l_partkey AS VARCHAR) = Product_ID""",
    "t_order_items": """
        SELECT i.* EXCLUDE (Unit_Cost),
               CAST(Sales - Quantity * Unit_Cost - Shipping_Cost AS DECIMAL(12,2)) AS Profit
        FROM t_all_items i""",
    "t_dirty_items": """
        SELECT * REPLACE (CASE WHEN l_orderkey % 83 = 0 THEN 'X' || Order_ID ELSE Order_ID END
                          AS Order_ID) FROM t_order_items""",
    "t_order_sums": """
        SELECT Order_ID, SUM(Sales) AS s, SUM(Profit) AS p, COUNT(*) AS n
        FROM t_order_items GROUP BY Order_ID""",
    "t_status": """
        SELECT *, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'Processing'
                       WHEN o_orderkey % 13 = 0 THEN 'Cancelled'
                       WHEN o_orderkey % 11 = 0 THEN 'Returned' ELSE 'Delivered' END AS st
        FROM orders""",
    "t_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS Order_ID, CAST(o_custkey AS VARCHAR) AS Customer_ID,
               CAST(o_orderdate AS DATE) AS Order_Date,
               CASE WHEN st IN ('Processing', 'Cancelled') THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 3 AS INTEGER) END
                   AS Ship_Date,
               st AS Order_Status,
               CASE WHEN st IN ('Processing', 'Cancelled') THEN NULL
                    ELSE CAST(1 + (o_orderkey * 7) % 12 AS INTEGER) END AS Delivery_Days,
               CAST(COALESCE(s, 0) AS DECIMAL(18,2)) AS Total_Sales,
               CAST(COALESCE(p, 0) AS DECIMAL(18,2)) AS Total_Profit,
               CAST(COALESCE(n, 0) AS INTEGER) AS Item_Count, o_orderpriority AS Payment_Method,
               o_orderkey, o_custkey
        FROM t_status LEFT JOIN t_order_sums ON CAST(o_orderkey AS VARCHAR) = Order_ID""",
    "t_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS Customer_ID, 'Customer' AS First_Name,
               c_name AS Last_Name,
               CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male'
                    ELSE 'Female' END AS Gender,
               CAST(18 + (c_custkey * 37) % 60 AS INTEGER) AS Customer_Age,
               'c' || c_custkey || '@example.com' AS Email, 'City_' || (c_custkey % 7) AS City,
               n_name AS State, r_name AS Country,
               CASE WHEN c_acctbal < 2500 THEN 'Low' WHEN c_acctbal < 7000 THEN 'Medium'
                    ELSE 'High' END AS Income_Group,
               c_mktsegment AS Customer_Segment,
               DATE '1994-01-01' + CAST((c_custkey * 13) % 365 AS INTEGER) AS Customer_Since,
               CAST(COALESCE(n, 0) AS INTEGER) AS Total_Orders,
               CAST(COALESCE(s, 0) AS DECIMAL(18,2)) AS Total_Spend,
               CAST(CAST(COALESCE(s, 0) AS DECIMAL(18,2))
                    * CAST(1 + (c_custkey % 5) * 0.1 AS DECIMAL(3,1)) AS DECIMAL(18,2))
                   AS Customer_Lifetime_Value,
               CAST(date_diff('day', d, (SELECT MAX(Order_Date) FROM t_orders)) AS INTEGER)
                   AS Recency_Days,
               CASE WHEN d IS NULL
                      OR date_diff('day', d, (SELECT MAX(Order_Date) FROM t_orders)) > 180
                    THEN 1 ELSE 0 END AS Churned
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT Customer_ID AS cid, COUNT(*) AS n, SUM(Total_Sales) AS s,
                          MAX(Order_Date) AS d FROM t_orders GROUP BY Customer_ID)
               ON CAST(c_custkey AS VARCHAR) = cid""",
    "t_payments": """
        SELECT 'PAY' || Order_ID AS Payment_ID, Order_ID, Payment_Method,
               Total_Sales AS Amount_Paid,
               CASE WHEN Order_Status = 'Cancelled' THEN 'Refunded' ELSE 'Completed' END
                   AS Payment_Status, Order_Date AS Transaction_Date
        FROM t_orders""",
    "t_shipping": """
        SELECT 'SHP' || Order_ID AS Shipping_ID, Order_ID,
               CASE o_orderkey % 3 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express'
                    ELSE 'Same Day' END AS Shipping_Mode,
               'Carrier_' || (o_orderkey % 4) AS Carrier, Ship_Date, Delivery_Days,
               'City_' || (o_custkey % 7) AS Shipping_City
        FROM t_orders WHERE Ship_Date IS NOT NULL""",
    "t_reviews": """
        SELECT 'R' || Order_Item_ID AS Review_ID, Order_Item_ID, Product_ID,
               CAST(1 + (l_partkey + l_suppkey) % 5 AS INTEGER) AS Review_Score,
               'review ' || Product_ID AS Review_Text,
               CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE DATE '2002-01-01' END AS Review_Date
        FROM t_order_items WHERE (l_linenumber + l_partkey) % 2 = 0""",
    # the joined table at order-item grain, and the customer table derived from it
    "t_flat": """
        SELECT i.* EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey),
               o.Customer_ID, o.Order_Date, o.Ship_Date, o.Order_Status, o.Delivery_Days,
               o.Total_Sales, o.Total_Profit, o.Item_Count, o.Payment_Method,
               c.* EXCLUDE (Customer_ID), s.Shipping_Mode, s.Carrier, r.Review_Score
        FROM t_order_items i
        LEFT JOIN t_orders o ON i.Order_ID = o.Order_ID
        LEFT JOIN t_customers c ON o.Customer_ID = c.Customer_ID
        LEFT JOIN t_shipping s ON i.Order_ID = s.Order_ID
        LEFT JOIN (SELECT Order_Item_ID, SUM(Review_Score)::DOUBLE / COUNT(*) AS Review_Score
                   FROM t_reviews GROUP BY 1) r ON i.Order_Item_ID = r.Order_Item_ID""",
    "t_rfm": """
        SELECT f.Customer_ID,
               CAST(date_diff('day', MAX(Order_Date), (SELECT MAX(Order_Date) FROM t_flat))
                    AS INTEGER) AS Recency,
               COUNT(DISTINCT Order_ID) AS Frequency, SUM(Sales) AS Monetary,
               any_value(Customer_Segment) AS Customer_Segment,
               any_value(Customer_Age) AS Customer_Age, any_value(Gender) AS Gender,
               any_value(State) AS State, any_value(Income_Group) AS Income_Group,
               any_value(Customer_Lifetime_Value) AS Customer_Lifetime_Value,
               any_value(Churned) AS Churned
        FROM t_flat f GROUP BY f.Customer_ID""",
    "t_cuts": """
        SELECT quantile_cont(Recency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS r,
               quantile_cont(Monetary::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS m, COUNT(*) AS n
        FROM t_rfm""",
    "t_scored": """
        SELECT x.*, CAST(CASE WHEN Recency <= r[1] THEN 5 WHEN Recency <= r[2] THEN 4
                         WHEN Recency <= r[3] THEN 3 WHEN Recency <= r[4] THEN 2
                         ELSE 1 END AS INTEGER) AS R_Score,
               CAST(CASE WHEN pos <= 1 + (n - 1) * 0.2 THEN 1 WHEN pos <= 1 + (n - 1) * 0.4 THEN 2
                         WHEN pos <= 1 + (n - 1) * 0.6 THEN 3 WHEN pos <= 1 + (n - 1) * 0.8 THEN 4
                         ELSE 5 END AS INTEGER) AS F_Score,
               CAST(CASE WHEN Monetary::DOUBLE <= m[1] THEN 1 WHEN Monetary::DOUBLE <= m[2] THEN 2
                         WHEN Monetary::DOUBLE <= m[3] THEN 3 WHEN Monetary::DOUBLE <= m[4] THEN 4
                         ELSE 5 END AS INTEGER) AS M_Score
        FROM (SELECT *, row_number() OVER (ORDER BY Frequency, Customer_ID) AS pos FROM t_rfm) x
        CROSS JOIN t_cuts""",
    "t_segments": """
        SELECT * EXCLUDE (pos), R_Score::VARCHAR || F_Score || M_Score AS RFM_Score,
               R_Score + F_Score + M_Score AS RFM_Total,
               CASE WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
                    WHEN R_Score >= 3 AND F_Score >= 3 THEN 'Loyal Customers'
                    WHEN R_Score >= 4 AND F_Score <= 2 THEN 'New Customers'
                    WHEN R_Score <= 2 AND F_Score >= 4 THEN 'At Risk'
                    WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score <= 2 THEN 'Lost'
                    ELSE 'Needs Attention' END AS RFM_Segment
        FROM t_scored""",
}

_ORDER = list(CTES)


def with_tables(query: str) -> str:
    """``query`` behind the CTEs it uses, directly or through other CTEs."""
    needed: set[str] = set()
    texts = [query]
    while texts:
        text = texts.pop()
        for name in _ORDER:
            if name not in needed and _mentions(text, name):
                needed.add(name)
                texts.append(CTES[name])
    if not needed:
        return query
    heads = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in _ORDER if n in needed)
    rest = query.lstrip()
    if rest.upper().startswith("WITH "):
        return f"WITH {heads},\n{rest[5:]}"
    return f"WITH {heads}\n{rest}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None
