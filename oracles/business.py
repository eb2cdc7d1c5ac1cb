"""DuckDB texts for the views and the 42 business questions, written from their definitions."""


def half_up(expr: str, digits: int) -> str:
    """Decimal rounding of a binary quotient: ties go away from zero, as in exact arithmetic."""
    return f"round({expr} + sign({expr}) * 1e-9, {digits})"


def quotient(top: str, bottom: str, digits: int, factor: str = "") -> str:
    return half_up(f"(({top})::DOUBLE{factor} / nullif(({bottom})::DOUBLE, 0))", digits)


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,2))"


MONTHS = f"""
    SELECT strftime(Order_Date, '%Y-%m') AS Year_Month, {dec('SUM(Sales)')} AS Total_Sales,
           {dec('SUM(Profit)')} AS Total_Profit, COUNT(DISTINCT o.Order_ID) AS Order_Count
    FROM t_orders o JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY 1"""

LTV = f"""
    SELECT c.Customer_ID, First_Name, Last_Name, State, Customer_Segment, Customer_Since, Churned,
           COUNT(DISTINCT o.Order_ID) AS Total_Orders, {dec('SUM(Sales)')} AS Total_Sales,
           {dec('SUM(Profit)')} AS Total_Profit,
           {quotient('SUM(Sales)', 'COUNT(DISTINCT o.Order_ID)', 2)} AS Avg_Order_Value
    FROM t_customers c LEFT JOIN t_orders o ON c.Customer_ID = o.Customer_ID
    LEFT JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY ALL"""

PRODUCTS_FANNED = f"""
    SELECT p.Product_ID, Product_Name, p.Category, p.Sub_Category, p.Brand, Stock_Quantity,
           COALESCE(SUM(Quantity), 0)::BIGINT AS Units_Sold,
           {dec('COALESCE(SUM(Sales), 0)')} AS Total_Sales,
           {dec('COALESCE(SUM(Profit), 0)')} AS Total_Profit,
           {quotient("SUM(CASE WHEN Return_Flag = 'Yes' THEN 1 ELSE 0 END)",
                     "COUNT(i.Order_Item_ID)", 1, " * 100")} AS Return_Rate_Pct,
           {quotient('SUM(Review_Score)', 'COUNT(Review_Score)', 2)} AS Avg_Review_Score
    FROM t_products p LEFT JOIN t_order_items i ON p.Product_ID = i.Product_ID
    LEFT JOIN t_reviews r ON p.Product_ID = r.Product_ID GROUP BY ALL"""

PRODUCTS_PLAIN = f"""
    SELECT p.Product_ID, Product_Name, Category, Sub_Category, Brand, Stock_Quantity,
           COALESCE(u, 0)::BIGINT AS Units_Sold, {dec('COALESCE(s, 0)')} AS Total_Sales,
           {dec('COALESCE(f, 0)')} AS Total_Profit,
           {quotient('b', 'n', 1, ' * 100')} AS Return_Rate_Pct,
           {quotient('sc', 'nr', 2)} AS Avg_Review_Score
    FROM t_products p
    LEFT JOIN (SELECT Product_ID, SUM(Quantity) u, SUM(Sales) s, SUM(Profit) f, COUNT(*) n,
                      COUNT(*) FILTER (Return_Flag = 'Yes') b
               FROM t_order_items GROUP BY 1) i ON p.Product_ID = i.Product_ID
    LEFT JOIN (SELECT Product_ID, SUM(Review_Score) sc, COUNT(*) nr
               FROM t_reviews GROUP BY 1) r ON p.Product_ID = r.Product_ID"""

STATES = f"""
    SELECT State, COUNT(DISTINCT c.Customer_ID) AS Customers, COUNT(DISTINCT o.Order_ID) AS Orders,
           {dec('SUM(Sales)')} AS Total_Sales, {dec('SUM(Profit)')} AS Total_Profit
    FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID
    JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY State"""

SUMMARY = """
    SELECT Order_Item_ID, i.Order_ID, o.Customer_ID, Order_Date, Order_Status, Product_ID,
           Category, Sub_Category, Brand, Quantity, Unit_Price, Discount, Sales, Profit,
           Return_Flag, State, City, Customer_Segment, Customer_Age, Gender
    FROM t_order_items i JOIN t_orders o ON i.Order_ID = o.Order_ID
    JOIN t_customers c ON o.Customer_ID = c.Customer_ID"""

# The discount tiers of the reports.
TIER = """CASE WHEN Discount = 0 THEN 'No Discount' WHEN Discount <= 0.10 THEN 'Low (0-10%)'
          WHEN Discount <= 0.20 THEN 'Medium (10-20%)' ELSE 'High (20%+)' END"""

TEXTS = {
    "v1_order_summary": SUMMARY,
    "v2_customer_ltv": LTV,
    "v3_monthly_sales": MONTHS,
    "v4_product_performance": PRODUCTS_FANNED,
    "v4_product_performance_preagg": PRODUCTS_PLAIN,
    "v5_state_performance": STATES,
    "u1_table_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM t_{n}"
        for n in (
            "categories",
            "products",
            "customers",
            "orders",
            "order_items",
            "payments",
            "shipping",
            "reviews",
        )
    ),
    "u2_view_row_counts": f"""
        SELECT 'vw_order_summary' AS view_name, COUNT(*) AS row_count FROM ({SUMMARY})
        UNION ALL SELECT 'vw_customer_ltv', COUNT(*) FROM ({LTV})
        UNION ALL SELECT 'vw_monthly_sales', COUNT(*) FROM ({MONTHS})
        UNION ALL SELECT 'vw_product_performance', COUNT(*) FROM ({PRODUCTS_PLAIN})
        UNION ALL SELECT 'vw_state_performance', COUNT(*) FROM ({STATES})""",
    "q01_products_in_category": """
        SELECT Product_ID, Product_Name, Brand, Unit_Price FROM t_products
        WHERE Category = 'ECONOMY'""",
    "q02_orders_in_month": """
        SELECT Order_ID, Customer_ID, Order_Date, Total_Sales FROM t_orders
        WHERE Order_Date BETWEEN DATE '2000-07-01' AND DATE '2000-07-31'""",
    "q03_customers_in_state": """
        SELECT Customer_ID, First_Name, Last_Name, City, Customer_Segment FROM t_customers
        WHERE State = 'NATION_3'""",
    "q04_top_priced_products": """
        SELECT Product_ID, Product_Name, Category, Unit_Price FROM t_products
        ORDER BY Unit_Price DESC, Product_ID LIMIT 10""",
    "q05_cancelled_orders": """
        SELECT Order_ID, Customer_ID, Order_Date, Total_Sales FROM t_orders
        WHERE Order_Status = 'Cancelled'""",
    "q06_revenue_by_category": f"""
        SELECT Category, {dec('SUM(Sales)')} AS Total_Sales FROM t_order_items GROUP BY 1""",
    "q07_orders_by_segment": """
        SELECT Customer_Segment, COUNT(Order_ID) AS Order_Count
        FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID GROUP BY 1""",
    "q08_review_avg_by_product": f"""
        SELECT Product_ID, {quotient('SUM(Review_Score)', 'COUNT(Review_Score)', 2)} AS Avg_Score,
               COUNT(*) AS Review_Count FROM t_reviews GROUP BY 1""",
    "q09_revenue_by_state": f"SELECT State, Total_Sales FROM ({STATES})",
    "q10_orders_by_payment": """
        SELECT Payment_Method, COUNT(*) AS Order_Count FROM t_orders GROUP BY 1""",
    "q11_big_categories": f"""
        SELECT Category, {dec('SUM(Sales)')} AS Total_Sales FROM t_order_items GROUP BY 1
        HAVING SUM(Sales) > 175000000""",
    "q12_frequent_customers": """
        SELECT Customer_ID, COUNT(Order_ID) AS Order_Count FROM t_orders GROUP BY 1
        HAVING COUNT(Order_ID) > 5""",
    "q13_high_aov_states": f"""
        SELECT State, {quotient('SUM(Total_Sales)', 'COUNT(*)', 2)} AS Avg_Order_Value
        FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID GROUP BY 1
        HAVING SUM(Total_Sales)::DOUBLE / COUNT(*) > 72000""",
    "q14_discount_tier": f"""
        SELECT Order_Item_ID, Discount, {TIER} AS Discount_Tier FROM t_order_items""",
    "q15_value_tier": """
        SELECT Customer_ID, Customer_Lifetime_Value,
               CASE WHEN Customer_Lifetime_Value >= 1000000 THEN 'High Value'
                    WHEN Customer_Lifetime_Value >= 500000 THEN 'Medium Value'
                    ELSE 'Low Value' END AS Value_Tier FROM t_customers""",
    "q16_delivery_speed": """
        SELECT Order_ID, Delivery_Days,
               CASE WHEN Delivery_Days <= 3 THEN 'Fast' WHEN Delivery_Days <= 6 THEN 'Normal'
                    ELSE 'Slow' END AS Delivery_Speed
        FROM t_orders WHERE Delivery_Days IS NOT NULL""",
    "q17_order_line_detail": """
        SELECT Order_Item_ID, Order_Date, First_Name, Last_Name, State, Category, Sales
        FROM t_order_items i JOIN t_orders o ON i.Order_ID = o.Order_ID
        JOIN t_customers c ON o.Customer_ID = c.Customer_ID""",
    "q18_never_ordered_products": """
        SELECT p.Product_ID, Product_Name, p.Category
        FROM t_products p LEFT JOIN t_order_items i ON p.Product_ID = i.Product_ID
        WHERE i.Order_Item_ID IS NULL""",
    "q19_last_order_date": """
        SELECT c.Customer_ID, First_Name, Last_Name, MAX(Order_Date) AS Last_Order_Date
        FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID GROUP BY 1, 2, 3""",
    "q20_order_carrier": """
        SELECT o.Order_ID, Carrier, Shipping_Mode, s.Delivery_Days
        FROM t_orders o JOIN t_shipping s ON o.Order_ID = s.Order_ID""",
    "q21_order_360": """
        SELECT o.Order_ID, Order_Date, First_Name, Last_Name, State, Product_Name, Quantity,
               Sales, Profit
        FROM t_orders o JOIN t_customers c ON o.Customer_ID = c.Customer_ID
        JOIN t_order_items i ON o.Order_ID = i.Order_ID
        JOIN t_products p ON i.Product_ID = p.Product_ID""",
    "q22_above_avg_spenders": """
        SELECT Customer_ID, Total_Spend FROM t_customers WHERE Total_Spend::DOUBLE >
               (SELECT SUM(Total_Spend)::DOUBLE / COUNT(Total_Spend) FROM t_customers)""",
    "q23_above_category_price": """
        SELECT Product_ID, Product_Name, Category, Unit_Price FROM t_products p
        WHERE Unit_Price::DOUBLE > (SELECT SUM(Unit_Price)::DOUBLE / COUNT(*) FROM t_products x
                                    WHERE x.Category = p.Category)""",
    "q24_above_avg_orders": """
        SELECT Order_ID, Customer_ID, Total_Sales FROM t_orders WHERE Total_Sales::DOUBLE >
               (SELECT SUM(Total_Sales)::DOUBLE / COUNT(*) FROM t_orders)""",
    "q25_top_spender_per_state": """
        SELECT State, Customer_ID, Total_Spend FROM t_customers c
        WHERE Total_Spend = (SELECT MAX(Total_Spend) FROM t_customers x WHERE x.State = c.State)""",
    "q26_mom_growth": f"""
        SELECT Year_Month, Total_Sales, Prev_Month_Sales,
               {quotient('Total_Sales - Prev_Month_Sales', 'Prev_Month_Sales', 1, ' * 100')}
                   AS MoM_Growth_Pct
        FROM (SELECT Year_Month, Total_Sales,
                     LAG(Total_Sales) OVER (ORDER BY Year_Month) AS Prev_Month_Sales
              FROM ({MONTHS}))""",
    "q27_rfm_base": f"""
        SELECT o.Customer_ID,
               CAST(date_diff('day', MAX(Order_Date), (SELECT MAX(Order_Date) FROM t_orders))
                    AS INTEGER) AS Recency_Days,
               COUNT(DISTINCT o.Order_ID) AS Frequency, {dec('SUM(Sales)')} AS Monetary
        FROM t_orders o JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY 1""",
    "q28_category_profit_rank": f"""
        SELECT Category, {dec('SUM(Profit)')} AS Total_Profit,
               CAST(RANK() OVER (ORDER BY SUM(Profit) DESC) AS INTEGER) AS Profit_Rank
        FROM t_order_items GROUP BY 1""",
    "q29_spend_by_churn": f"""
        SELECT CASE WHEN Churned = 1 THEN 'Churned' ELSE 'Active' END AS Status,
               COUNT(*) AS Customer_Count, {quotient('SUM(s)', 'COUNT(*)', 2)} AS Avg_Spend
        FROM (SELECT c.Customer_ID, Churned, SUM(Sales) AS s
              FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID
              JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY 1, 2) GROUP BY Churned""",
    "q30_running_total": f"""
        SELECT Year_Month, Total_Sales AS Monthly_Sales,
               {dec('SUM(Total_Sales) OVER (ORDER BY Year_Month)')} AS Running_Total
        FROM ({MONTHS})""",
    "q31_rank_in_category": f"""
        SELECT Category, Product_ID, {dec('SUM(Sales)')} AS Product_Sales,
               RANK() OVER (PARTITION BY Category ORDER BY SUM(Sales) DESC) AS Rank_In_Category
        FROM t_order_items GROUP BY 1, 2""",
    "q32_order_sequence": """
        SELECT Customer_ID, Order_ID, Order_Date,
               ROW_NUMBER() OVER (PARTITION BY Customer_ID ORDER BY Order_Date, Order_ID)
                   AS Order_Sequence
        FROM t_orders""",
    "q33_moving_avg_3m": f"""
        SELECT Year_Month, Total_Sales,
               {half_up('''(SUM(Total_Sales) OVER w)::DOUBLE / (COUNT(*) OVER w)''', 2)}
                   AS Moving_Avg_3M
        FROM ({MONTHS})
        WINDOW w AS (ORDER BY Year_Month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "q34_top5_products_per_category": f"""
        SELECT * FROM (
            SELECT Category, Product_ID, {dec('SUM(Sales)')} AS Total_Sales,
                   CAST(DENSE_RANK() OVER (PARTITION BY Category ORDER BY SUM(Sales) DESC)
                        AS INTEGER) AS Rnk
            FROM t_order_items GROUP BY 1, 2) WHERE Rnk <= 5""",
    "q35_top3_customers_per_state": f"""
        SELECT * FROM (
            SELECT State, c.Customer_ID, {dec('SUM(Sales)')} AS Total_Spend,
                   CAST(RANK() OVER (PARTITION BY State ORDER BY SUM(Sales) DESC) AS INTEGER)
                       AS Rnk
            FROM t_customers c JOIN t_orders o ON c.Customer_ID = o.Customer_ID
            JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY 1, 2) WHERE Rnk <= 3""",
    "q36_spend_quartile": """
        SELECT Customer_ID, Total_Spend,
               CAST(NTILE(4) OVER (ORDER BY Total_Spend DESC, Customer_ID) AS INTEGER)
                   AS Spend_Quartile FROM t_customers""",
    "q37_customer_history": """
        SELECT o.Order_ID, Order_Date, Order_Status, Product_ID, Category, Quantity, Sales, Profit
        FROM t_orders o JOIN t_order_items i ON o.Order_ID = i.Order_ID
        WHERE o.Customer_ID = '1'""",
    "q38_top20_ltv": f"""
        SELECT Customer_ID, First_Name, Last_Name, State, Total_Sales, Total_Orders
        FROM ({LTV}) ORDER BY Total_Sales DESC NULLS LAST, Customer_ID LIMIT 20""",
    "q39_monthly_with_year": f"""
        SELECT Year_Month, Total_Sales, left(Year_Month, 4) AS Yr FROM ({MONTHS})""",
    "q40_headline_kpis": f"""
        SELECT {dec('SUM(Sales)')} AS Total_Revenue, {dec('SUM(Profit)')} AS Total_Profit,
               {quotient('SUM(Profit)', 'SUM(Sales)', 1, ' * 100')} AS Profit_Margin_Pct,
               COUNT(DISTINCT Order_ID) AS Total_Orders,
               (SELECT COUNT(*) FROM t_customers) AS Total_Customers,
               {quotient('SUM(Sales)', 'COUNT(DISTINCT Order_ID)', 2)} AS Avg_Order_Value
        FROM t_order_items""",
    "q41_return_rate": f"""
        SELECT Category, COUNT(*) AS Total_Items,
               COUNT(*) FILTER (Return_Flag = 'Yes') AS Returned_Items,
               {quotient("COUNT(*) FILTER (Return_Flag = 'Yes')", 'COUNT(*)', 1, ' * 100')}
                   AS Return_Rate_Pct FROM t_order_items GROUP BY 1""",
    "q42_churn_rate_by_segment": f"""
        SELECT Customer_Segment, COUNT(*) AS Total_Customers,
               SUM(Churned)::BIGINT AS Churned_Customers,
               {quotient('SUM(Churned)', 'COUNT(*)', 1, ' * 100')} AS Churn_Rate_Pct
        FROM t_customers GROUP BY 1""",
}
