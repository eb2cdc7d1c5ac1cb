"""DuckDB texts for sources, quality, features, exploration, segments, metrics and figures."""

from oracles.business import TIER, dec, half_up, quotient
from oracles.business import TEXTS as BUSINESS
from oracles.facts import (
    COLUMNS,
    EXPECTED_ROWS,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    REQUIRED,
    TEXT_LENGTHS,
)

ITEM_COLUMNS = ", ".join(COLUMNS["order_items"])
ORDER_COLUMNS = ", ".join(COLUMNS["orders"])

# -- sources and quality ---------------------------------------------------------------------


def union(parts):
    return " UNION ALL ".join(parts)


def duplicates(table, key, name):
    return f"""SELECT '{name}' AS table_name, '{key}' AS key_columns, COUNT(*) AS row_count,
               COUNT(*) - COUNT(DISTINCT ({key})) AS duplicate_rows FROM {table}"""


def foreign_keys(rename=None):
    rename = rename or {}
    return union(
        f"""SELECT '{c}' AS child_table, '{p}' AS parent_table, '{k}' AS key_column,
            COUNT(*) AS orphan_rows, COUNT(DISTINCT {k}) AS orphan_keys
            FROM {rename.get(c, 't_' + c)} x
            WHERE {k} IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM {rename.get(p, 't_' + p)} y WHERE y.{k} = x.{k})"""
        for c, p, k in FOREIGN_KEYS
    )


FLAT_COLUMNS = [
    *COLUMNS["order_items"],
    *[c for c in COLUMNS["orders"] if c != "Order_ID"],
    *[c for c in COLUMNS["customers"] if c != "Customer_ID"],
    "Shipping_Mode",
    "Carrier",
    "Review_Score",
]
PREPARED = """SELECT *, Ship_Date IS NOT NULL AS Was_Shipped,
              Review_Score IS NOT NULL AS Has_Review FROM t_flat"""


def null_counts(columns, source):
    return union(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_count FROM {source}"
        for c in columns
    )


NULLS = f"""SELECT * FROM ({null_counts(FLAT_COLUMNS, 't_flat')}) WHERE null_count > 0"""

FENCES = union(
    f"""SELECT '{c}' AS column_name, q[1] - 1.5 * (q[2] - q[1]) AS lo,
        q[2] + 1.5 * (q[2] - q[1]) AS hi
        FROM (SELECT quantile_cont({c}::DOUBLE, [0.25, 0.75]) AS q FROM t_order_items)"""
    for c in ("Sales", "Profit", "Unit_Price")
)


def outside(column):
    return f"""COALESCE({column}::DOUBLE < (SELECT lo FROM fences WHERE column_name = '{column}')
               OR {column}::DOUBLE > (SELECT hi FROM fences WHERE column_name = '{column}'),
               FALSE)"""


OUTLIERS = f"""
    SELECT Order_Item_ID, Sales, Profit, Unit_Price, {outside('Sales')} AS Sales_Outlier,
           {outside('Profit')} AS Profit_Outlier, {outside('Unit_Price')} AS Unit_Price_Outlier
    FROM t_order_items"""

CLEANED = f"""
    SELECT *, {outside('Sales')} AS Sales_Outlier, {outside('Profit')} AS Profit_Outlier,
           {outside('Unit_Price')} AS Unit_Price_Outlier FROM ({PREPARED})"""

QUALITY = {
    "s01_table_shapes": union(
        f"""SELECT '{n}' AS table_name, COUNT(*) AS row_count, {len(names)} AS column_count
            FROM t_{n}"""
        for n, names in COLUMNS.items()
    ),
    "s01_csv_round_trip": f"SELECT {ITEM_COLUMNS} FROM t_order_items",
    "s02_csv_by_header": f"""
        SELECT {ITEM_COLUMNS} FROM (
            SELECT * REPLACE (0::DECIMAL(4,2) AS Discount, 'No' AS Return_Flag)
            FROM t_order_items)""",
    "s04_csv_line_breaks": """
        SELECT Review_ID, Order_Item_ID, Product_ID, Review_Score,
               'say "' || Review_Text || '",' || chr(10) || 'then more' AS Review_Text, Review_Date
        FROM t_reviews""",
    "s07_parquet_round_trip": f"SELECT {ORDER_COLUMNS} FROM t_orders",
    "s10_view_by_name": BUSINESS["v5_state_performance"],
    "s11_row_count_check": union(
        f"""SELECT '{n}' AS table_name, COUNT(*) AS actual_rows, {e}::BIGINT AS expected_rows,
            COUNT(*) = {e} AS as_expected FROM t_{n}"""
        for n, e in EXPECTED_ROWS.items()
    ),
    "s03_orders_from_text": """
        SELECT Order_ID, Customer_ID,
               CASE WHEN o_orderkey % 7 IN (0, 1, 2) THEN NULL ELSE Order_Date END AS Order_Date,
               Ship_Date, Order_Status, Delivery_Days,
               CAST(Total_Sales AS DECIMAL(12,2)) AS Total_Sales,
               CAST(Total_Profit AS DECIMAL(12,2)) AS Total_Profit, Item_Count, Payment_Method
        FROM t_orders""",
    "d01_duplicate_report": union(
        [duplicates("lineitem", "l_orderkey,l_linenumber", "raw_lines")]
        + [
            duplicates(f"t_{n}", PRIMARY_KEYS[n], n)
            for n in ("customers", "products", "orders", "order_items")
        ]
    ),
    "d01_first_per_key": """
        SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem) WHERE rn = 1""",
    "d04_items_from_text": """
        SELECT Order_Item_ID, Order_ID, Product_ID, Category, Sub_Category, Brand, Quantity,
               CASE WHEN Quantity % 5 = 0 THEN NULL ELSE Unit_Price END AS Unit_Price, Discount,
               Sales, Shipping_Cost, Profit, 'No' AS Return_Flag FROM t_order_items""",
    "d05_coerced_and_trimmed": """
        SELECT Order_Item_ID, CASE WHEN Quantity % 5 <> 0 THEN Quantity END AS Quantity, Brand
        FROM t_order_items""",
    "d06_null_report": NULLS,
    "d08_unexpected_nulls": f"""
        SELECT * FROM ({NULLS}) WHERE column_name NOT IN
        ('Ship_Date', 'Shipping_Mode', 'Carrier', 'Delivery_Days', 'Review_Score')""",
    "d09_outlier_flags": f"WITH fences AS ({FENCES}) {OUTLIERS}",
    "d10_outlier_report": f"WITH fences AS ({FENCES}) "
    + union(
        f"""SELECT '{c}' AS column_name, COUNT(*) FILTER ({c}_Outlier) AS outliers,
            round((COUNT(*) FILTER ({c}_Outlier))::DOUBLE / COUNT(*), 6) AS outlier_share
            FROM ({OUTLIERS})"""
        for c in ("Sales", "Profit", "Unit_Price")
    ),
    "d11_integrity": """
        SELECT 'Sales >= 0' AS rule, COUNT(*) FILTER (Sales < 0 OR Sales IS NULL) AS violations
        FROM t_flat
        UNION ALL SELECT 'Quantity > 0', COUNT(*) FILTER (Quantity <= 0 OR Quantity IS NULL)
        FROM t_flat
        UNION ALL SELECT 'Order_ID present', COUNT(*) FILTER (Order_ID IS NULL) FROM t_flat
        UNION ALL SELECT 'Customer_ID present', COUNT(*) FILTER (Customer_ID IS NULL)
        FROM t_flat""",
    "d12_primary_keys": union(
        f"""SELECT '{n}' AS table_name, '{k}' AS key_column,
            (SELECT COUNT(*) FROM (SELECT {k} FROM t_{n} WHERE {k} IS NOT NULL GROUP BY 1
                                   HAVING COUNT(*) > 1)) AS duplicate_keys,
            (SELECT COUNT(*) FROM t_{n} WHERE {k} IS NULL) AS null_keys"""
        for n, k in PRIMARY_KEYS.items()
    ),
    "d13_foreign_keys": foreign_keys(),
    "d13_foreign_keys_dirty": foreign_keys({"order_items": "t_dirty_items"}),
    "d14_scores_outside_2_to_4": """
        SELECT Review_ID, Order_Item_ID, Product_ID, Review_Score, Review_Text, Review_Date
        FROM t_reviews WHERE Review_Score < 2 OR Review_Score > 4""",
    "d15_required_columns": union(
        f"""SELECT '{n}' AS table_name, '{c}' AS column_name,
            COUNT(*) FILTER ({c} IS NULL) AS null_count FROM t_{n}"""
        for n, names in REQUIRED.items()
        for c in names
    ),
    "d15_text_lengths": union(
        f"""SELECT '{n}' AS table_name, '{c}' AS column_name,
            COUNT(*) FILTER (length({c}) > {size}) AS too_long
            FROM t_{n}"""
        for n, sizes in TEXT_LENGTHS.items()
        for c, size in sizes.items()
    ),
    "d17_formula_check": """
        SELECT * FROM (
            SELECT Order_Item_ID, Sales,
                   CAST(Quantity * Unit_Price * (1 - Discount) AS DECIMAL(18,4)) AS Expected_Sales,
                   CAST(Sales - Quantity * Unit_Price * (1 - Discount) AS DECIMAL(18,4))
                       AS Difference
            FROM t_order_items) WHERE abs(Difference) > 0.004""",
    "j05_flat_table": "SELECT * FROM t_flat",
    "c01_cleaned": f"WITH fences AS ({FENCES}) {CLEANED}",
}

# -- features --------------------------------------------------------------------------------

DATE_FEATURES = """CAST(year(Order_Date) AS INTEGER) AS Order_Year,
    CAST(month(Order_Date) AS INTEGER) AS Order_Month,
    CAST(quarter(Order_Date) AS INTEGER) AS Order_Quarter, dayname(Order_Date) AS Order_Weekday,
    isodow(Order_Date) >= 6 AS Is_Weekend_Order, strftime(Order_Date, '%Y-%m') AS Order_YearMonth,
    CAST(date_diff('day', Order_Date, Ship_Date) AS INTEGER) AS Days_To_Ship"""

FINANCIAL = """CASE WHEN Sales > 0 THEN (Profit * 100)::DOUBLE / Sales::DOUBLE ELSE 0 END
        AS Profit_Margin_Pct,
    Sales::DOUBLE / nullif(Quantity, 0)::DOUBLE AS Avg_Item_Value,
    CASE WHEN Discount > -0.01 AND Discount <= 0 THEN 'No Discount'
         WHEN Discount > 0 AND Discount <= 0.10 THEN 'Low (0-10%)'
         WHEN Discount > 0.10 AND Discount <= 0.20 THEN 'Medium (10-20%)'
         WHEN Discount > 0.20 AND Discount <= 1.0 THEN 'High (20%+)' END AS Discount_Bucket,
    Sales::DOUBLE >= (SELECT quantile_cont(Sales::DOUBLE, 0.75) FROM t_order_items)
        AS Is_High_Value_Order"""

TENURE = """CAST(date_diff('day', Customer_Since, (SELECT MAX(Order_Date) FROM t_flat))
        AS INTEGER) AS Customer_Tenure_Days,
    CASE WHEN Total_Orders > 0 THEN Total_Spend::DOUBLE / Total_Orders::DOUBLE ELSE 0 END
        AS Avg_Spend_Per_Order"""

# The columns that get label codes.
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


def code(column, suffix, missing):
    text = f"COALESCE({column}::VARCHAR, '{missing}')"
    return f"CAST(DENSE_RANK() OVER (ORDER BY {text}) - 1 AS INTEGER) AS {column}{suffix}"


CODES = ",\n".join(code(c, "_Encoded", "Not_Shipped") for c in ENCODED)

FEATURES = {
    "e01_date_features": f"""
        SELECT Order_Item_ID, Order_Date, Ship_Date, {DATE_FEATURES} FROM t_flat""",
    "e02_financial_features": f"""
        SELECT Order_Item_ID, Sales, Profit, Quantity, Discount, {FINANCIAL}
        FROM t_order_items""",
    "e06_tenure_features": f"""
        SELECT Order_Item_ID, Order_Date, Customer_Since, Total_Spend, Total_Orders, {TENURE}
        FROM t_flat""",
    "e08_label_codes": f"SELECT Order_Item_ID, {CODES} FROM t_flat",
    "e09_engineered": f"""WITH fences AS ({FENCES})
        SELECT *, {DATE_FEATURES}, {FINANCIAL}, {TENURE}, {CODES} FROM ({CLEANED})""",
}

# -- exploration -----------------------------------------------------------------------------

# The columns of the numeric summary and of the correlation matrix.
NUMERIC = (
    "Quantity",
    "Unit_Price",
    "Discount",
    "Sales",
    "Profit",
    "Shipping_Cost",
    "Customer_Age",
)
CORRELATED = (
    "Quantity",
    "Unit_Price",
    "Discount",
    "Sales",
    "Shipping_Cost",
    "Profit",
    "Customer_Age",
    "Customer_Lifetime_Value",
    "Total_Orders",
    "Recency_Days",
)


def described(c):
    x = f"{c}::DOUBLE"
    cells = [
        f"{half_up(expr, 2)} AS {name}"
        for expr, name in (
            (f"(SUM({c})::DOUBLE / COUNT({c}))", "mean"),
            (f"stddev_samp({x})", "std"),
            (f"MIN({x})", "min"),
            (f"quantile_cont({x}, 0.25)", "p25"),
            (f"quantile_cont({x}, 0.5)", "p50"),
            (f"quantile_cont({x}, 0.75)", "p75"),
            (f"MAX({x})", "max"),
        )
    ]
    return f"SELECT '{c}' AS column_name, COUNT({c}) AS count, {', '.join(cells)} FROM t_flat"


def ranked_sum(key, value, out):
    return f"SELECT {key}, {dec(f'SUM({value})')} AS {out} FROM t_flat GROUP BY 1"


AGES = """SELECT Customer_Age::DOUBLE AS age FROM t_customers
          WHERE Customer_ID IN (SELECT Customer_ID FROM t_flat)"""
STATS = """SELECT MIN(age) AS lo, MAX(age) AS hi, COUNT(*) AS n,
           stddev_samp(age) * pow(COUNT(*), -0.2) AS h FROM ages"""


def best(key, value, direction="DESC", label=None):
    label = label or key
    return f"""(SELECT {label} || ' ($' || format('{{:,}}', CAST(round(s) AS BIGINT)) || ')'
                FROM (SELECT {key}, SUM({value}) AS s FROM t_flat GROUP BY 1)
                ORDER BY s {direction}, {key} LIMIT 1)"""


EXPLORATION = {
    "x01_numeric_summary": union(described(c) for c in NUMERIC),
    "x01_value_counts": union(
        f"""SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS row_count FROM t_flat
            WHERE {c} IS NOT NULL GROUP BY 2"""
        for c in ("Category", "Order_Status", "Payment_Method", "Customer_Segment")
    ),
    "x02_correlation_matrix": union(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
            round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS correlation FROM t_flat"""
        for a in CORRELATED
        for b in CORRELATED
    ),
    "x03_monthly_trend": f"""
        WITH months AS (
            SELECT last_day(m::DATE) AS Month_End
            FROM (SELECT unnest(generate_series(date_trunc('month', MIN(Order_Date)),
                                                date_trunc('month', MAX(Order_Date)),
                                                INTERVAL 1 MONTH)) AS m FROM t_flat))
        SELECT Month_End, {dec('COALESCE(SUM(Sales), 0)')} AS Sales,
               {dec('COALESCE(SUM(Profit), 0)')} AS Profit
        FROM months LEFT JOIN t_flat ON last_day(Order_Date) = Month_End GROUP BY 1""",
    "x04_top_products": f"""
        SELECT * FROM ({ranked_sum('Product_ID', 'Sales', 'Total_Sales')})
        ORDER BY Total_Sales DESC, Product_ID LIMIT 10""",
    "x05_profit_by_category": ranked_sum("Category", "Profit", "Total_Profit"),
    "x06_sales_by_state": ranked_sum("State", "Sales", "Total_Sales"),
    "x07_age_histogram": f"""
        WITH ages AS ({AGES}), stats AS ({STATS}),
        bins AS (SELECT i, lo + (i - 1) * (hi - lo) / 25 AS f, lo + i * (hi - lo) / 25 AS t
                 FROM stats, generate_series(1, 25) AS g(i)),
        placed AS (SELECT least(CAST(floor((age - lo) / (hi - lo) * 25) AS BIGINT) + 1, 25) AS b
                   FROM ages, stats)
        SELECT CAST(i AS INTEGER) AS Bin, round(f, 6) AS From_Age, round(t, 6) AS To_Age,
               COUNT(b) AS Customers FROM bins LEFT JOIN placed ON b = i GROUP BY 1, 2, 3""",
    "x07_age_density": f"""
        WITH ages AS ({AGES}), stats AS ({STATS}),
        weights AS (SELECT age, COUNT(*) AS w FROM ages GROUP BY 1),
        grid AS (SELECT i, lo + i * ((hi - lo) / 199) AS x, n, h
                 FROM stats, generate_series(0, 199) AS g(i))
        SELECT CAST(i AS INTEGER) AS Point, round(x, 6) AS Age,
               round(SUM(w * exp(-0.5 * pow((x - age) / h, 2))) / (n * h * sqrt(2 * pi())), 9)
                   AS Density
        FROM grid, weights GROUP BY i, x, n, h""",
    "x08_discount_profit_sample": """
        SELECT Order_Item_ID, Discount, Profit, Category FROM t_flat
        ORDER BY md5(Order_Item_ID || '#42'), Order_Item_ID LIMIT 4000""",
    "x09_order_status": f"""
        SELECT Order_Status, COUNT(*) AS Order_Count,
               {quotient('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 1, ' * 100')} AS Share_Pct
        FROM t_orders WHERE Order_ID IN (SELECT Order_ID FROM t_flat) GROUP BY 1""",
    "x10_insights": f"""
        SELECT 1 AS position, 'Best-selling category (revenue)' AS metric,
               {best('Category', 'Sales')} AS value
        UNION ALL SELECT 2, 'Lowest-selling category (revenue)', {best('Category', 'Sales', 'ASC')}
        UNION ALL SELECT 3, 'Most profitable category', {best('Category', 'Profit')}
        UNION ALL SELECT 4, 'Top state by sales', {best('State', 'Sales')}
        UNION ALL SELECT 5, 'Strongest sales month', {best(
            "date_trunc('month', Order_Date)", 'Sales',
            label="strftime(date_trunc('month', Order_Date), '%B %Y')").replace(
            "SELECT date_trunc('month', Order_Date), SUM",
            "SELECT date_trunc('month', Order_Date) AS Order_Date, SUM")}
        UNION ALL SELECT 6, 'Overall return rate',
               (SELECT printf('%.1f%%', COUNT(*) FILTER (Return_Flag = 'Yes') * 100.0 / COUNT(*))
                FROM t_flat)
        UNION ALL SELECT 7, 'Correlation between Discount % and Profit',
               (SELECT printf('%.2f (%s)', corr(Discount::DOUBLE, Profit::DOUBLE),
                              CASE WHEN corr(Discount::DOUBLE, Profit::DOUBLE) < 0
                                   THEN 'negative -> higher discounts erode profit'
                                   ELSE 'positive' END) FROM t_flat)""",
}

# -- segments --------------------------------------------------------------------------------

RFM = f"""SELECT Customer_ID, Recency, Frequency, {dec('Monetary')} AS Monetary, Customer_Segment,
          Customer_Age, Gender, State, Income_Group, Customer_Lifetime_Value, Churned"""

SEGMENTS = {
    "r01_rfm_table": f"{RFM} FROM t_rfm",
    "r02_scored_segments": f"""{RFM}, R_Score, F_Score, M_Score, RFM_Score, RFM_Total, RFM_Segment
        FROM t_segments""",
    "r07_segment_distribution": f"""
        SELECT RFM_Segment, COUNT(*) AS Customers,
               {quotient('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 1, ' * 100')} AS Share_Pct
        FROM t_segments GROUP BY 1""",
    "r08_standardised": f"""
        SELECT Customer_ID, Recency, Frequency, {dec('Monetary')} AS Monetary,
               {', '.join(f'''round(({c}::DOUBLE - (SELECT avg({c}::DOUBLE) FROM t_rfm))
                   / (SELECT stddev_pop({c}::DOUBLE) FROM t_rfm), 9) AS {c}_Z'''
                          for c in ('Recency', 'Frequency', 'Monetary'))}
        FROM t_rfm""",
    "r09_elbow_check": "SELECT 7::BIGINT AS cluster_counts, TRUE AS falls",
    "r10_clusters_check": """
        SELECT COUNT(*) AS customers, COUNT(DISTINCT Customer_ID) AS different_customers,
               4::BIGINT AS clusters, 0::BIGINT AS out_of_order FROM t_rfm""",
}

# -- prediction ------------------------------------------------------------------------------

CHURN_CODES = ",\n".join(
    code(c, "_Enc", "nan") for c in ("Customer_Segment", "Gender", "State", "Income_Group")
)
SALES_CODES = ",\n".join(
    code(c, "_Enc", "nan")
    for c in ("Category", "Sub_Category", "Payment_Method", "Customer_Segment", "State")
)

SCORED = """
    SELECT label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction
    FROM (SELECT Churned AS label, ((Customer_Age * 37 + Total_Orders * 11) % 100) / 100.0::DOUBLE
                 AS score FROM t_customers)"""
CELLS = f"""
    SELECT COUNT(*) FILTER (label = 1 AND prediction = 1) AS tp,
           COUNT(*) FILTER (label = 0 AND prediction = 1) AS fp,
           COUNT(*) FILTER (label = 0 AND prediction = 0) AS tn,
           COUNT(*) FILTER (label = 1 AND prediction = 0) AS fn FROM ({SCORED})"""
AUC = f"""
    SELECT (SUM(CASE WHEN label = 1 THEN mean_rank END)
            - COUNT(*) FILTER (label = 1) * (COUNT(*) FILTER (label = 1) + 1) / 2.0::DOUBLE)
           / (COUNT(*) FILTER (label = 1)::DOUBLE * COUNT(*) FILTER (label = 0)) AS roc_auc
    FROM (SELECT label, RANK() OVER (ORDER BY score)
                 + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mean_rank
          FROM ({SCORED}))"""
P1, R1 = "tp::DOUBLE / nullif(tp + fp, 0)", "tp::DOUBLE / nullif(tp + fn, 0)"
F1 = "2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0)"
P0, R0 = "tn::DOUBLE / nullif(tn + fn, 0)", "tn::DOUBLE / nullif(tn + fp, 0)"
F0 = "2.0::DOUBLE * tn / nullif(2 * tn + fp + fn, 0)"
ACC = "(tp + tn)::DOUBLE / (tp + fp + tn + fn)"


def report_row(name, cells, support):
    p, r, f = (f"round(COALESCE({c}, 0), 9)" for c in cells)
    return f"""SELECT '{name}' AS class, {p} AS precision, {r} AS recall, {f} AS f1,
               {support} AS support FROM cells"""


def weighted(a, b):
    return f"(COALESCE({a}, 0) * (tn + fp) + COALESCE({b}, 0) * (tp + fn)) / (tp + fp + tn + fn)"


def macro(a, b):
    return f"(COALESCE({a}, 0) + COALESCE({b}, 0)) / 2"


PREDICTION = {
    "m01_churn_features": f"""
        SELECT Customer_ID, Frequency, Monetary::DOUBLE AS Monetary, F_Score, M_Score,
               Customer_Age, Customer_Lifetime_Value::DOUBLE AS Customer_Lifetime_Value,
               {CHURN_CODES}, Churned,
               row_number() OVER (PARTITION BY Churned
                                  ORDER BY md5(Customer_ID || '#42'), Customer_ID)
                   <= round_even(0.2 * COUNT(*) OVER (PARTITION BY Churned), 0) AS is_test
        FROM t_segments""",
    "m02_sales_features": f"""
        SELECT Order_Item_ID, Quantity, Unit_Price::DOUBLE AS Unit_Price,
               Discount::DOUBLE AS Discount, {SALES_CODES}, Customer_Age,
               CAST(month(Order_Date) AS INTEGER) AS Order_Month,
               CASE WHEN isodow(Order_Date) >= 6 THEN 1 ELSE 0 END AS Is_Weekend_Order,
               Sales::DOUBLE AS Sales,
               ('0x' || left(md5(Order_Item_ID || '#42'), 8))::BIGINT < 858993459 AS is_test
        FROM t_flat""",
    "m10_classification_metrics": f"""
        SELECT round({ACC}, 9) AS accuracy, round(COALESCE({P1}, 0), 9) AS precision,
               round(COALESCE({R1}, 0), 9) AS recall, round(COALESCE({F1}, 0), 9) AS f1,
               round((SELECT roc_auc FROM ({AUC})), 9) AS roc_auc FROM ({CELLS})""",
    "m11_roc_auc": f"SELECT round(roc_auc, 9) AS roc_auc FROM ({AUC})",
    "m12_classification_report": f"WITH cells AS ({CELLS}) "
    + union(
        [
            report_row("0", (P0, R0, F0), "tn + fp"),
            report_row("1", (P1, R1, F1), "tp + fn"),
            report_row("accuracy", (ACC, ACC, ACC), "tp + fp + tn + fn"),
            report_row(
                "macro avg", (macro(P0, P1), macro(R0, R1), macro(F0, F1)), "tp + fp + tn + fn"
            ),
            report_row(
                "weighted avg",
                (weighted(P0, P1), weighted(R0, R1), weighted(F0, F1)),
                "tp + fp + tn + fn",
            ),
        ]
    ),
    "m13_confusion_matrix": f"""
        SELECT a.x AS actual, p.x AS predicted, COUNT(label) AS row_count
        FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
        LEFT JOIN ({SCORED}) s ON s.label = a.x AND s.prediction = p.x GROUP BY 1, 2""",
    "m14_roc_points": f"""
        SELECT 'infinity'::DOUBLE AS threshold, 0::BIGINT AS tp, 0::BIGINT AS fp, 0::DOUBLE AS fpr,
               0::DOUBLE AS tpr
        UNION ALL
        SELECT DISTINCT round(score, 9) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp,
               round(fp::DOUBLE / (SELECT COUNT(*) FROM ({SCORED}) WHERE label = 0), 9) AS fpr,
               round(tp::DOUBLE / (SELECT COUNT(*) FROM ({SCORED}) WHERE label = 1), 9) AS tpr
        FROM (SELECT score, SUM(label) OVER (ORDER BY score DESC) AS tp,
                     SUM(1 - label) OVER (ORDER BY score DESC) AS fp FROM ({SCORED}))""",
    "m18_risk_tiers": """
        SELECT Customer_ID, score,
               CASE WHEN score <= 0.33 THEN 'Low Risk' WHEN score <= 0.66 THEN 'Medium Risk'
                    ELSE 'High Risk' END AS Churn_Risk_Tier
        FROM (SELECT Customer_ID, ((Customer_Age * 37 + Total_Orders * 11) % 100) / 100.0::DOUBLE
                     AS score FROM t_customers)""",
    "m19_high_risk_count": f"""
        SELECT COUNT(*) AS high_risk_customers FROM ({SCORED}) WHERE score > 0.66""",
    "m20_churn_rate": "SELECT round(avg(Churned::DOUBLE), 9) AS churn_rate FROM t_rfm",
    "m24_regression_metrics": """
        SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse,
               round(1 - avg(pow(y - p, 2)) / var_pop(y), 6) AS r2
        FROM (SELECT Sales::DOUBLE AS y, (Quantity * Unit_Price)::DOUBLE AS p
              FROM t_order_items)""",
    "s09_round_trip_check": "SELECT COUNT(*) AS customers, 0::BIGINT AS different FROM t_segments",
    "m15_churn_check": """
        SELECT 10::BIGINT AS features, 10::BIGINT AS different_features, 0::BIGINT AS negative,
               1.0::DOUBLE AS total""",
    "m15_sales_check": """
        SELECT 11::BIGINT AS features, 11::BIGINT AS different_features, 0::BIGINT AS negative,
               1.0::DOUBLE AS total""",
    "m25_test_pairs_check": """
        SELECT 0::BIGINT AS repeated, 0::BIGINT AS wrong, TRUE AS about_a_fifth""",
    "m16_churn_check": """
        SELECT 'Gradient Boosting, Logistic Regression, Random Forest' AS models,
               TRUE AS best_is_chosen, TRUE AS within_range, TRUE AS follows_from_predictions""",
    "m16_sales_check": """
        SELECT 'Gradient Boosting, Linear Regression, Random Forest' AS models,
               TRUE AS best_is_chosen, TRUE AS within_range, TRUE AS follows_from_predictions,
               TRUE AS trees_beat_line""",
    "m17_churn_check": """
        SELECT COUNT(*) AS customers, COUNT(DISTINCT Customer_ID) AS different_customers,
               0::BIGINT AS outside_0_to_1, 0::BIGINT AS wrong_tier, 0::BIGINT AS wrong_class
        FROM t_segments""",
    "m26_sales_check": """
        SELECT COUNT(*) AS lines, COUNT(DISTINCT Order_Item_ID) AS different_lines,
               round(SUM(Sales)::DOUBLE, 0) AS sales, 0::BIGINT AS wrong_error FROM t_flat""",
    "m28_churn_label": """
        SELECT Customer_ID, Recency, CASE WHEN Recency > 180 THEN 1 ELSE 0 END AS Churned
        FROM t_rfm""",
}

# -- figures ---------------------------------------------------------------------------------

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

KPIS = {
    "k01_repeat_buyer_rate": f"""
        SELECT COUNT(*) AS Buyers, COUNT(*) FILTER (n >= 2) AS Repeat_Buyers,
               {quotient('COUNT(*) FILTER (n >= 2)', 'COUNT(*)', 1, ' * 100')}
                   AS Repeat_Buyer_Pct
        FROM (SELECT Customer_ID, COUNT(*) AS n FROM t_orders GROUP BY 1)""",
    "k02_margin_by_discount_tier": f"""
        SELECT {TIER} AS Discount_Tier, {dec('SUM(Sales)')} AS Total_Sales,
               {dec('SUM(Profit)')} AS Total_Profit,
               {quotient('SUM(Profit)', 'SUM(Sales)', 1, ' * 100')} AS Profit_Margin_Pct
        FROM t_order_items GROUP BY 1""",
    "k03_slow_shipment_share": f"""
        SELECT COUNT(*) AS Shipments, COUNT(*) FILTER (Delivery_Days > 7) AS Slow_Shipments,
               {quotient('COUNT(*) FILTER (Delivery_Days > 7)', 'COUNT(*)', 1, ' * 100')}
                   AS Slow_Shipment_Pct FROM t_shipping""",
    "k04_high_risk_check": "SELECT TRUE AS agrees",
    "k05_pivot_category_month": f"""
        SELECT strftime(Order_Date, '%Y-%m') AS Year_Month,
               {', '.join(f'''{dec(f"SUM(Sales) FILTER (Category = '{c}')")} AS {c}'''
                          for c in CATEGORIES)}
        FROM t_orders o JOIN t_order_items i ON o.Order_ID = i.Order_ID GROUP BY 1""",
    "k06_cleaning_log": f"""WITH fences AS ({FENCES})
        SELECT 'duplicates' AS step, table_name || '.' || key_columns AS subject,
               duplicate_rows AS affected_rows
        FROM ({union(duplicates(f't_{n}', PRIMARY_KEYS[n], n)
                     for n in ('customers', 'products', 'orders', 'order_items'))})
        UNION ALL SELECT 'nulls', column_name, null_count FROM ({NULLS})
        UNION ALL SELECT 'outliers', 'Sales', COUNT(*) FILTER (Sales_Outlier) FROM ({OUTLIERS})
        UNION ALL SELECT 'outliers', 'Profit', COUNT(*) FILTER (Profit_Outlier) FROM ({OUTLIERS})
        UNION ALL SELECT 'outliers', 'Unit_Price', COUNT(*) FILTER (Unit_Price_Outlier)
        FROM ({OUTLIERS})""",
    "k07_customer_lookup": "SELECT * FROM t_customers WHERE Customer_ID = '1'",
    "k07_product_lookup_many": """
        SELECT * FROM t_products WHERE Product_ID IN
               (SELECT Product_ID FROM t_order_items WHERE Return_Flag = 'Yes')""",
}

MORE = {
    "s11_stored_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "s08_report_lines": f"SELECT metric || ': ' || value AS value FROM ({EXPLORATION['x10_insights']})",
    "s10_view_reopened": QUALITY["s10_view_by_name"],
    "d09_sketch_check": " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, {p}::DOUBLE AS probability, COUNT({column}) AS n, TRUE AS rank_is_right FROM t_order_items"
        for column in ("Sales", "Profit", "Unit_Price") for p in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
    "r11_profile_check": """
        SELECT 4::BIGINT AS clusters, COUNT(*) AS customers, round(avg(Frequency), 0) AS mean_frequency FROM t_rfm""",
}

TEXTS = {**MORE, **QUALITY, **FEATURES, **EXPLORATION, **SEGMENTS, **PREDICTION, **KPIS}
