"""Hand-made cases for the views and business questions."""

import datetime
from decimal import Decimal as D

import pytest

from tests.conftest import rows_of
from tillroll.plans import business as b
from tillroll.plans import eda, kpis
from tillroll.plans import views as v

DAY = datetime.date


def sale(order, product, amount, **more):
    return {
        "Order_Item_ID": f"{order}-{product}",
        "Order_ID": order,
        "Product_ID": product,
        "Category": "A",
        "Sales": amount,
        "Profit": "1.00",
        "Return_Flag": "No",
        **more,
    }


def test_fan_out_multiplies_sums_but_not_shares(tables):
    t = tables(
        products=[{"Product_ID": p, "Category": "A"} for p in ("p", "q", "none")],
        order_items=[
            sale("1", "p", "10.00", Quantity=2, Return_Flag="Yes"),
            sale("2", "p", "20.00", Quantity=3),
            sale("3", "q", "5.00", Quantity=1),
        ],
        reviews=[
            {"Review_ID": str(i), "Product_ID": "p", "Review_Score": s}
            for i, s in enumerate((1, 3, 5))
        ],
    )
    columns = ("Product_ID", "Units_Sold", "Total_Sales", "Return_Rate_Pct", "Avg_Review_Score")

    def found(**options):
        df = v.product_performance(t, **options).select(*columns)
        return {r["Product_ID"]: tuple(r)[1:] for r in df.collect()}

    assert found() == {
        "p": (15, D("90.00"), 50.0, 3.0),
        "q": (1, D("5.00"), 0.0, None),
        "none": (0, D("0.00"), None, None),
    }
    assert found(fan_out=False) == {
        "p": (5, D("30.00"), 50.0, 3.0),
        "q": (1, D("5.00"), 0.0, None),
        "none": (0, D("0.00"), None, None),
    }


def test_customer_without_orders_keeps_null_sums(tables):
    t = tables(
        customers=[{"Customer_ID": "a"}, {"Customer_ID": "b"}, {"Customer_ID": "c"}],
        orders=[{"Order_ID": "1", "Customer_ID": "a"}, {"Order_ID": "2", "Customer_ID": "b"}],
        order_items=[sale("1", "p", "10.00"), sale("1", "q", "5.00")],
    )
    columns = ("Customer_ID", "Total_Orders", "Total_Sales", "Avg_Order_Value")
    found = {r[0]: tuple(r)[1:] for r in v.customer_ltv(t).select(*columns).collect()}
    assert found == {
        "a": (1, D("15.00"), 15.0),
        "b": (1, None, None),  # an order without lines counts, its sums are missing
        "c": (0, None, None),
    }
    # rfm_base leaves out customers whose orders have no lines
    assert rows_of(b.rfm_base(t), "Customer_ID") == [("a",)]


def month_tables(tables, months):
    orders = [
        {"Order_ID": str(i), "Customer_ID": "c", "Order_Date": day}
        for i, (day, _) in enumerate(months)
    ]
    return tables(
        orders=orders,
        order_items=[sale(str(i), "p", amount) for i, (_, amount) in enumerate(months)],
    )


def test_growth_crosses_an_empty_month_and_guards_zero(tables):
    t = month_tables(
        tables,
        [(DAY(2024, 1, 5), "0.00"), (DAY(2024, 3, 5), "100.00"), (DAY(2024, 4, 5), "150.00")],
    )
    growth = [tuple(r) for r in b.mom_growth(t).collect()]
    assert growth == [
        ("2024-01", D("0.00"), None, None),
        ("2024-03", D("100.00"), D("0.00"), None),
        ("2024-04", D("150.00"), D("100.00"), 50.0),
    ]
    assert [r["Moving_Avg_3M"] for r in b.moving_avg_3m(t).collect()] == [0.0, 50.0, 83.33]
    totals = [r["Running_Total"] for r in b.running_total(t).collect()]
    assert totals == [D("0.00"), D("100.00"), D("250.00")]
    assert b.headline_kpis(t).first()["Total_Revenue"] == totals[-1]


def test_monthly_trend_fills_the_empty_month(spark):
    df = spark.createDataFrame(
        [(DAY(2024, 1, 31), D("5.00"), D("1.00")), (DAY(2024, 3, 1), D("7.00"), None)],
        "Order_Date date, Sales decimal(12,2), Profit decimal(12,2)",
    )
    assert [tuple(r) for r in eda.monthly_trend(df).collect()] == [
        (DAY(2024, 1, 31), D("5.00"), D("1.00")),
        (DAY(2024, 2, 29), D("0.00"), D("0.00")),
        (DAY(2024, 3, 31), D("7.00"), D("0.00")),
    ]


def test_ranks_with_ties(tables):
    amounts = {"a": "9.00", "b": "9.00", "c": "9.00", "d": "1.00"}
    t = tables(order_items=[sale("1", p, amount) for p, amount in amounts.items()])
    ranks = rows_of(b.rank_in_category(t), "Product_ID", "Rank_In_Category")
    assert ranks == [("a", 1), ("b", 1), ("c", 1), ("d", 4)]
    top = rows_of(b.top5_products_per_category(t), "Product_ID", "Rnk")
    assert top == [("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def test_all_top_spenders_of_a_state(tables):
    t = tables(
        customers=[
            {"Customer_ID": c, "State": s, "Total_Spend": x}
            for c, s, x in (("a", "X", "5.00"), ("b", "X", "5.00"), ("c", "Y", "1.00"))
        ]
    )
    assert rows_of(b.top_spender_per_state(t), "Customer_ID") == [("a",), ("b",), ("c",)]


def test_order_sequence_breaks_ties_by_order(tables):
    t = tables(
        orders=[
            {"Order_ID": o, "Customer_ID": "c", "Order_Date": DAY(2024, 1, d)}
            for o, d in (("3", 1), ("1", 2), ("2", 1))
        ]
    )
    found = rows_of(b.order_sequence(t), "Order_ID", "Order_Sequence")
    assert found == [("1", 3), ("2", 1), ("3", 2)]


def test_tiers_differ_only_outside_the_range(table):
    discounts = ["-0.02", "0.00", "0.10", "0.11", "0.20", "1.00", "1.20", None]
    items = table("order_items", [{"Discount": d} for d in discounts])
    from tillroll.operators.features import discount_bucket

    found = items.select(
        "Discount", b.discount_tier_of().alias("tier"), discount_bucket().alias("bucket")
    ).collect()
    none, low, medium, high = "No Discount", "Low (0-10%)", "Medium (10-20%)", "High (20%+)"
    assert [r["tier"] for r in found] == [low, none, low, medium, medium, high, high, high]
    assert [r["bucket"] for r in found] == [None, none, low, medium, medium, high, None, None]


def test_collation_is_optional(tables):
    t = tables(customers=[{"Customer_ID": "1", "State": "Texas"}])
    assert b.customers_in_state(t, "TEXAS").count() == 0
    assert b.customers_in_state(t, "TEXAS", "UTF8_LCASE").count() == 1


def test_delivery_speed_and_slow_share(tables):
    t = tables(
        orders=[{"Order_ID": str(d), "Delivery_Days": d} for d in (3, 4, 6, 7)]
        + [{"Order_ID": "none", "Delivery_Days": None}],
        shipping=[{"Order_ID": str(d), "Delivery_Days": d} for d in (3, 7, 8)],
    )
    speeds = rows_of(b.delivery_speed(t), "Delivery_Days", "Delivery_Speed")
    assert speeds == [(3, "Fast"), (4, "Normal"), (6, "Normal"), (7, "Slow")]
    assert kpis.slow_shipment_share(t).first()["Slow_Shipment_Pct"] == 33.3


def test_sums_agree_across_reports(star):
    kpi = b.headline_kpis(star).first()
    assert b.running_total(star).collect()[-1]["Running_Total"] == kpi["Total_Revenue"]
    ltv = v.customer_ltv(star).agg({"Total_Sales": "sum", "Total_Orders": "sum"}).first()
    assert ltv["sum(Total_Sales)"] == kpi["Total_Revenue"]
    assert ltv["sum(Total_Orders)"] == star.orders.count()
    states = v.state_performance(star).agg({"Total_Sales": "sum"}).first()[0]
    assert states == kpi["Total_Revenue"]
