import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import flat, quality
from tillroll.plans import kpis

DAY = datetime.date


def test_first_per_key_keeps_the_first(table):
    orders = table(
        "orders",
        [
            {"Order_ID": "1", "Customer_ID": "b", "Order_Date": DAY(2024, 1, 2)},
            {"Order_ID": "1", "Customer_ID": "a", "Order_Date": DAY(2024, 1, 1)},
            {"Order_ID": "2", "Customer_ID": "c", "Order_Date": DAY(2024, 1, 3)},
        ],
    )
    report = quality.duplicate_report(orders, "Order_ID", "orders").first()
    assert (report["row_count"], report["duplicate_rows"]) == (3, 1)
    kept, dropped = quality.without_duplicates(orders, "Order_ID", ["Order_Date"])
    assert dropped == 1
    assert kept.columns == orders.columns
    assert rows_of(kept, "Order_ID", "Customer_ID") == [("1", "a"), ("2", "c")]
    assert kept.count() == report["row_count"] - report["duplicate_rows"]
    again, dropped = quality.without_duplicates(kept, "Order_ID")
    assert dropped == 0 and again is kept


def test_primary_keys_report_repeats_and_gaps(tables):
    t = tables(orders=[{"Order_ID": "1"}, {"Order_ID": "1"}, {"Order_ID": None}])
    found = {r["table_name"]: r for r in quality.primary_key_report(t).collect()}
    assert (found["orders"]["duplicate_keys"], found["orders"]["null_keys"]) == (1, 1)
    assert (found["reviews"]["duplicate_keys"], found["reviews"]["null_keys"]) == (0, 0)


def test_foreign_keys(tables):
    t = tables(
        orders=[{"Order_ID": "1", "Customer_ID": "c"}],
        customers=[{"Customer_ID": "c"}],
        order_items=[
            {"Order_ID": "1", "Product_ID": None},
            {"Order_ID": "9", "Product_ID": None},
            {"Order_ID": "9", "Product_ID": "p"},
        ],
    )
    found = {
        (r["child_table"], r["parent_table"]): (r["orphan_rows"], r["orphan_keys"])
        for r in quality.foreign_key_report(t).collect()
    }
    assert len(found) == 8
    assert found["order_items", "orders"] == (2, 1)
    assert found["order_items", "products"] == (1, 1)
    assert found["orders", "customers"] == (0, 0)


def test_integrity(table, spark):
    items = table(
        "order_items",
        [
            {"Sales": "-1.00"},
            {"Sales": None},
            {"Quantity": 0},
            {"Order_ID": None},
            {},
        ],
    ).withColumn("Customer_ID", F.lit("c"))
    found = dict(rows_of(quality.integrity_violations(items)))
    assert found == {
        "Sales >= 0": 2,
        "Quantity > 0": 1,
        "Order_ID present": 1,
        "Customer_ID present": 0,
    }
    with pytest.raises(ValueError, match="Quantity > 0"):
        quality.require_integrity(items)
    good = items.filter("Sales > 0 and Quantity > 0 and Order_ID is not null")
    assert quality.require_integrity(good) is good


def test_outliers(spark):
    values = [Decimal(i) for i in range(1, 10)] + [Decimal(1000), None]
    df = spark.createDataFrame([(v,) for v in values], "Sales decimal(12,2)")
    flagged = quality.outlier_flags(df, ["Sales"])
    assert rows_of(flagged.filter("Sales_Outlier"), "Sales") == [(Decimal("1000.00"),)]
    assert flagged.filter("Sales_Outlier is null").count() == 0
    row = quality.outlier_report(flagged, ["Sales"]).first()
    assert (row["outliers"], row["outlier_share"]) == (1, pytest.approx(1 / 11, abs=1e-6))
    rough = quality.outlier_flags(df, ["Sales"], exact=False)
    assert rough.filter("Sales_Outlier").count() == 1


def test_null_reports(table):
    orders = table("orders", [{"Ship_Date": None}, {"Ship_Date": None, "Order_Status": None}])
    assert [tuple(r) for r in quality.null_report(orders).collect()] == [
        ("Ship_Date", 2),
        ("Order_Status", 1),
    ]
    assert rows_of(quality.unexpected_nulls(orders)) == [("Order_Status", 1)]


def test_ranges_and_lengths(table, tables):
    scores = [0, 1, 5, 6, None]
    reviews = table("reviews", [{"Review_Score": s} for s in scores])
    assert rows_of(quality.out_of_range(reviews), "Review_Score") == [(0,), (6,)]
    t = tables(orders=[{"Order_ID": "12345678901"}, {"Order_ID": "1234567890"}])
    long = {(r[0], r[1]): r[2] for r in quality.length_report(t).collect()}
    assert long["orders", "Order_ID"] == 1
    missing = {(r[0], r[1]): r[2] for r in quality.required_report(t).collect()}
    assert missing["orders", "Order_ID"] == 0
    assert ("orders", "Ship_Date") not in missing


def test_formula(table):
    line = {"Quantity": 2, "Unit_Price": "10.00", "Discount": "0.10"}
    items = table(
        "order_items",
        [{**line, "Order_Item_ID": "ok", "Sales": "18.00"}, {**line, "Sales": "20.00"}],
    )
    assert rows_of(quality.formula_violations(items), "Difference") == [(Decimal("2.0000"),)]


def test_row_counts(tables):
    t = tables(orders=[{}, {}])
    found = rows_of(quality.row_count_check(t, {"orders": 2, "reviews": 5}))
    assert found == [("orders", 2, 2, True), ("reviews", 0, 5, False)]


def test_cleaned_has_the_46_columns_and_drops_repeats(tables):
    item = {"Order_ID": "o", "Product_ID": "p", "Sales": "5.00"}
    t = tables(
        customers=[{"Customer_ID": "c", "State": " Texas "}] * 2,
        orders=[{"Order_ID": "o", "Customer_ID": "c", "Ship_Date": None}],
        order_items=[{**item, "Order_Item_ID": "a"}, {**item, "Order_Item_ID": "b"}] * 2,
        reviews=[
            {"Review_ID": "1", "Order_Item_ID": "a", "Review_Score": 2},
            {"Review_ID": "2", "Order_Item_ID": "a", "Review_Score": 5},
        ],
    )
    df = flat.cleaned(t)
    assert len(df.columns) == 46 and len(flat.flat_table(t).columns) == 41
    assert {(r["Order_Item_ID"], r["Review_Score"]) for r in df.collect()} == {
        ("a", 3.5),
        ("b", None),
    }
    assert {r["State"] for r in df.collect()} == {"Texas"}
    log = {(r["step"], r["subject"]): r["affected_rows"] for r in
           kpis.cleaning_log(t, flat.prepared(t)).collect()}
    assert log["duplicates", "order_items.Order_Item_ID"] == 2
    assert log["duplicates", "customers.Customer_ID"] == 1


def test_same_column_names_get_a_suffix(spark, tables):
    names = ["Order_ID", "Sales", "Brand"]
    right = spark.createDataFrame([("o", 1, 2)], "Order_ID string, Sales int, Other int")
    assert flat._with_suffix(right, names, "Order_ID", "_order").columns == [
        "Order_ID",
        "Sales_order",
        "Other",
    ]


def test_marks_have_the_missing_values_of_the_prepared_table(tables):
    t = tables(
        customers=[{"Customer_ID": "c", "State": None, "Gender": None}, {"Customer_ID": "d"}],
        orders=[{"Order_ID": "o", "Customer_ID": "c", "Ship_Date": None}, {"Order_ID": "p", "Customer_ID": None}, {"Order_ID": "q", "Customer_ID": "d"}],
        order_items=[
            {"Order_Item_ID": "a", "Order_ID": "o", "Brand": None, "Sales": None}, {"Order_Item_ID": "b", "Order_ID": "p", "Quantity": None},
            {"Order_Item_ID": "b", "Order_ID": "none"}, {"Order_Item_ID": None, "Order_ID": None}, {"Order_Item_ID": "e", "Order_ID": "q"},
        ],
        shipping=[{"Shipping_ID": "s", "Order_ID": "o", "Carrier": None}, {"Shipping_ID": "r", "Order_ID": "q"}, {"Shipping_ID": "u", "Order_ID": "q"}],
        reviews=[{"Review_ID": "1", "Order_Item_ID": "a", "Review_Score": 2}, {"Review_ID": "2", "Order_Item_ID": "b", "Review_Score": None}],
    )
    whole, marks = flat.prepared(t), flat.prepared_marks(t, ("Sales",))
    assert marks.columns == whole.columns and marks.schema["Sales"] == whole.schema["Sales"]
    assert quality.null_counts(marks).collect() == quality.null_counts(whole).collect()
    # values do not travel: all but keys, kept columns and the mean review are marks
    moved = {f.name for f in marks.schema if f.dataType.typeName() != "boolean"}
    assert moved == {"Order_Item_ID", "Order_ID", "Customer_ID", "Sales", "Review_Score"}
