import datetime
from decimal import Decimal as D
from pathlib import Path

import pytest

from tests.conftest import rows_of
from tillroll.model import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from tillroll.operators import quality, settle
from tillroll.plans import eda, views
from tillroll.operators import flat
from tillroll.sources import files
from tillroll.sources.tables import Tables


def test_schemas_are_consistent():
    assert [len(SCHEMAS[n]) for n in SCHEMAS] == [3, 12, 17, 10, 13, 6, 7, 6]
    assert all(key in SCHEMAS[table].names for table, key in PRIMARY_KEYS.items())
    assert all(k in SCHEMAS[c].names and k in SCHEMAS[p].names for c, p, k in FOREIGN_KEYS)


def test_csv_with_quotes_gaps_and_bad_values(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "Order_ID,Customer_ID,Order_Date,Ship_Date,Order_Status,Delivery_Days,Total_Sales,"
        "Total_Profit,Item_Count,Payment_Method\n"
        '1,c,2024-01-31,,Processing,,10.50,1.00,2,"Card, credit"\n'
        '2,c,2024-13-01,2024-02-02,"Say ""hi""",3.0,x,nan,1,NULL\n'
    )
    df = files.read_csv_tables(spark, str(tmp_path)).orders
    assert df.schema.names == SCHEMAS["orders"].names
    first, second = df.orderBy("Order_ID").collect()
    assert first["Order_Date"] == datetime.date(2024, 1, 31)
    assert first["Ship_Date"] is None and first["Delivery_Days"] is None
    assert first["Total_Sales"] == D("10.50") and first["Payment_Method"] == "Card, credit"
    assert second["Order_Date"] is None and second["Delivery_Days"] == 3
    assert second["Order_Status"] == 'Say "hi"'
    assert second["Total_Sales"] is None and second["Payment_Method"] is None


def test_other_separator_and_column_order(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Sub;CAT9;Top\n")
    df = files.read_csv(
        spark,
        str(tmp_path / "c.csv"),
        "categories",
        columns=["Sub_Category", "Category_ID", "Category"],
        sep=";",
        header=False,
    )
    assert rows_of(df) == [("CAT9", "Top", "Sub")]


def test_default_only_for_a_missing_column(spark):
    text = spark.createDataFrame([("i", ""), ("j", "0.5")], "Order_Item_ID string, Discount string")
    df = files.from_text(text, "order_items")
    assert rows_of(df, "Order_Item_ID", "Return_Flag", "Discount") == [
        ("i", "No", None),
        ("j", "No", D("0.50")),
    ]
    no_discount = files.from_text(text.drop("Discount"), "order_items")
    assert {r["Discount"] for r in no_discount.collect()} == {D("0.00")}


def test_tables_written_and_read_back(spark, star, tmp_path):
    names = ("categories", "reviews", "customers", "orders")
    files.write_tables(Tables({n: star[n] for n in names}), str(tmp_path))
    back = files.read_parquet_tables(spark, str(tmp_path))
    for money in ("Total_Spend", "Customer_Lifetime_Value"):
        assert rows_of(back.customers, money) == rows_of(star.customers, money)
    assert rows_of(back.orders, "Order_ID", "Total_Sales") == rows_of(
        star.orders, "Order_ID", "Total_Sales"
    )
    assert rows_of(back.categories) == rows_of(star.categories)
    assert rows_of(back.reviews, "Review_ID") == rows_of(star.reviews, "Review_ID")


def test_row_counts_come_from_the_files(spark, star, tmp_path):
    names = ("categories", "customers")
    files.write_tables(Tables({n: star[n] for n in names}), str(tmp_path))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counts = files.stored_row_counts(spark, {n: f"{tmp_path}/{n}" for n in names})
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "Customer_ID" not in plan
    assert {r.table_name: r.row_count for r in counts.collect()} == {n: star[n].count() for n in names}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert files.stored_row_counts(spark, {}).count() == 0


def test_fact_lines(spark, star, tmp_path):
    facts = eda.insight_summary(flat.prepared(star))
    path = str(tmp_path / "facts")
    files.write_lines(facts, path)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert len(lines) == 7 and lines[0].startswith("Best-selling category (revenue): ")


def test_views_by_name(spark, star):
    files.register_views(star, views.all_views(star))
    by_name = spark.sql("SELECT SUM(Total_Sales) AS s FROM vw_state_performance").first()[0]
    assert by_name == spark.sql("SELECT SUM(Sales) AS s FROM order_items").first()[0]


def test_bucketed_tables_join_without_a_shuffle(spark, star, tmp_path):
    files.save_bucketed(star, str(tmp_path), 4, prefix="b_")
    t = files.read_catalog_tables(spark, "b_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sold = views.sold_orders(t)
        plan = sold._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows_of(sold) == rows_of(views.sold_orders(star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_the_named_tables_are_bucketed(spark, tables, tmp_path):
    t = tables(
        orders=[{"Order_ID": str(i)} for i in range(9)],
        payments=[{"Payment_ID": str(i), "Order_ID": "hot"} for i in range(9)],
    )
    some = Tables({"orders": t.orders, "payments": t.payments})
    files.save_bucketed(some, str(tmp_path), 2, "h_", bucketed=["orders"])
    kinds = {
        name: spark.sql(f"DESCRIBE EXTENDED h_{name}").filter("col_name = 'Num Buckets'").count()
        for name in ("orders", "payments")
    }
    assert kinds == {"orders": 1, "payments": 0}
    assert spark.table("h_payments").count() == 9


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Category,Category_ID,Sub_Category\nPhones,C1,Smart\n")
    df = files.read_csv(spark, str(tmp_path / "a.csv"), "categories")
    assert [tuple(r) for r in df.collect()] == [("C1", "Phones", "Smart")]


def test_csv_without_some_columns_takes_defaults(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        "Sales,Order_Item_ID,Order_ID,Product_ID,Category,Sub_Category,Brand,Quantity,Unit_Price,Shipping_Cost,Profit\n"
        "20.00,i,o,p,c,s,b,2,10.00,1.00,5.00\n"
    )
    row = files.read_csv(spark, str(tmp_path / "i.csv"), "order_items").first()
    assert (row["Discount"], row["Return_Flag"]) == (D("0.00"), "No")
    assert (row["Sales"], row["Shipping_Cost"], row["Profit"]) == (D("20.00"), D("1.00"), D("5.00"))


def test_csv_line_breaks_in_texts(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "Review_ID,Order_Item_ID,Product_ID,Review_Score,Review_Text,Review_Date\n"
        'r1,i1,p,5,"line one\nline ""two""",2024-01-31\nr2,i2,p,4,plain,\n'
    )
    path = str(tmp_path / "r.csv")
    rows = files.read_csv(spark, path, "reviews").orderBy("Review_ID").collect()
    assert [r["Review_Text"] for r in rows] == ['line one\nline "two"', "plain"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_csv(spark, path, "reviews", multiline=False).collect()


def test_csv_with_an_unknown_column_or_a_short_row_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Category,Category_ID,Extra\na,b,c\n")
    with pytest.raises(ValueError, match="Extra"):
        files.read_csv(spark, str(tmp_path / "x.csv"), "categories")
    (tmp_path / "y.csv").write_text("Category,Category_ID,Sub_Category\na,b\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_csv(spark, str(tmp_path / "y.csv"), "categories").collect()


def test_whole_numbers(spark):
    from pyspark.sql import functions as F

    texts = ["3", "3.0", " 3 ", "3.7", "x", "", None, "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "Delivery_Days string")
    expected = [3, 3, 3, None, None, None, None, None]
    read = files.from_text(df.withColumn("Order_ID", F.monotonically_increasing_id()), "orders")
    assert [r["Delivery_Days"] for r in read.collect()] == expected
    coerced = quality.to_numbers(df, {"Delivery_Days": "int"})
    assert [r["Delivery_Days"] for r in coerced.collect()] == expected


def test_dates_in_several_formats(spark):
    df = spark.createDataFrame([("2024-01-31",), ("01/31/2024",), ("Jan 31, 2024",), ("31.31.2024",), (None,)], "d string")
    day = datetime.date(2024, 1, 31)
    assert [r["d"] for r in quality.to_dates(df, ["d"]).collect()] == [day, None, None, None, None]
    formats = ["yyyy-MM-dd", "MM/dd/yyyy", "MMM d, yyyy"]
    assert [r["d"] for r in quality.to_dates(df, ["d"], formats).collect()] == [day, day, day, None, None]
    lost = quality.lost_values(df, quality.to_dates(df, ["d"], formats), ["d"])
    assert rows_of(lost) == [("d", 1)]


def test_unknown_table_is_refused(star):
    with pytest.raises(ValueError):
        Tables({"returns": star.orders})
    with pytest.raises(AttributeError):
        Tables({}).orders


def test_stored_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(settle, "_handed_out", [])
    kept = settle.settled(spark.range(3))
    folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert Path(folder).is_dir()
    assert settle.remove_stored(spark) == 1 and not Path(folder).exists()
    assert settle.remove_stored(spark) == 0


def test_settled_rows_are_written_to_the_shared_folder(spark):
    df = spark.range(5)
    kept = settle.settled(df)
    assert rows_of(kept) == rows_of(df)
    folder = settle.shared_folder(spark).removeprefix("file:")
    assert all(folder in f for f in kept.inputFiles())
