import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.functions.binning import equal_width_bin, quantile_bins, right_closed_bins
from tillroll.functions.numbers import percent, ratio, rounded_ratio
from tillroll.operators import features, flat
from tillroll.operators.sampling import fixed_size_sample, plain_split, stratified_split
from tillroll.plans import eda


def test_date_features(spark):
    friday = datetime.date(2024, 5, 31)
    days = [friday + datetime.timedelta(days=i) for i in range(4)] + [None]
    df = spark.createDataFrame(
        [(d, d and d + datetime.timedelta(days=3)) for d in days],
        "Order_Date date, Ship_Date date",
    )
    rows = features.date_features(df).collect()
    assert [r["Is_Weekend_Order"] for r in rows] == [False, True, True, False, False]
    first = rows[0].asDict()
    assert (first["Order_Year"], first["Order_Month"], first["Order_Quarter"]) == (2024, 5, 2)
    assert (first["Order_Weekday"], first["Order_YearMonth"]) == ("Friday", "2024-05")
    assert first["Days_To_Ship"] == 3 and rows[-1]["Days_To_Ship"] is None


def test_financial_features(spark):
    df = spark.createDataFrame(
        [
            (D("10.00"), D("2.50"), 2, D("0.00")),
            (D("0.00"), D("-1.00"), 0, D("0.15")),
            (None, None, 1, None),
            (D("30.00"), D("3.00"), 3, D("0.50")),
        ],
        "Sales decimal(12,2), Profit decimal(12,2), Quantity int, Discount decimal(4,2)",
    )
    rows = features.financial_features(df).collect()
    assert [r["Profit_Margin_Pct"] for r in rows] == [25.0, 0.0, 0.0, 10.0]
    assert [r["Avg_Item_Value"] for r in rows] == [5.0, None, None, 10.0]
    # the upper quartile of 0, 10, 30 is 20
    assert [r["Is_High_Value_Order"] for r in rows] == [False, False, False, True]


def test_label_codes_sort_by_code_point(spark):
    df = spark.createDataFrame([("b",), ("C",), (None,), ("a",), ("b",)], "Mode string")
    coded = features.label_codes(df, ["Mode"])
    assert [r["Mode_Encoded"] for r in coded.collect()] == [3, 0, 1, 2, 3]
    assert coded.columns == ["Mode", "Mode_Encoded"]


def test_engineered_has_the_68_columns(star):
    df = features.engineered(flat.cleaned(star, dedupe=False))
    assert len(df.columns) == 68
    kinds = dict(df.dtypes)
    assert kinds["Discount_Bucket"] == "string" and kinds["State_Encoded"] == "int"


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (1.0,), (1.1,), (None,)], "x double")
    out = df.select(right_closed_bins("x", [-0.01, 0, 1], ["zero", "some"]).alias("b")).collect()
    assert [r["b"] for r in out] == [None, "zero", "some", "some", None, None]


def test_quantile_bins_take_the_lowest_of_equal_cuts(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    out = df.select(quantile_bins("x", [2, 2, 2, 2], [1, 2, 3, 4, 5]).alias("b")).collect()
    assert [r["b"] for r in out] == [1, 1, 5, None]


def test_equal_width_bin_closes_the_last(spark):
    df = spark.createDataFrame([(0,), (4,), (5,), (10,), (None,)], "x int")
    out = df.select(equal_width_bin("x", F.lit(0), F.lit(10), 2).alias("b")).collect()
    assert [r["b"] for r in out] == [1, 1, 2, 2, None]
    constant = spark.createDataFrame([(3,)], "x int")
    assert constant.select(equal_width_bin("x", F.lit(3), F.lit(3), 4)).first()[0] == 1


def test_ratios(spark):
    df = spark.createDataFrame([(D("620862.21"), 6), (D("1.00"), 0), (None, 2)],
                               "a decimal(12,2), b bigint")
    rows = df.select(rounded_ratio("a", "b"), ratio("a", "b"), percent("b", "b")).collect()
    assert rows[0][0] == 103477.04  # exactly ...035: the tie goes up
    assert rows[1][0] is None and rows[1][1] is None and rows[1][2] is None
    assert rows[2][0] is None and rows[2][2] == 100.0


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = rows_of(fixed_size_sample(df, "k", 100))
    other = rows_of(fixed_size_sample(df.repartition(7), "k", 100))
    assert len(one) == 100 and one == other
    assert rows_of(fixed_size_sample(df, "k", 100, seed=1)) != one
    assert fixed_size_sample(df, "k", 5000).count() == 1000


def test_stratified_split(spark):
    df = spark.range(1003).select(
        F.col("id").alias("k"), F.when(F.col("id") % 10 < 3, 1).otherwise(0).alias("y")
    )
    split = stratified_split(df, "k", "y")
    shares = {(r["y"], r["is_test"]): r["count"] for r in
              split.groupBy("y", "is_test").count().collect()}
    ones = df.filter("y = 1").count()
    assert shares[1, True] == round(ones * 0.2)
    assert shares[0, True] == round((1003 - ones) * 0.2)
    assert sum(shares.values()) == 1003
    again = stratified_split(df.repartition(5), "k", "y")
    assert rows_of(split, "k", "is_test") == rows_of(again, "k", "is_test")


def test_plain_split(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    split = plain_split(df, "k")
    assert 0.18 < split.filter("is_test").count() / 5000 < 0.22
    assert rows_of(split) == rows_of(plain_split(df.repartition(3), "k"))


def test_correlation_drops_missing_pairs(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 9.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    found = {(r[0], r[1]): r[2] for r in eda.correlation_matrix(df, ["a", "b"]).collect()}
    assert set(found) == {("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")}
    assert found["a", "b"] == found["b", "a"] == pytest.approx(0.963123, abs=1e-6)
    assert found["a", "a"] == 1.0


def test_numeric_summary(spark):
    df = spark.createDataFrame([(D(i),) for i in (1, 2, 2, 7)] + [(None,)], "x decimal(12,2)")
    row = eda.numeric_summary(df, ["x"]).first()
    assert tuple(row) == ("x", 4, 3.0, 2.71, 1.0, 1.75, 2.0, 3.25, 7.0)


def test_age_density_sums_to_about_one(star):
    rows = eda.age_density(flat.prepared(star)).collect()
    assert len(rows) == 200
    step = rows[1]["Age"] - rows[0]["Age"]
    assert 0.8 < sum(r["Density"] for r in rows) * step < 1.0


def test_histogram_counts_every_buyer(star):
    buyers = flat.prepared(star).select("Customer_ID").distinct().count()
    bins = eda.age_histogram(flat.prepared(star)).collect()
    assert [r["Bin"] for r in bins] == list(range(1, 26))
    assert sum(r["Customers"] for r in bins) == buyers


def test_rows_stay_where_they_are_when_codes_are_joined(spark):
    """The codes are stored before they are joined: Spark knows that they are small, whatever it allows itself to broadcast."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    rows = session.range(300).select("id", *[(F.col("id") % n).cast("string").alias(f"c{n}") for n in (2, 7, 50)])
    coded = features.label_codes(rows.withColumn("c7", F.nullif("c7", F.lit("3"))), ["c2", "c7", "c50"])
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    order = {c: sorted(str(i) for i in range(n)) for c, n in (("c2", 2), ("c50", 50))}
    with_gap = sorted(["Not_Shipped", *[str(i) for i in range(7) if i != 3]])
    for r in coded.collect():
        assert r["c2_Encoded"] == order["c2"].index(r["c2"]) and r["c50_Encoded"] == order["c50"].index(r["c50"])
        assert r["c7_Encoded"] == with_gap.index(r["c7"] or "Not_Shipped")
