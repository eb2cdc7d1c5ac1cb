import datetime
from collections import Counter
from decimal import Decimal as D
from itertools import product

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import segmentation
from tillroll.plans import views


@pytest.fixture(scope="module")
def scored(star):
    rfm = segmentation.rfm_table(views.sold_orders(star), star.customers)
    return segmentation.score_rfm(rfm).cache()


# How many of the 125 score triples each segment holds, counted by hand.
SEGMENT_SIZES = {
    "Champions": 8,
    "Loyal Customers": 37,
    "New Customers": 20,
    "At Risk": 20,
    "Lost": 8,
    "Needs Attention": 32,
}
EXAMPLES = {
    (4, 4, 4): "Champions",
    (5, 5, 3): "Loyal Customers",
    (3, 3, 1): "Loyal Customers",
    (4, 2, 5): "New Customers",
    (2, 4, 1): "At Risk",
    (2, 2, 2): "Lost",
    (2, 2, 3): "Needs Attention",
    (3, 2, 1): "Needs Attention",
    (2, 3, 5): "Needs Attention",
}


def test_segments_of_all_125_scores(spark):
    triples = list(product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    label = segmentation.segment_of(F.col("r"), F.col("f"), F.col("m"))
    found = {tuple(r)[:3]: r[3] for r in df.select("r", "f", "m", label).collect()}
    assert {t: found[t] for t in EXAMPLES} == EXAMPLES
    assert dict(Counter(found.values())) == SEGMENT_SIZES


def test_rfm_counts_orders_once(spark):
    day = datetime.date
    lines = spark.createDataFrame(
        [
            ("c", "1", day(2024, 1, 1), D("1.00")),
            ("c", "1", day(2024, 1, 1), D("2.00")),
            ("c", "2", day(2024, 1, 5), D("4.00")),
            ("d", "3", day(2024, 1, 9), D("8.00")),
            (None, "4", day(2024, 1, 9), D("9.00")),
        ],
        "Customer_ID string, Order_ID string, Order_Date date, Sales decimal(12,2)",
    )
    attributes = {c: F.lit(None).cast("string") for c in segmentation.ATTRIBUTES}
    found = segmentation.rfm_table(lines.withColumns(attributes))
    assert rows_of(found, "Customer_ID", "Recency", "Frequency", "Monetary") == [
        ("c", 4, 2, D("7.00")),
        ("d", 0, 1, D("8.00")),
    ]


def seven(spark, recency):
    rows = [(f"c{i}", recency[i], 1, D(i * 10)) for i in range(7)]
    return spark.createDataFrame(
        rows, "Customer_ID string, Recency int, Frequency bigint, Monetary decimal(28,2)"
    )


def test_scores_of_seven_customers(spark):
    df = segmentation.score_rfm(seven(spark, [0, 1, 2, 3, 4, 5, 6]))
    rows = {r["Customer_ID"]: r for r in df.collect()}
    # cut points at 1.2, 2.4, 3.6, 4.8 of 0..6
    assert [rows[f"c{i}"]["R_Score"] for i in range(7)] == [5, 5, 4, 3, 2, 1, 1]
    assert [rows[f"c{i}"]["F_Score"] for i in range(7)] == [1, 1, 2, 3, 4, 5, 5]
    assert [rows[f"c{i}"]["M_Score"] for i in range(7)] == [1, 1, 2, 3, 4, 5, 5]
    assert rows["c0"]["RFM_Score"] == "511" and rows["c0"]["RFM_Total"] == 7


def test_equal_recency_takes_the_lowest_bin(spark):
    df = segmentation.score_rfm(seven(spark, [9] * 7))
    assert {r["R_Score"] for r in df.collect()} == {5}


def test_quintiles_are_even(scored):
    sizes = [r["count"] for r in scored.groupBy("F_Score").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_segments_cover_all_customers(scored):
    shares = segmentation.segment_distribution(scored).collect()
    assert sum(r["Customers"] for r in shares) == scored.count()
    assert sum(r["Share_Pct"] for r in shares) == pytest.approx(100, abs=0.5)


def test_standardised(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "x int, same int")
    rows = segmentation.standardised(df, ["x", "same"]).collect()
    assert [r["x_Z"] for r in rows] == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert [r["same_Z"] for r in rows] == [0, 0, 0]


def test_clusters_are_ordered_by_value(scored):
    found = segmentation.clustered(scored, starts=1)
    assert found.columns == [*scored.columns, "Cluster"]
    profile = segmentation.cluster_profile(found).collect()
    assert [r["Cluster"] for r in profile] == [0, 1, 2, 3]
    money = [r["Monetary"] for r in profile]
    assert money == sorted(money)
    assert sum(r["Customers"] for r in profile) == scored.count()


def test_elbow_falls(scored):
    costs = [r["Inertia"] for r in segmentation.elbow(scored, [2, 4, 8], starts=1).collect()]
    assert costs[0] > costs[1] > costs[2]


def test_segments_of_all_scores_and_missing_ones(spark):
    values = [None, 1, 2, 3, 4, 5]
    rows = [(r, f, m) for r in values for f in values for m in values]
    df = spark.createDataFrame(rows, "r int, f int, m int")

    def at_least(x, limit):
        return x is not None and x >= limit

    def at_most(x, limit):
        return x is not None and x <= limit

    def expected(r, f, m):
        if at_least(r, 4) and at_least(f, 4) and at_least(m, 4):
            return "Champions"
        if at_least(r, 3) and at_least(f, 3):
            return "Loyal Customers"
        if at_least(r, 4) and at_most(f, 2):
            return "New Customers"
        if at_most(r, 2) and at_least(f, 4):
            return "At Risk"
        if at_most(r, 2) and at_most(f, 2) and at_most(m, 2):
            return "Lost"
        return "Needs Attention"

    found = df.select("r", "f", "m", segmentation.segment_of(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    assert all(row["s"] == expected(row["r"], row["f"], row["m"]) for row in found.collect())


def test_stacked_fits_are_as_good_as_separate_ones(spark):
    """All starts of all cluster counts in shared passes cost what ten fits of Spark's own each do, but for local minima."""
    df = spark.range(900).selectExpr("array((id * 7919 % 901) / 100.0D, (id * 104729 % 907) / 200.0D + id % 3 * 4) AS _point").repartition(3)
    found = segmentation.best_centers(df, [2, 3, 5], starts=10, sample_rows=200)
    vectors = df.select(array_to_vector("_point").alias("_point")).cache()
    for k, (cost, centers) in found.items():
        own = min(
            KMeans(k=k, seed=i, maxIter=300, tol=1e-4, featuresCol="_point").fit(vectors).summary.trainingCost for i in range(10)
        )
        assert cost <= own * 1.005 and centers.shape == (k, 2)
        apart = [min(sum((a - b) ** 2 for a, b in zip(r[0], c)) for c in centers) for r in df.collect()]
        assert cost == pytest.approx(sum(apart))


def test_more_clusters_than_points(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],)], "_point array<double>")
    cost, centers = segmentation.best_centers(df, [3], starts=2)[3]
    assert cost == 0 and centers.tolist() == [[1.0, 2.0]] * 3
    with pytest.raises(ValueError):
        segmentation.best_centers(df.limit(0), [3])
