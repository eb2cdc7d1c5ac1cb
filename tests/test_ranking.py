"""The split computations against plain windows, with hot groups and many ties."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tests.conftest import rows_of
from tillroll.operators import ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one group holds a third of them, one value a third of another third."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        value = 0 if i % 9 == 0 else rng.randrange(400)
        rows.append((f"id{i:05d}", group, value))
    rows.append(("id_none", None, None))
    return spark.createDataFrame(rows, "id string, g string, v int").repartition(6).cache()


def many_slices(spark, run):
    """Runs with several shuffle partitions that are not merged again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_row_number_within_groups(spark, skewed):
    order = [F.col("v"), F.col("id")]
    plain = skewed.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)))
    split = many_slices(
        spark, lambda: rows_of(ranking.row_number(skewed, order, "n", ["g"]), "id", "n")
    )
    assert split == rows_of(plain, "id", "n")


def test_row_number_over_all(spark, skewed):
    order = [F.desc("v"), F.col("id")]
    plain = skewed.withColumn("n", F.row_number().over(W.partitionBy().orderBy(*order)))
    split = many_slices(spark, lambda: rows_of(ranking.row_number(skewed, order, "n"), "id", "n"))
    assert split == rows_of(plain, "id", "n")


def test_slices_are_really_several(spark, skewed):
    def run():
        sliced = skewed.repartitionByRange("g", "v", "id")
        return sliced.select(F.spark_partition_id()).distinct().count()

    assert many_slices(spark, run) > 1


@pytest.mark.parametrize("buckets", [1, 4, 7])
def test_ntile(spark, skewed, buckets):
    order = [F.desc("v"), F.col("id")]
    plain = skewed.withColumn("b", F.ntile(buckets).over(W.partitionBy().orderBy(*order)))
    split = many_slices(
        spark, lambda: rows_of(ranking.ntile(skewed, buckets, order, "b"), "id", "b")
    )
    assert split == rows_of(plain, "id", "b")


def test_more_buckets_than_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert rows_of(ranking.ntile(df, 5, [F.col("v")], "b")) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("within", [[], ["g"]])
def test_rank_with_ties(spark, skewed, dense, within):
    known = skewed.filter("v is not null")
    window = W.partitionBy(*within).orderBy(F.desc("v"))
    plain = known.withColumn("r", (F.dense_rank() if dense else F.rank()).over(window))
    split = many_slices(
        spark, lambda: rows_of(ranking.rank(known, "v", "r", within, dense), "id", "r")
    )
    assert split == rows_of(plain, "id", "r")


def test_quantiles_match_percentile(spark, skewed):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    expected = skewed.agg(F.percentile("v", probabilities)).first()[0]
    plain = ranking.quantiles(skewed, ["v"], probabilities)["v"]
    split = many_slices(spark, lambda: ranking.quantiles(skewed, ["v"], probabilities)["v"])
    assert plain == pytest.approx(list(expected))
    assert split == plain


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert ranking.quantiles(empty, ["v"], [0.5]) == {"v": [None]}
