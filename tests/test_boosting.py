"""Boosted trees against Spark's own."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import boosting, churn, modelling, sales, scoring
from tillroll.operators.boosting import BoostedClassifier, BoostedRegressor

OPTIONS = dict(labelCol="label", maxIter=23, maxDepth=4, stepSize=0.1, seed=3, checkpointInterval=10)


@pytest.fixture(scope="module")
def rows(spark):
    """More values than bins, few values, a constant, zeros and values below."""
    df = spark.range(900, numPartitions=3).selectExpr(
        "id", "cast(id * 7919 % 601 as double) AS a", "cast(id % 5 as double) AS b", "1.0D AS c",
        "cast(id * 104729 % 977 as double) - 400 AS d",
    ).withColumn("label", (F.col("a") * F.col("b") + F.col("d") + F.col("id") % 7 * 90 > 900).cast("int"))
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).select("id", "features", "label").cache()


def test_trees_are_sparks(rows, tmp_path):
    mine, own = BoostedClassifier(**OPTIONS).fit(rows), GBTClassifier(**OPTIONS).fit(rows)
    assert isinstance(mine, GBTClassificationModel) and mine.getNumTrees == 23
    assert mine.treeWeights == own.treeWeights
    assert mine.getMaxIter() == own.getMaxIter() and mine.totalNumNodes == own.totalNumNodes
    mine.write().save(str(tmp_path / "m"))
    again = GBTClassificationModel.load(str(tmp_path / "m"))
    said = [
        [r[0] for r in m.transform(rows).orderBy("id").select(vector_to_array("probability")[1]).collect()] for m in (own, mine, again)
    ]
    np.testing.assert_allclose(said[1], said[0], rtol=1e-9)
    assert said[2] == said[1]
    np.testing.assert_allclose([r[1] for r in rows_of(scoring.scored(mine, rows), "id", "score")], said[0], rtol=1e-9)


def test_rounds_read_blocks_and_leave_no_checkpoints(spark, rows, monkeypatch):
    """The churn model takes a job per level, not Spark's boosting, and clears what it stored on the way."""
    kept = []
    monkeypatch.setattr(boosting, "_forget", lambda spark, rdd, real=boosting._forget: (kept.append(rdd.getCheckpointFile()), real(spark, rdd)))
    candidate = churn.boosted_trees(rounds=21)
    assert not isinstance(candidate.estimator, GBTClassifier)
    numbers = rows.select("label", *[vector_to_array("features")[i].alias(c) for i, c in enumerate("abcd")])
    model = modelling.fit(candidate, numbers.withColumnRenamed("label", churn.LABEL), list("abcd"))
    assert model.stages[-1].getNumTrees == 21
    fs = spark._jvm.org.apache.hadoop.fs.Path(kept[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    assert len(kept) == 2 and not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(k)) for k in kept)


def test_one_class_and_odd_labels(spark, rows):
    same = BoostedClassifier(**{**OPTIONS, "maxIter": 3}).fit(rows.withColumn("label", F.lit(1)))
    assert scoring.scored(same, rows).filter("prediction <> 1").count() == 0
    for wrong in (rows.limit(0), rows.withColumn("label", F.lit(2)), rows.withColumn("label", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            BoostedClassifier(**OPTIONS).fit(wrong)


def test_cuts_from_a_draw(spark, monkeypatch):
    """More rows than are drawn: still at most 31 cuts, close to the shares of the rows."""
    monkeypatch.setattr(boosting, "SAMPLED", 2_000)
    x = spark.range(8_000).selectExpr("array(cast(id as double), cast(id % 3 as double)) AS x")
    many, few = boosting.sampled_cuts(x, 8_000, 2, 5)
    assert 28 <= len(many) <= 31 and np.abs(many - np.arange(1, len(many) + 1) * 250).max() < 500
    assert few.tolist() == [0.5, 1.5]
    assert boosting.cuts_between(np.array([2.0, 2.0])).tolist() == []


@pytest.mark.parametrize("block_rows", [100, 60_000])
def test_amounts_are_sparks(rows, tmp_path, monkeypatch, block_rows):
    """Trees over amounts are those of Spark's boosting, whatever the blocks; they are stored and read like any other."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block_rows)
    amounts = rows.withColumn("amount", F.col("id") * 7.25 % 311 + vector_to_array("features")[0] * vector_to_array("features")[1] - 200)
    options = {**OPTIONS, "labelCol": "amount"}
    mine, own = BoostedRegressor(**options).fit(amounts), GBTRegressor(**options).fit(amounts)
    assert isinstance(mine, GBTRegressionModel) and mine.getNumTrees == 23
    assert mine.treeWeights == own.treeWeights and mine.totalNumNodes == own.totalNumNodes
    mine.write().save(str(tmp_path / "m"))
    again = GBTRegressionModel.load(str(tmp_path / "m"))
    said = [[r[0] for r in m.transform(amounts).orderBy("id").select("prediction").collect()] for m in (own, mine, again)]
    np.testing.assert_allclose(said[1], said[0], rtol=1e-9)
    assert said[2] == said[1]
    np.testing.assert_allclose([r[1] for r in rows_of(scoring.scored(mine, amounts), "id", "prediction")], said[0], rtol=1e-9)
    np.testing.assert_allclose(mine.featureImportances.toArray(), own.featureImportances.toArray(), atol=1e-9)


def test_sales_are_boosted_from_blocks():
    """The sales model, too, takes a job per level, not Spark's boosting, which reads the rows one by one."""
    estimator = sales.boosted_trees().estimator
    assert isinstance(estimator, BoostedRegressor) and (estimator.rounds, estimator.depth, estimator.step) == (300, 6, 0.05)


def test_equal_amounts_and_missing_ones(spark, rows):
    options = {**OPTIONS, "labelCol": "amount", "maxIter": 3}
    same = BoostedRegressor(**options).fit(rows.withColumn("amount", F.lit(2.5)))
    assert same.totalNumNodes == 3 and scoring.scored(same, rows).filter("prediction <> 2.5").count() == 0
    for wrong in (rows.limit(0).withColumn("amount", F.lit(1.0)), rows.withColumn("amount", F.lit(None).cast("double")), rows.withColumn("amount", F.lit("nan").cast("double"))):
        with pytest.raises(ValueError):
            BoostedRegressor(**options).fit(wrong)


@pytest.mark.parametrize("level", [0, 1, 4, 6, 9])
def test_rows_reach_the_nodes_of_single_lookups(level):
    draw = np.random.default_rng(2)
    bins, size = draw.integers(0, 32, (4, 500)).astype(np.uint8), 2 << level
    feature, cut = draw.integers(-1, 4, size), draw.integers(0, 31, size)
    found = boosting.forest.reached(bins, feature, cut, level)
    assert ((1 << level) + found == boosting.forest.descended(bins, np.arange(500), feature, cut, level)).all()
