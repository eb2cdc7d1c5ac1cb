"""Ensembles walked in arrays against Spark's own transform."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import forest, scoring


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(700, numPartitions=3).selectExpr(
        "id", "cast(id as string) name", "cast(id * 7919 % 601 as double) AS a", "cast(id % 5 as double) AS b", "cast(id * 104729 % 977 as double) AS d"
    )
    return df.withColumn("y", F.col("a") * F.col("b") + F.col("d")).withColumn("label", (F.col("y") > 1200).cast("int")).cache()


ESTIMATORS = {
    "forest": lambda: forest.ForestRegressor("y", 12, 7, 3),
    "classes": lambda: forest.ForestClassifier("label", 12, 7, 3, most=2),
    "own forest": lambda: RandomForestRegressor(labelCol="y", numTrees=9, maxDepth=6, seed=3),
    "own classes": lambda: RandomForestClassifier(labelCol="label", numTrees=9, maxDepth=6, seed=3),
    "boosted": lambda: GBTRegressor(labelCol="y", maxIter=9, maxDepth=4, stepSize=0.3, seed=3),
    "boosted classes": lambda: GBTClassifier(labelCol="label", maxIter=9, maxDepth=4, stepSize=0.3, seed=3),
    "line": lambda: LinearRegression(labelCol="y"),
    "logistic": lambda: LogisticRegression(labelCol="label"),
}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_scores_are_sparks(rows, tmp_path, kind):
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "d"], outputCol="features"), ESTIMATORS[kind]()]).fit(rows)
    model.write().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        mine = scoring.scored(m, rows)
        own = m.transform(rows)
        columns = ["id", "name", "prediction"]
        if "probability" in own.columns:
            own = own.withColumn("score", vector_to_array("probability")[1])
            columns.append("score")
        mine, own = rows_of(mine, *columns), rows_of(own, *columns)
        assert [r[:2] for r in mine] == [r[:2] for r in own]
        np.testing.assert_allclose([r[2:] for r in mine], [r[2:] for r in own], rtol=1e-12)
        if "forest" in kind or kind.endswith("classes") and "boosted" not in kind:
            assert mine == [tuple(r) for r in own]


def test_rows_walk_in_blocks_and_not_through_the_jvm(spark, rows):
    """Spark's transform is a UDF per row; an ensemble is applied by batches."""
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "d"], outputCol="features"), ESTIMATORS["forest"]()]).fit(rows)
    plan = scoring.scored(model, rows.drop("y"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert scoring.scored(model, rows.filter("id < 0")).count() == 0


def test_one_leaf(rows):
    flat = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), RandomForestRegressor(labelCol="z", numTrees=2)]).fit(rows.withColumn("z", F.lit(2.5)))
    assert scoring.scored(flat, rows).filter("prediction <> 2.5").count() == 0
