"""Metrics against hand-made cases and Spark's evaluators; models end to end."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import churn, features, flat, metrics, modelling, sales, segmentation
from tillroll.plans import views

SCORED = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.6), (0, 0.6), (0, 0.4), (1, 0.4), (0, 0.1)]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(SCORED, "label int, score double")
    return df.withColumn("prediction", (F.col("score") > 0.5).cast("int")).cache()


def test_confusion_and_metrics(scored):
    assert tuple(metrics.confusion_counts(scored).first()) == (3, 2, 2, 1)
    row = metrics.classification_metrics(scored).first()
    assert row["accuracy"] == 5 / 8 and row["precision"] == 3 / 5 and row["recall"] == 3 / 4
    assert row["f1"] == pytest.approx(2 / 3)
    assert rows_of(metrics.confusion_matrix(scored)) == [(0, 0, 2), (0, 1, 2), (1, 0, 1), (1, 1, 3)]


def test_auc_is_exact(scored):
    pairs = [(p, n) for y, p in SCORED if y for z, n in SCORED if not z]
    expected = sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs)
    assert metrics.roc_auc(scored).first()[0] == pytest.approx(expected)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(scored) == pytest.approx(expected)


def test_roc_points(scored):
    points = rows_of(metrics.roc_points(scored), "tp", "fp", "threshold")
    start = (0, 0, float("inf"))
    assert points == [start, (1, 0, 0.9), (2, 1, 0.8), (3, 2, 0.6), (4, 3, 0.4), (4, 4, 0.1)]


def test_report(scored):
    report = {r["class"]: r for r in metrics.classification_report(scored).collect()}
    assert report["0"]["precision"] == pytest.approx(2 / 3) and report["0"]["support"] == 4
    assert report["macro avg"]["recall"] == pytest.approx((0.5 + 0.75) / 2)
    assert report["weighted avg"]["recall"] == pytest.approx(5 / 8)


def test_no_positive_prediction(scored):
    nothing = scored.withColumn("prediction", F.lit(0))
    row = metrics.classification_metrics(nothing).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    pairs = [(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 4.0), (5.0, 7.0), (6.0, 6.0)]
    row = metrics.regression_metrics(
        spark.createDataFrame(pairs, "label double, prediction double")
    ).first()
    assert row["mae"] == pytest.approx(4 / 6)
    assert row["rmse"] == pytest.approx(math.sqrt(6 / 6))
    assert row["r2"] == pytest.approx(1 - 6 / 17.5)


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.0,), (0.33,), (0.34,), (0.66,), (0.67,), (1.0,)], "p double")
    tiers = [r[0] for r in df.select(churn.risk_tier("p")).collect()]
    assert tiers == ["Low Risk"] * 2 + ["Medium Risk"] * 2 + ["High Risk"] * 2


def test_churn_label(spark):
    df = spark.createDataFrame([(180,), (181,)], "Recency int")
    assert [r[0] for r in df.select(churn.churn_label()).collect()] == [0, 1]


def test_best_model_first_wins_a_tie():
    fits = [
        modelling.Fitted("a", None, {"r2": 0.90001}),
        modelling.Fitted("b", None, {"r2": 0.90002}),
        modelling.Fitted("c", None, {"r2": 0.5}),
    ]
    assert modelling.best(fits, "r2", 3).name == "a"


def test_no_leaking_features():
    assert not set(churn.FEATURES) & set(churn.LEAKING)
    assert not set(sales.FEATURES) & set(sales.LEAKING)
    assert len(churn.FEATURES) == 10 and len(sales.FEATURES) == 11


@pytest.fixture(scope="module")
def churn_run(star):
    rfm = segmentation.rfm_table(views.sold_orders(star), star.customers)
    return churn.train(segmentation.score_rfm(rfm), trees=5, boosted=True, rounds=3)


def test_churn_run(churn_run, star):
    table = churn_run.comparison.collect()
    assert [r["model"] for r in table] == [
        "Logistic Regression",
        "Random Forest",
        "Gradient Boosting",
    ]
    assert all(0 <= r["roc_auc"] <= 1 for r in table)
    best = max(table, key=lambda r: r["roc_auc"])
    assert churn_run.best.name == best["model"]
    predictions = churn_run.predictions()
    assert predictions.columns == list(churn.EXPORTED)
    assert predictions.count() == churn_run.features.count()
    assert predictions.filter("Churn_Risk_Tier is null").count() == 0
    tiers = {r[0]: r[1] for r in churn.risk_tier_counts(predictions).collect()}
    assert churn.high_risk_count(predictions).first()[0] == tiers.get("High Risk", 0)
    weights = churn_run.importances().collect()
    assert len(weights) == 10 and sum(r["importance"] for r in weights) == pytest.approx(1)


def test_churn_is_repeatable_and_storable(churn_run, tmp_path):
    model = churn_run.best.model
    path = str(tmp_path / "model")
    modelling.save_model(model, path)
    again = churn.predicted(modelling.load_model(path), churn_run.features)
    first = churn.predicted(model, churn_run.features)
    assert rows_of(first, "Customer_ID", "score") == rows_of(again, "Customer_ID", "score")


def test_sales_run(star):
    dated = features.date_features(flat.prepared(star))
    run = sales.train(dated, trees=3)
    linear, forest = run.comparison.collect()
    assert linear["model"] == "Linear Regression" and forest["model"] == "Random Forest"
    assert forest["r2"] > linear["r2"] > 0.5
    assert run.best.name == "Random Forest"
    out = run.predictions()
    assert out.columns == list(sales.EXPORTED)
    assert out.count() == star.order_items.count()
    error = F.abs(F.col("Sales") - F.col("Predicted_Sales") - F.col("Prediction_Error"))
    assert out.filter(error > 1e-6).count() == 0
    assert run.test_pairs().count() == run.features.filter("is_test").count()
