"""Churn prediction from the scored customer table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.binning import right_closed_bins
from tillroll.functions.numbers import count, real
from tillroll.model import CHURN_AFTER_DAYS, SEED
from tillroll.operators import metrics, modelling, scoring
from tillroll.operators.boosting import BoostedClassifier
from tillroll.operators.features import label_codes
from tillroll.operators.forest import ForestClassifier
from tillroll.operators.modelling import Candidate, Fitted
from tillroll.operators.sampling import stratified_split
from tillroll.operators.settle import settled

CODED = ("Customer_Segment", "Gender", "State", "Income_Group")
# Recency, R_Score, RFM_Total, Cluster and RFM_Segment follow from the label: never features.
LEAKING = ("Recency", "R_Score", "RFM_Total", "Cluster", "RFM_Segment", "RFM_Score")
FEATURES = (
    "Frequency",
    "Monetary",
    "F_Score",
    "M_Score",
    "Customer_Age",
    "Customer_Lifetime_Value",
    "Customer_Segment_Enc",
    "Gender_Enc",
    "State_Enc",
    "Income_Group_Enc",
)
LABEL = "Churned"
RISK_EDGES = (-0.01, 0.33, 0.66, 1.0)
RISK_TIERS = ("Low Risk", "Medium Risk", "High Risk")
EXPORTED = (
    "Customer_ID",
    "Recency",
    "Frequency",
    "Monetary",
    "RFM_Segment",
    "Churned",
    "Predicted_Churn",
    "Predicted_Churn_Probability",
    "Churn_Risk_Tier",
)


def churn_label(recency="Recency", after_days: int = CHURN_AFTER_DAYS) -> Column:
    """1 for a customer without an order for more than ``after_days`` days, else 0."""
    days = F.col(recency) if isinstance(recency, str) else recency
    return F.when(days > after_days, 1).otherwise(0)


def churn_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(real(label)).alias("churn_rate"))


def feature_table(scored: DataFrame) -> DataFrame:
    """The scored customers with numeric features and ``is_test`` (a fifth of each label)."""
    coded = label_codes(scored, CODED, "_Enc", missing="nan")
    numeric = coded.withColumns(
        {
            "Monetary": real("Monetary"),
            "Customer_Lifetime_Value": real("Customer_Lifetime_Value"),
        }
    )
    return stratified_split(numeric, "Customer_ID", LABEL)


def candidates(
    train_rows: int,
    trees: int = 300,
    boosted: bool = False,
    rounds: int = 300,
    seed: int = SEED,
) -> list[Candidate]:
    """The models to compare; ``boosted`` adds gradient-boosted trees."""
    models = [
        Candidate(
            "Logistic Regression",
            # the usual L2 penalty of strength 1, spread over the rows
            LogisticRegression(
                labelCol=LABEL, maxIter=1000, regParam=1 / max(train_rows, 1), standardization=False
            ),
            scaled=True,
        ),
        Candidate(
            "Random Forest",
            # each node looks at the square root of the number of features
            ForestClassifier(
                labelCol=LABEL, numTrees=trees, maxDepth=8, seed=seed, most=math.ceil(len(FEATURES) ** 0.5)
            ),
        ),
    ]
    return [*models, boosted_trees(rounds, seed)] if boosted else models


def boosted_trees(rounds: int = 300, seed: int = SEED) -> Candidate:
    """One small tree a round; what the rounds leave over is checkpointed every ten of them."""
    trees = BoostedClassifier(
        labelCol=LABEL, maxIter=rounds, maxDepth=5, stepSize=0.05, seed=seed, checkpointInterval=10
    )
    return Candidate("Gradient Boosting", trees)


def predicted(model, df: DataFrame) -> DataFrame:
    """Adds the predicted class and the probability of churn."""
    return scoring.scored(model, df)


def risk_tier(probability="Predicted_Churn_Probability") -> Column:
    return right_closed_bins(probability, RISK_EDGES, RISK_TIERS)


def high_risk_count(predictions: DataFrame) -> DataFrame:
    high = F.col("Churn_Risk_Tier") == RISK_TIERS[-1]
    return predictions.agg(F.count_if(high).alias("high_risk_customers"))


@dataclass(frozen=True)
class ChurnRun:
    """Everything a training run yields; the frames are lazy."""

    features: DataFrame
    fits: Sequence[Fitted]
    comparison: DataFrame
    best: Fitted

    def test_predictions(self, name: str | None = None) -> DataFrame:
        return predicted(self._model(name), self.features.filter("is_test"))

    def importances(self, name: str = "Random Forest") -> DataFrame:
        return modelling.importances(self.features.sparkSession, self._model(name), FEATURES)

    def predictions(self) -> DataFrame:
        """All customers, those used for training too, with class, probability and tier."""
        return (
            predicted(self.best.model, self.features)
            .withColumnsRenamed(
                {"prediction": "Predicted_Churn", "score": "Predicted_Churn_Probability"}
            )
            .withColumn("Churn_Risk_Tier", risk_tier())
            .select(*EXPORTED)
        )

    def _model(self, name):
        chosen = name or self.best.name
        return next(f.model for f in self.fits if f.name == chosen)


def _fit(models: Sequence[Candidate], features: DataFrame) -> list[Fitted]:
    training, test = features.filter("not is_test"), features.filter("is_test")
    fits = []
    for candidate in models:
        model = modelling.fit(candidate, training, FEATURES)
        outcome = predicted(model, test).select(LABEL, "prediction", "score")
        row = metrics.classification_metrics(outcome, LABEL).first()
        fits.append(Fitted(candidate.name, model, row.asDict()))
    return fits


def _run(features: DataFrame, fits: Sequence[Fitted]) -> ChurnRun:
    comparison = modelling.comparison(features.sparkSession, fits, 4)
    return ChurnRun(features, fits, comparison, modelling.best(fits, "roc_auc", 4))


def train(scored: DataFrame, models: Sequence[str] | None = None, **options) -> ChurnRun:
    """Fits the models (or those named), compares them on the test rows, keeps the best."""
    features = settled(feature_table(settled(scored)))
    rows = features.filter("not is_test").count()
    tried = [c for c in candidates(rows, **options) if models is None or c.name in models]
    return _run(features, _fit(tried, features))


def with_boosted(run: ChurnRun, rounds: int = 300, seed: int = SEED) -> ChurnRun:
    """The same run with gradient-boosted trees as a further model."""
    return _run(run.features, [*run.fits, *_fit([boosted_trees(rounds, seed)], run.features)])


def risk_tier_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("Churn_Risk_Tier").agg(count().alias("Customers"))
