"""What the churn and the sales model share: pipelines, comparison, importances, storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.settle import shared_folder


@dataclass(frozen=True)
class Candidate:
    """A model to try; ``scaled`` puts a scaler fitted on the training rows before it."""

    name: str
    estimator: Estimator
    scaled: bool = False


@dataclass(frozen=True)
class Fitted:
    name: str
    model: PipelineModel
    metrics: Mapping[str, float]


def fit(candidate: Candidate, train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    shared_folder(train.sparkSession)  # where models with many rounds keep their checkpoints
    raw = "_raw" if candidate.scaled else "features"
    stages = [VectorAssembler(inputCols=list(columns), outputCol=raw)]
    if candidate.scaled:
        stages.append(
            StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True)
        )
    return Pipeline(stages=[*stages, candidate.estimator]).fit(train)


def comparison(spark: SparkSession, fits: Sequence[Fitted], digits: int) -> DataFrame:
    """One row per model with its rounded metrics, in the order they were tried."""
    names = list(fits[0].metrics)
    rows = [
        (i, f.name, *[None if f.metrics[n] is None else round(f.metrics[n], digits) for n in names])
        for i, f in enumerate(fits)
    ]
    fields = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, f"position int, model string, {fields}")


def best(fits: Sequence[Fitted], metric: str, digits: int) -> Fitted:
    """Highest rounded metric; the model tried first wins a tie."""
    return max(fits, key=lambda f: round(f.metrics[metric] or 0.0, digits))


def importances(spark: SparkSession, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Feature importances of a tree model, highest first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(columns, map(float, weights)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> None:
    """Features, scaler and model in one artefact."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
