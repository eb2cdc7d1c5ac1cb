"""Tree ensembles applied to whole batches: all rows of a block walk down a tree together.

Spark's own transform visits the nodes row by row, as objects; here a tree is a few flat arrays. Splits, leaf
values and the order of summing are those of the model, so the scores are the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.settle import scratch_path

BLOCK = 2_048  # rows that walk together; they and a tree fit into a core's cache
MODELS = (RandomForestRegressionModel, RandomForestClassificationModel, GBTRegressionModel, GBTClassificationModel)


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees, tree after tree; a leaf's child is the leaf itself."""

    roots: np.ndarray
    depths: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray  # right and left child of each node
    value: np.ndarray  # by column and node


def trees_of(nodes: DataFrame, kind: type, weights: Sequence[float]) -> Trees:
    """The arrays of a model from its stored nodes; their number is the model's, whatever the rows it learned from."""
    n = F.col("nodeData")
    table = nodes.select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("said"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("cut"),
        F.get(n["impurityStats"], F.lit(0)).alias("s0"), F.get(n["impurityStats"], F.lit(1)).alias("s1"),
    ).toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
    tree, ids, left, right, feature = (np.asarray(table[c]).astype(np.intp) for c in ("tree", "id", "left", "right", "feature"))
    sizes = np.bincount(tree, minlength=len(weights))
    roots = np.cumsum(sizes) - sizes
    inner, here, base = left >= 0, np.arange(len(tree)), roots[tree]
    child = np.where(inner, np.stack([base + right, base + left]), here).T
    level = np.zeros(len(tree), np.intp)
    at = roots
    while len(at):  # level by level
        below = child[at[inner[at]]].ravel()
        level[below] = level[at].max(initial=0) + 1
        at = below
    depths = np.zeros(len(weights), np.intp)
    np.maximum.at(depths, tree, level)
    if kind is RandomForestClassificationModel:
        counts = np.stack([np.asarray(table["s0"], np.float64), np.asarray(table["s1"], np.float64)])
        value = counts / np.maximum(counts.sum(axis=0), np.finfo(float).tiny)
    else:
        value = (np.asarray(table["said"], np.float64) * np.asarray(weights)[tree])[None]
    return Trees(
        roots, depths, np.where(inner, feature, 0), np.where(inner, np.asarray(table["cut"], np.float64), np.inf), np.ascontiguousarray(child).ravel(), value
    )


def summed(x: np.ndarray, trees: Trees) -> np.ndarray:
    """The values of the leaves that each row reaches, summed over the trees in their order."""
    n, width = x.shape
    flat, start, total = x.ravel(), np.arange(n) * width, np.zeros((len(trees.value), n))
    for root, depth in zip(trees.roots, trees.depths):
        at = np.full(n, root)
        for _ in range(depth):
            goes_left = flat.take(trees.feature.take(at) + start) <= trees.cut.take(at)
            at = trees.child.take(2 * at + goes_left)
        for i, value in enumerate(trees.value):
            total[i] += value.take(at)
    return total


def results(total: np.ndarray, kind: type, trees: int) -> list[np.ndarray]:
    """The model's prediction, and of a classifier the probability of class 1."""
    if kind is RandomForestRegressionModel:
        return [total[0] / trees]
    if kind is GBTRegressionModel:
        return [total[0]]
    if kind is GBTClassificationModel:
        return [(total[0] > 0).astype(np.int32), 1 - 1 / (1 + np.exp(2 * total[0]))]
    return [(total[1] > total[0]).astype(np.int32), total[1] / (total[0] + total[1])]


def walked(batches: Iterator[pa.RecordBatch], trees: Trees, kind: type, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.asarray(batch.column(batch.num_columns - 1).flatten(), np.float64)
        x = np.ascontiguousarray(x.reshape(batch.num_rows, -1)) if batch.num_rows else np.empty((0, 1))
        blocks = [summed(x[low : low + BLOCK], trees) for low in range(0, len(x), BLOCK)]
        if blocks:
            found = results(np.concatenate(blocks, axis=1), kind, len(trees.roots))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found)], list(names))


def kept_trees(model) -> Trees:
    """The arrays of a model, read from its nodes once."""
    if not hasattr(model, "_trees_as_arrays"):
        spark = SparkSession.active()
        path = scratch_path(spark, "nodes")
        model.write().save(path)
        model._trees_as_arrays = trees_of(spark.read.parquet(f"{path}/data"), type(model), model.treeWeights)
    return model._trees_as_arrays


def scored(model, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction``, and for classifiers ``score``, the probability of class 1.

    Tree ensembles at the end of a pipeline are walked in arrays; other models are applied by Spark.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not isinstance(last, MODELS) or getattr(last, "numClasses", 2) != 2:
        out = model.transform(df)
        if "probability" not in out.columns:
            return out.select(*df.columns, "prediction")
        return out.select(*df.columns, F.col("prediction").cast("int"), vector_to_array("probability")[1].alias("score"))
    trees, kind = kept_trees(last), type(last)
    before = PipelineModel(model.stages[:-1]).transform(df) if isinstance(model, PipelineModel) else df
    columns = [c for c in df.columns if c != last.getFeaturesCol()]
    rows = before.select(*columns, vector_to_array(last.getFeaturesCol()).alias("_x"))
    layout = T.StructType([*rows.drop("_x").schema.fields])
    if kind in (RandomForestRegressionModel, GBTRegressionModel):
        layout = layout.add("prediction", "double")
    else:
        layout = layout.add("prediction", "integer").add("score", "double")
    names = layout.names
    return rows.mapInArrow(lambda batches: walked(batches, trees, kind, names), layout)
