"""Gradient-boosted trees for labels 0 and 1 and for amounts, grown from sums over blocks of rows.

Spark's own boosting visits a tree's rows one by one, as objects, and starts several jobs per level. Here a job per
level sums counts, residuals and their squares by node, feature and bin in arrays; what the trees so far say of a row
is kept beside its bins. Losses, cuts and gains follow Spark's boosting, and the result is Spark's own model; rounding may
decide between equal cuts otherwise, and of more than ``SAMPLED`` rows another draw gives the cuts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import forest
from tillroll.operators.forest import BINS, CHUNKS, NODES, STORED_NODE
from tillroll.operators.scoring import trees_of
from tillroll.operators.settle import scratch_path, settled, shared_folder

SAMPLED = 10_000  # rows that cuts are taken from, as in Spark's boosting; all of them if there are no more
BLOCK_ROWS = 60_000  # of chunks whose amounts are summed together
TASK_ROWS = 150_000  # of a task until all cores have one; starting a task costs as much as summing many rows
ALIKE = np.finfo(float).eps  # a spread below it is rounding


def cuts_between(values: np.ndarray) -> np.ndarray:
    """Ascending cuts halfway between values, at most one less than ``BINS``, with about as many rows between them."""
    seen, counts = np.unique(values, return_counts=True)
    halfway = (seen[:-1] + seen[1:]) / 2
    if len(halfway) < BINS:
        return halfway
    upto, target, found = np.cumsum(counts), len(values) / BINS, []
    for i, cut in enumerate(halfway):
        if abs(upto[i] - target) < abs(upto[i + 1] - target):
            found.append(cut)
            target += len(values) / BINS
    return np.array(found)


def sampled_cuts(rows: DataFrame, n: int, width: int, seed: int) -> list[np.ndarray]:
    """The cuts of each feature from all rows, or from a draw of about ``SAMPLED`` of them."""
    drawn = rows.select("x") if n <= SAMPLED else rows.select("x").sample(SAMPLED / n, seed)
    x = np.array([row[0] for row in drawn.collect()]).reshape(-1, width)
    return [cuts_between(x[:, j]) for j in range(width)]


# A block of rows: bin numbers by feature, labels as -1 and 1, what the trees so far say, and what they leave over.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def started(rows: Iterable, width: int) -> Iterator[Block]:
    for row in rows:
        bins, label = forest.read(row.asDict(), width)
        y = (2 * label - 1).astype(np.int8)
        yield bins, y, np.zeros(len(y)), y.astype(np.float64)


def moved(blocks: Iterable[Block], feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int, step: float, first: bool) -> Iterator[Block]:
    """The blocks after one more tree, of which ``step`` is taken."""
    for bins, y, said, _ in blocks:
        leaf = forest.descended(bins, np.arange(len(y)), feature, cut, depth)
        said = said + value.take(leaf) * step
        with np.errstate(over="ignore"):
            yield bins, y, said, 4 * y / (1 + np.exp(2 * y * said))


def level_sums(blocks: Iterable[Block], feature: np.ndarray, cut: np.ndarray, level: int, nodes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows, residuals and their squares by node of a level, feature and bin, over the rows of one task."""
    at_place, sums = forest.places(nodes, level), None
    for bins, _, _, rest in blocks:
        if sums is None:
            sums = np.zeros((3, len(nodes), len(bins), BINS))
        place = at_place.take(forest.descended(bins, np.arange(len(rest)), feature, cut, level))
        if (place < 0).any():
            some = np.flatnonzero(place >= 0)
            bins, rest, place = bins.take(some, axis=1), rest.take(some), place.take(some)
        start, squares = place.astype(np.intp) * BINS, rest * rest
        for j, numbers in enumerate(bins):
            key = start + numbers
            for whole, weight in zip(sums, (None, rest, squares)):
                whole[:, j] += np.bincount(key, weight, len(nodes) * BINS).reshape(-1, BINS)
    if sums is not None:
        yield sums


def spread(sums: np.ndarray) -> np.ndarray:
    """The variance that goes with counts, sums and sums of squares."""
    return (sums[2] - sums[1] * sums[1] / sums[0]) / sums[0]


def best_cuts(sums: np.ndarray, before: np.ndarray):
    """Gain, feature and bin of each node's best cut, with the sums left and right of it; the first of equal ones wins."""
    left = np.cumsum(sums, axis=3)
    whole, left = left[..., -1:], left[..., :-1]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = before[:, None, None] - left[0] / whole[0] * spread(left) - right[0] / whole[0] * spread(right)
    gain = np.where((left[0] >= 1) & (right[0] >= 1), gain, -np.inf).reshape(len(before), -1)
    best, every = gain.argmax(axis=1), np.arange(len(before))
    feature, cut = best // (BINS - 1), best % (BINS - 1)
    return gain[every, best], feature, cut, left[:, every, feature, cut], right[:, every, feature, cut]


# A block of rows with amounts: bin numbers by feature, the cells of features together, and what the trees so far leave over.
Amounts = tuple[np.ndarray, list[np.ndarray], np.ndarray]


def begun(rows: Iterable, sizes: list[int]) -> Iterator[Amounts]:
    """The chunks of a task, several to a block; the first tree learns from the labels themselves."""
    groups, held, n = forest.packs(sizes), [], 0

    def block():
        bins, label = (np.concatenate(part, axis=-1) for part in zip(*held))
        return bins, forest.codes(bins, sizes, groups), label

    for row in rows:
        held.append(forest.read(row.asDict(), len(sizes)))
        n += row["n"]
        if n >= BLOCK_ROWS:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def stepped(blocks: Iterable[Amounts], feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int, step: float, first: bool) -> Iterator[Amounts]:
    """The blocks after one more tree, of which ``step`` is taken; a residual is twice what is left of the label."""
    leaves = value[1 << depth :] * (2 * step)
    for bins, coded, rest in blocks:
        yield bins, coded, (2 * rest if first else rest) - leaves.take(forest.reached(bins, feature, cut, depth))


def packed_sums(blocks: Iterable[Amounts], sizes: list[int], feature: np.ndarray, cut: np.ndarray, level: int, nodes: np.ndarray) -> Iterator[np.ndarray]:
    """As ``level_sums``, from the cells of several features together."""
    groups, at_place = forest.packs(sizes), forest.places(nodes, level)[1 << level : 2 << level]
    widths = [int(np.prod([sizes[j] for j in group])) for group in groups]
    totals = [np.zeros((3, len(nodes), width)) for width in widths]
    for bins, coded, rest in blocks:
        place = at_place.take(forest.reached(bins, feature, cut, level)).astype(np.intp)
        if (place < 0).any():
            some = np.flatnonzero(place >= 0)
            coded, rest, place = [code.take(some) for code in coded], rest.take(some), place.take(some)
        squares = rest * rest
        for code, width, whole in zip(coded, widths, totals):
            key = place * width + code
            for part, weight in zip(whole, (None, rest, squares)):
                part += np.bincount(key, weight, part.size).reshape(part.shape)
    yield forest.histograms(totals, sizes, groups)


def grown_tree(blocks: RDD, depth: int, summed: Callable):
    """One tree over the residuals: feature, bin and value by node, and its nodes with their sums.

    Nodes are numbered 1, 2 and 3, 4 to 7 and so on by level. A task sends as many numbers as the level's nodes need.
    """
    feature, cut, value = np.full(2 << depth, -1), np.full(2 << depth, -1), np.zeros(2 << depth)
    nodes, before, kept = np.array([1]), None, {}
    for level in range(depth):
        known = feature[: 2 << level], cut[: 2 << level]
        found = blocks.mapPartitions(lambda b, k=known, at=level, n=nodes: summed(b, *k, at, n)).collect()
        sums = sum(found[1:], found[0])  # in the order of the partitions
        whole = sums[:, :, 0].sum(axis=2)
        gain, by, at, left, right = best_cuts(sums, spread(whole) if before is None else before)
        below, spreads = [], []
        for i, node in enumerate(nodes.tolist()):
            inner = gain[i] > 0
            kept[node] = (*whole[:, i], gain[i] if inner else 0.0, by[i] if inner else -1, at[i] if inner else -1)
            if inner:
                feature[node], cut[node] = by[i], at[i]
                for child, own in ((2 * node, left[:, i]), (2 * node + 1, right[:, i])):
                    kept[child] = (*own, 0.0, -1, -1)
                    if abs(spread(own)) >= ALIKE:
                        below.append(child), spreads.append(spread(own))
        if not below:
            break
        nodes, before = np.array(below), np.array(spreads)
    for node, (n, total, *_) in kept.items():
        # rows below a node without a cut go left, down to the last level
        value[node << (depth + 1 - node.bit_length())] = total / n
    return feature, cut, value, kept


def boosted_nodes(chunks: DataFrame, steps: tuple[Callable, Callable, Callable], rounds: int, depth: int, step: float, interval: int) -> list[tuple]:
    """All nodes of all trees, one tree after the other; the blocks are checkpointed every ``interval`` rounds.

    ``steps`` make blocks from chunks, blocks after one more tree and the sums of a level.
    """
    begin, follow, summed = steps
    blocks, out, stored = chunks.rdd.mapPartitions(begin), [], []
    last = None
    for tree in range(rounds):
        if tree:
            last, first = blocks, tree == 1
            blocks = last.mapPartitions(lambda b, t=(feature, cut, value), f=first: follow(b, *t, depth, 1.0 if f else step, f))
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
        if tree and tree % interval == 0:
            blocks.checkpoint()
            stored.append(blocks)
        feature, cut, value, nodes = grown_tree(blocks, depth, summed)
        out += [(tree, node, *map(float, own[:4]), *map(int, own[4:])) for node, own in sorted(nodes.items())]
        if last is not None:
            last.unpersist()
        while len(stored) > 1:
            _forget(chunks.sparkSession, stored.pop(0))
    blocks.unpersist()
    for checkpoint in stored:
        _forget(chunks.sparkSession, checkpoint)
    return out


def _forget(spark: SparkSession, checkpoint: RDD) -> None:
    """Removes a checkpoint that nothing reads any longer."""
    name = checkpoint.getCheckpointFile()
    if name:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class _Boosted(Estimator):
    """Fits a tree a round to what the rounds before leave over of the loss; rows must have no missing value."""

    own = kind = odd = None  # Spark's estimator, the class of its model, what is said of odd labels

    def __init__(self, labelCol: str, maxIter: int, maxDepth: int, stepSize: float, seed: int, checkpointInterval: int = 10):
        super().__init__()
        self.label, self.rounds, self.depth, self.step, self.draws, self.interval = labelCol, maxIter, maxDepth, stepSize, seed, checkpointInterval

    def _odd(self, y: Column) -> Column:
        """Whether a label cannot be learned from."""
        raise NotImplementedError

    def _steps(self, sizes: list[int]) -> tuple[Callable, Callable, Callable]:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame):
        spark = dataset.sparkSession
        shared_folder(spark)  # also where the checkpoints go
        rows = dataset.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"))
        n, odd, width = rows.agg(F.count(F.lit(1)), F.count_if(F.coalesce(self._odd(F.col("y")), F.lit(True))), F.max(F.size("x"))).first()
        if not n or odd:
            raise ValueError("no rows to learn from" if not n else f"{odd} labels {self.odd}")
        cuts = sampled_cuts(rows, n, width, self.draws)
        chunks = rows.mapInArrow(lambda b: forest.chunked(b, cuts), CHUNKS)
        tasks = min(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
        chunks = settled(chunks.repartitionByRange(tasks, "chunk").sortWithinPartitions("chunk"))
        nodes = boosted_nodes(chunks, self._steps([len(c) + 1 for c in cuts]), self.rounds, self.depth, self.step, self.interval)
        return self._model(spark, nodes, cuts)

    def _model(self, spark: SparkSession, nodes: list[tuple], cuts: list[np.ndarray]):
        """Spark's model of as many trees: one of a single round, stored, with its trees and their number replaced."""
        tiny = spark.createDataFrame([(Vectors.dense([float(i)] * len(cuts)), float(i)) for i in range(2)], ["features", self.label])
        estimator = self.own(
            labelCol=self.label, maxIter=1, maxDepth=self.depth, stepSize=self.step, seed=self.draws, checkpointInterval=self.interval
        )
        single, path = scratch_path(spark, "round"), scratch_path(spark, "boosted")
        estimator.fit(tiny).write().save(single)
        about = json.loads(spark.read.text(f"{single}/metadata").first()[0])
        about["paramMap"]["maxIter"] = about["numTrees"] = self.rounds
        weights = [1.0] + [self.step] * (self.rounds - 1)
        first, text, weight = (tree := spark.read.parquet(f"{single}/treesMetadata")).columns
        every = spark.createDataFrame(list(enumerate(weights)), f"{first} int, {weight} double")
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        every.crossJoin(tree.select(text)).select(first, text, weight).write.parquet(f"{path}/treesMetadata")
        layout = spark.createDataFrame(nodes, NODES).groupBy("tree").applyInArrow(lambda group: forest.numbered(group, cuts, False), STORED_NODE)
        layout.write.parquet(f"{path}/data")
        model = self.kind.load(path)
        model._trees_as_arrays = trees_of(spark.read.parquet(f"{path}/data"), self.kind, weights)
        return model


class BoostedClassifier(_Boosted):
    """Labels 0 and 1 and the logistic loss."""

    own, kind, odd = GBTClassifier, GBTClassificationModel, "are neither 0 nor 1"

    def _odd(self, y):
        return ~y.isin(0.0, 1.0)

    def _steps(self, sizes):
        return lambda rows: started(rows, len(sizes)), moved, level_sums


class BoostedRegressor(_Boosted):
    """Any numbers as labels and the squared loss."""

    own, kind, odd = GBTRegressor, GBTRegressionModel, "are no numbers"

    def _odd(self, y):
        return F.isnan(y) | y.isNull()

    def _steps(self, sizes):
        return lambda rows: begun(rows, sizes), stepped, lambda b, *at: packed_sums(b, sizes, *at)
