"""The forest against plain loops over its rows and against Spark's own."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import churn, forest, metrics
from tillroll.registry import QUERIES
from tillroll.operators import settle


@pytest.fixture(scope="module")
def rows(spark):
    """Labels from a step, a slope and some noise; one feature is constant, one has few values."""
    df = spark.range(600, numPartitions=3).selectExpr(
        "id", "cast(id * 7919 % 601 as double) AS a", "cast(id % 5 as double) AS b", "1.0D AS c",
        "cast(id * 104729 % 977 as double) AS d",
    ).withColumn("y", F.when(F.col("a") > 300, 50.0).otherwise(0.0) + F.col("d") / 20 + F.col("b"))
    df = df.withColumn("label", (F.col("y") > 40).cast("int"))
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).select("id", "features", "y", "label").cache()


def tree_by_loops(bins, y, w, depth, node=1):
    """Best cuts by trying all of them; rows up to a cut go left."""
    n, total = w.sum(), (w * y).sum()
    found, best = {node: (n, total / n, -1, -1)}, (1e-12, -1, -1)
    if depth:
        for j in range(len(bins)):
            for cut in range(forest.BINS - 1):
                left = bins[j] <= cut
                a, b = w[left].sum(), w[~left].sum()
                if a >= 1 and b >= 1:
                    gain = ((w * y)[left].sum() ** 2 / a + (w * y)[~left].sum() ** 2 / b - total**2 / n) / n
                    if gain > best[0] + 1e-9:
                        best = gain, j, cut
    if best[1] >= 0:
        found[node] = (n, total / n, best[1], best[2])
        left = bins[best[1]] <= best[2]
        found |= tree_by_loops(bins[:, left], y[left], w[left], depth - 1, 2 * node)
        found |= tree_by_loops(bins[:, ~left], y[~left], w[~left], depth - 1, 2 * node + 1)
    return found


@pytest.mark.parametrize("local_rows", [10, 10_000])
def test_nodes_equal_plain_loops(spark, rows, local_rows):
    cuts = forest.thresholds(rows.select(F.col("features").alias("v")).select(forest.vector_to_array("v").alias("x")), 4)
    given = rows.select(forest.vector_to_array("features").alias("x"), "y")
    chunks = settle.settled(given.mapInArrow(lambda b: forest.chunked(b, cuts), forest.CHUNKS))
    found = forest.forest_nodes(chunks, 4, 2, 4, 4, 7, local_rows).collect()
    stored = sorted(chunks.collect(), key=lambda r: r["chunk"])
    for tree in range(2):
        bins, label, weight = [], [], []
        for r in stored:
            b, y = forest.read(r.asDict(), 4)
            bins.append(b), label.append(y), weight.append(forest.drawn(7, tree, r["chunk"], r["n"]))
        bins, label, weight = np.concatenate(bins, axis=1), np.concatenate(label), np.concatenate(weight).astype(float)
        drawn = weight > 0
        expected = tree_by_loops(bins[:, drawn], label[drawn], weight[drawn], 4)
        mine = {r["node"]: (r["n"], r["total"] / r["n"], r["feature"], r["bin"]) for r in found if r["tree"] == tree}
        assert set(mine) == set(expected)
        for node, (n, mean, feature, cut) in expected.items():
            assert mine[node][0] == n and mine[node][1] == pytest.approx(mean) and mine[node][2:] == (feature, cut)


def test_as_good_as_sparks_own(rows):
    mine = forest.ForestRegressor("y", 20, 6, 3).fit(rows)
    spark_own = RandomForestRegressor(labelCol="y", numTrees=20, maxDepth=6, featureSubsetStrategy="all", seed=3).fit(rows)
    r2 = [metrics.regression_metrics(m.transform(rows), "y").first()["r2"] for m in (mine, spark_own)]
    assert r2[0] > 0.98 and abs(r2[0] - r2[1]) < 0.01
    assert mine.getNumTrees == 20
    assert np.abs(mine.featureImportances.toArray() - spark_own.featureImportances.toArray()).max() < 0.05


def test_classes(spark, rows, tmp_path):
    mine = forest.ForestClassifier("label", 15, 5, 3, most=2).fit(rows)
    spark_own = RandomForestClassifier(labelCol="label", numTrees=15, maxDepth=5, seed=3).fit(rows)
    areas = []
    for model in (mine, spark_own):
        scored = churn.predicted(model, rows).select("label", "prediction", "score")
        areas.append(metrics.roc_auc(scored).first()[0])
        assert scored.filter("score < 0 or score > 1").count() == 0
    assert areas[0] > 0.97 and abs(areas[0] - areas[1]) < 0.02
    mine.write().overwrite().save(str(tmp_path / "m"))
    again = RandomForestClassificationModel.load(str(tmp_path / "m"))
    assert rows_of(again.transform(rows), "id", "prediction") == rows_of(mine.transform(rows), "id", "prediction")


def test_nothing_to_learn(spark, rows):
    flat = forest.ForestRegressor("z", 3, 4, 1).fit(rows.withColumn("z", F.lit(2.5)))
    assert flat.totalNumNodes == 3 and flat.transform(rows).filter("prediction <> 2.5").count() == 0
    with pytest.raises(ValueError):
        forest.ForestRegressor("y", 3, 4, 1).fit(rows.limit(0))


def test_shared_fits_outlive_the_removal_of_stored_tables(spark):
    folder = "/root/testdata/sf0.001"
    first = rows_of(QUERIES["r10_clusters"](spark, folder), "Customer_ID", "Cluster")
    settle.remove_stored(spark)
    assert rows_of(QUERIES["r10_clusters"](spark, folder), "Customer_ID", "Cluster") == first


def test_chunks_are_spread_and_keep_their_draws(spark, rows, monkeypatch):
    """Rows that lie in one task are shared by all cores; the forest is that of the chunks as they were named."""
    seen = []
    monkeypatch.setattr(forest, "settled", lambda df: seen.append(settle.settled(df)) or seen[-1])
    monkeypatch.setattr(forest, "SENT_ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        model = forest.ForestRegressor("y", 3, 4, 7, localRows=100).fit(rows.coalesce(1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    chunks = seen[0]
    assert chunks.count() == 15 and chunks.select(F.spark_partition_id()).distinct().count() > 1
    assert [r["n"] for r in chunks.orderBy("chunk").collect()] == [40] * 15
    assert model.getNumTrees == 3


def test_labels_come_back_as_they_were():
    for labels, size in (([0, 1, 255], 1), ([0.01, 12345.67], 4), ([1 / 3, 2.0], 8), ([-1.0, 2.0], 8), ([3e7, 1.0], 8), ([-0.0], 8)):
        stored = forest.small_labels(np.array(labels, np.float64))
        assert len(stored) == size * len(labels)
        assert forest.whole_labels(stored, len(labels)).tobytes() == np.array(labels, np.float64).tobytes()


def test_cells_give_each_features_bins():
    draw = np.random.default_rng(1)
    sizes = [32, 3, 1, 11, 32, 5]
    bins = np.stack([draw.integers(0, s, 500) for s in sizes]).astype(np.uint8)
    place, weight, label = draw.integers(0, 3, 500), draw.integers(1, 4, 500).astype(float), draw.integers(0, 9, 500).astype(float)
    groups = forest.packs(sizes)
    assert sorted(j for g in groups for j in g) == list(range(6)) and len(groups) < 6
    counted = forest.cells(place, 3, forest.codes(bins, sizes, groups), sizes, groups, weight, label)
    found = forest.histograms(counted, sizes, groups)
    for j in range(6):
        expected = np.zeros((2, 3, forest.BINS))
        np.add.at(expected[0], (place, bins[j]), weight)
        np.add.at(expected[1], (place, bins[j]), weight * label)
        assert (found[:, :, j] == expected).all()
    sent = forest.sent_groups(sizes)
    numbers = np.stack([code.astype(np.uint16) for code in forest.codes(bins, sizes, sent)])
    assert (forest.unpacked(numbers, sizes, sent) == bins).all()


def test_trees_in_batches_leave_nothing_shuffled(spark, rows, monkeypatch):
    """Branches are sent for some trees at a time; what was shuffled for them is gone before the next."""
    cuts = forest.thresholds(rows.select(forest.vector_to_array("features").alias("x")), 4)
    given = rows.select(forest.vector_to_array("features").alias("x"), "y")
    chunks = settle.settled(given.mapInArrow(lambda b: forest.chunked(b, cuts), forest.CHUNKS))
    whole = rows_of(forest.forest_nodes(chunks, 4, 5, 4, 4, 7, 300))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: disk.getAllFiles().mkString(" ").count("shuffle_")
    left, stored = [], []

    def stores(df):
        before = shuffled()
        stored.append(settle.settled(df))
        for _ in range(50):  # files go in the background
            if shuffled() <= before:
                break
            time.sleep(0.1)
        left.append(shuffled() - before)
        return stored[-1]

    monkeypatch.setattr(forest, "settled", stores)
    monkeypatch.setattr(forest, "BATCH_ROWS", 2 * 600)
    batches = rows_of(forest.forest_nodes(chunks, 4, 5, 4, 4, 7, 10_000))
    assert [[t for (t,) in sorted(s.select("tree").distinct().collect())] for s in stored] == [[0, 1], [2, 3], [4]]
    assert max(left) <= 0
    assert [r[:2] + r[6:] for r in batches] == [r[:2] + r[6:] for r in whole]


def test_large_nodes_are_split_as_levels_are(monkeypatch):
    draw = np.random.default_rng(5)
    sizes, n = [32, 3, 1, 11, 32, 5], 4_000
    bins = np.stack([draw.integers(0, s, n) for s in sizes]).astype(np.uint8)
    label = np.round(bins[0] * 7.0 * bins[3] + bins[4] + draw.random(n), 2)
    weight = draw.integers(1, 4, n).astype(np.uint8)
    sent = forest.sent_groups(sizes)
    row = {"tree": 2, "node": 3, "chunk": 0, "n": n, "bins": np.stack([c.astype(np.uint16) for c in forest.codes(bins, sizes, sent)]).tobytes(),
           "labels": forest.small_labels(label), "weights": weight.tobytes()}
    group = pa.Table.from_pylist([row], schema=forest.fields(forest.SENT))
    for most in (6, 2):
        expected = forest.grown(group, 7, sizes, most, 8).sort_by("node").to_pydict()
        monkeypatch.setattr(forest, "LARGE_ROWS", 150)
        monkeypatch.setattr(forest, "CROWDED_ROWS", 30)
        found = forest.grown(group, 7, sizes, most, 8).sort_by("node").to_pydict()
        monkeypatch.undo()
        assert len(expected["node"]) > 100
        for name in ("tree", "node", "n", "feature", "bin"):
            assert found[name] == expected[name]
        for name in ("total", "squares", "gain"):
            np.testing.assert_allclose(found[name], expected[name], rtol=1e-9)
