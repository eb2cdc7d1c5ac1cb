import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import topk

KIND = "vec_id long, embedding array<float>, extra string"


def brute(rows, k, scale=1024):
    good = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = []
    for q in sorted({i for i, _ in good if i % 100 == 0}):
        query = min(v for i, v in good if i == q)
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in good if i != q)
        result += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return result


def run(spark, rows, k):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k).collect())


@pytest.mark.parametrize("block", [2, 2048])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=6).astype(np.float32).tolist()) for i in range(450)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # ties
    assert run(spark, rows, 10) == brute(rows, 10)


def test_odd_inputs(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (None, [1.0, 1.0]),
            (5, [0.5]), (6, [-1.0, -3.0]), (100, []), (200, [3.0, 1.0]), (200, [3.0, 1.0]), (7, [1e5, 1e5])]
    assert run(spark, rows, 10) == brute(rows, 10)
    assert run(spark, [(0, [1.0])], 10) == []
    assert run(spark, [(1, [1.0])], 10) == []
    assert run(spark, [], 10) == []


def test_large_numbers_are_exact(spark):
    rows = [(0, [2.0**17 + 1, 3.0]), (1, [2.0**17 + 2, 5.0]), (2, [2.0**17, 7.0])]
    assert run(spark, rows, 2) == brute(rows, 2)
    with pytest.raises(ValueError):
        run(spark, [(0, [1e30]), (1, [1e30])], 2)
