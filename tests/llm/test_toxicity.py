import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tillroll.llm import queries, toxicity

SF1 = "/root/testdata/sf0.1"


def slow_segments(scores):
    """Maximal segments by their definition: the best stretch, then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 0 and (best is None or total > best[2] + 1e-12):
                best = (i, j + 1, total)
    if best is None:
        return []
    a, b, s = best
    right = [(x + b, y + b, z) for x, y, z in slow_segments(scores[b:])]
    return slow_segments(scores[:a]) + [best] + right


def test_segments_by_definition():
    draw = random.Random(3)
    for _ in range(300):
        scores = [draw.choice([-3, -2, -1, -0.5, 1, 2, 3.25]) + draw.random() / 16 for _ in range(draw.randrange(0, 14))]
        total = np.concatenate(([0.0], np.cumsum(scores)))
        places = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.maximal_segments(places, [total[p] for p in places], [total[p + 1] for p in places])
        expected = slow_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for _, _, s in found], [s for _, _, s in expected])


def test_held_out_rows_of_the_query(spark):
    rows = queries.op10_toxicity(spark, SF1).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in known)
    assert right >= 0.95 * len(known)
    toxic = [r.score for r in known if labels[r.doc_id]]
    fine = [r.score for r in known if not labels[r.doc_id]]
    pairs = [(a > b) + 0.5 * (a == b) for a in toxic for b in fine]
    assert sum(pairs) >= 0.85 * len(pairs)


def made(draw, bad):
    common = [f"w{i}" for i in range(60)]
    text = [draw.choice(common) for _ in range(40)]
    for _ in range(3 if bad else 0):
        text[draw.randrange(40)] = draw.choice(["grub", "slime", "rotten"])
    return " ".join(text)


def trained(spark, docs):
    draw = random.Random(11)
    rows = [(i, made(draw, i % 4 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    return toxicity.fit(docs(rows), labels, F.col("doc_id") < 300), draw


def test_fit_and_odd_inputs(spark, docs):
    model, draw = trained(spark, docs)
    rows = [(1, made(draw, True)), (2, made(draw, False)), (3, None), (4, ""), (5, "!!!"), (5, "!!!"), (None, "GRUB!! slime? rotten"),
            (6, "w1 " * 100_000), (7, "w1 " * 2_000 + "grub slime w2 rotten " + "w3 " * 2_000), (8, "neverseen words only")]
    df = docs(rows).withColumnRenamed("slot", "score")
    found = toxicity.scored(df, model)
    assert found.columns == [c for c in df.columns if c != "score"] + ["score", "predicted", "passages"]
    by = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    assert by[1].predicted == by[None].predicted == by[7].predicted == 1
    assert all(by[i].predicted == 0 for i in (2, 3, 4, 5, 6, 8))
    assert by[3].score == by[4].score == by[5].score == min(r.score for r in by.values())
    (passage,) = by[7].passages
    assert (passage.first, passage.end) == (2000, 2004) and passage.p <= toxicity.SIGNIFICANT
    assert toxicity.scored(docs([]), model).count() == 0


def test_without_labels_of_both_kinds(spark, docs):
    df = docs([(1, "a b"), (2, "c d")])
    labels = "doc_id long, toxic int"
    none = toxicity.fit(df, spark.createDataFrame([], labels), F.lit(True))
    assert {r.predicted for r in toxicity.scored(df, none).collect()} == {0}
    fine = toxicity.fit(df, spark.createDataFrame([(1, 0), (2, 0)], labels), F.lit(True))
    assert {r.predicted for r in toxicity.scored(df, fine).collect()} == {0}
    bad = toxicity.fit(df, spark.createDataFrame([(1, 1), (2, 1)], labels), F.lit(True))
    assert {r.predicted for r in toxicity.scored(df, bad).collect()} == {1}


def test_repeated_words_are_passages_again(spark, docs):
    model, _ = trained(spark, docs)
    passage, plain = "grub slime w2 rotten", "w3 " * 2_000
    rows = [(1, plain + passage + " " + plain + passage + " " + plain),
            (2, "".join(f"{plain}{word} " for word in ("grub", "slime", "rotten")) + plain + passage + " " + plain),
            (3, plain + passage + " " + plain)]
    by = {r.doc_id: r for r in toxicity.scored(docs(rows), model).collect()}
    assert [(p.first, p.end) for p in by[1].passages] == [(2000, 2004), (4004, 4008)]
    assert (8003, 8007) in [(p.first, p.end) for p in by[2].passages]
    assert by[1].predicted == by[2].predicted == by[3].predicted == 1
