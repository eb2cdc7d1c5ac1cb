import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tillroll.llm import language, queries


def test_held_out_accuracy(spark, con):
    truth = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = queries.op1_language(spark, SF).collect()
    assert len(rows) == len(truth)
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in truth}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_codewords_lie_apart():
    for n in (2, 3, 6, 7, 30):
        code = language.codewords(n)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= max(1, code.shape[1] // 3)
        assert all(0 < (code[:, b] > 0).sum() < n for b in range(code.shape[1]))
    assert language.codewords(1).shape == (1, 0)


def test_a_few_wrong_bits_do_not_change_the_language():
    code = language.codewords(6)
    model = language.Model(list("abcdef"), code, np.zeros((code.shape[1], 1)), np.ones(1, bool), np.ones(code.shape[1]), np.ones(code.shape))
    apart = min((code[i] != code[j]).sum() for i in range(6) for j in range(i))
    margins = code.copy()
    margins[:, : (apart - 1) // 2] *= -1
    model.margins = lambda texts: (margins, np.ones(6))
    assert model.decoded([""] * 6)[0].tolist() == list(range(6))


def test_odd_inputs(spark, docs):
    train = [(i, "the cat and the dog", "en") for i in range(1, 9)] + [(i, "der hund und die katze", "de") for i in range(9, 17)]
    odd = [(20, None, "en"), (21, "", None), (22, "12 ?!", "de"), (None, "the dog", None), (23, "the dog and a cat", None),
           (23, "the dog and a cat", None), (24, "x" * 100_000 + " und die katze", None), (25, "the der", None)]
    df = docs(train + odd)
    model = language.fit(df, F.col("doc_id") < 20)
    found = language.identified(df.withColumn("score", F.lit("mine")), model)
    rows = found.where("doc_id >= 20 OR doc_id IS NULL").collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(odd)
    assert all((by[i].lang_pred, by[i].score, by[i].ambiguous) == ("und", 0.0, False) for i in (20, 21, 22))
    assert by[23].lang_pred == by[None].lang_pred == "en" and by[24].lang_pred == "de"
    assert not by[23].ambiguous
    kept = language.confident(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} >= {*range(1, 17), 23, None} - {20, 21, 22}
    assert not {20, 21, 22} & {r.doc_id for r in kept.collect()}


def test_nothing_learnt_one_language_and_no_rows(spark, docs):
    df = docs([(1, "abc", None), (2, None, "en")])
    assert language.fit(df, F.lit(True)) is None
    assert {r.lang_pred for r in language.identified(df, None).collect()} == {"und"}
    assert language.confident(df, None).count() == 2
    one = docs([(1, "abc", "en"), (2, "?", "en")])
    rows = language.identified(one, language.fit(one, F.lit(True))).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in rows) == [(1, "en"), (2, "und")]
    assert language.identified(docs([]), language.fit(one, F.lit(True))).count() == 0


def test_many_languages(spark, docs):
    names = [f"l{i}" for i in range(9)]
    rows = [(10 * i + j, f"{chr(97 + i)}{chr(98 + i)}{chr(99 + i)} " * 5, n) for i, n in enumerate(names) for j in range(4)]
    df = docs(rows)
    found = language.identified(df, language.fit(df, F.lit(True))).collect()
    assert all(r.lang_pred == r.lang for r in found)
