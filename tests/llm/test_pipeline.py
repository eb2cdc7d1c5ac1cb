"""The corpus pipeline, stage by stage, against what plain code makes of the same rows."""

import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_pii import brute
from tests.llm.test_simhash import fingerprint, roots
from tillroll.llm import decontaminate, mixing
from tillroll.llm.common import table
from tillroll.operators.settle import settled


def test_stages_take_effect(spark, con):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF))
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after)
        if name != "mixing":
            assert docs.columns == columns
        if name == "language":
            assert len(after) >= 0.99 * len(rows)
        if name == "near_duplicates":
            found = roots({i: fingerprint(r.text) for i, r in rows.items()})
            assert after == {i: r for i, r in rows.items() if found[i] == i}
        if name == "decontamination":
            items = [decontaminate.normal(t) for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
            held = {i for i, r in rows.items() if any(x in decontaminate.normal(r.text) for x in items)}
            assert held and not held & after.keys() and len(rows) - len(after) - len(held) <= 2
            assert all(rows[i] == r for i, r in after.items())
        if name == "personal_data":
            assert after.keys() == rows.keys()
            hidden = [i for i, r in rows.items() if brute(r.text)]
            assert hidden
            for i, r in rows.items():
                assert (after[i].text != r.text) == (i in hidden)
                assert not [s for s in brute(after[i].text) if s[0] in ("email", "phone")]
        if name == "mixing":
            assert after.keys() == rows.keys() and docs.columns == columns + list(mixing.ADDED)
            assert all(r.release <= r.slot < r.deadline for r in after.values() if r.on_target)
        rows = after


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and "slot" in out.columns


def test_odd_rows_and_an_empty_table(spark, docs):
    rows = [(1, None), (2, ""), (3, "a normal line of text"), (3, "a normal line of text"), (None, "mail x@y.zz now"), (4, "z" * 200_000)]
    for given in (docs(rows), docs([])):
        found = given
        for _, stage in corpus_pipeline.STAGES:
            found = settled(stage(spark, found, SF))
        assert found.count() <= given.count()
