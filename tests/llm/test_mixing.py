from fractions import Fraction

import pytest

from tillroll.llm import mixing


def placed(df, **kw):
    return sorted(mixing.mixed(df, **kw).collect(), key=lambda r: (r.slot, r.place))


def test_less_than_one_block_off_at_every_slot(spark, docs):
    sizes = {"a": 90, "b": 60, "c": 30, "d": 31}
    df = docs([(1000 * i + j, "t", None, s) for i, (s, n) in enumerate(sizes.items()) for j in range(n)])
    shares = {"a": 3, "b": 2}
    rows = placed(df, shares=shares, other=1, block_docs=2)
    assert len(rows) == sum(sizes.values()) and len({r.doc_id for r in rows}) == len(rows)
    slots = {}
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert r.release <= r.slot < r.deadline
    horizon = max(r.slot for r in rows if r.on_target) + 1
    assert horizon >= 100
    seen = dict.fromkeys(sizes, 0)
    for t in range(horizon):
        seen[slots[t][0]] += 1
        for s in sizes:
            assert abs(seen[s] - Fraction(shares.get(s, 1), 7) * (t + 1)) < 1


def test_odd_inputs(spark, docs):
    df = docs([(1, "a", None, None), (1, "a", None, None), (None, None, None, "s"), (1, "b", None, ""), (2, "", None, "s")])
    rows = placed(df, shares={}, block_docs=2)
    assert len(rows) == 5
    assert sorted((r.source or "", r.block, r.place) for r in rows) == [("", 0, 0), ("", 0, 1), ("", 1, 0), ("s", 0, 0), ("s", 0, 1)]
    found = mixing.mixed(df)
    assert found.columns == [c for c in df.columns if c not in mixing.ADDED] + list(mixing.ADDED)
    assert mixing.mixed(docs([])).count() == 0
    with pytest.raises(Exception, match="add up"):
        mixing.mixed(df, shares={"s": mixing.MAX_PERIOD}).count()


def test_plan_has_no_python_and_one_shuffle_of_the_texts(spark, docs):
    plan = mixing.mixed(docs([(1, "a", None, "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def slow_plan(shares):
    """Slots of a period, one by one: of the released blocks the earliest deadline, ties to the first source."""
    period, done, plan = sum(shares.values()), dict.fromkeys(shares, 0), []
    for slot in range(period):
        free = [(-(-(done[s] + 1) * period // a), s) for s, a in sorted(shares.items()) if done[s] * period // a <= slot]
        plan.append((min(free)[1], done[min(free)[1]]))
        done[min(free)[1]] += 1
    return plan


def test_plan_by_definition(spark):
    for shares, other, n in (({"b": 4, "f": 3, "m": 2}, 1, 20), ({"c": 5, "z": 1}, 3, 9), ({}, 2, 5), ({"a": 7, "q": 7}, 2, 1)):
        every = {**{chr(ord("a") + i): other for i in range(n)}, **shares}
        sources = spark.createDataFrame([(s, 1) for s in every], "source string, n long")
        plan, period = mixing.periodic_slots(sources, shares, other)
        found = [(r._source, r._turn) for r in sorted(plan.collect(), key=lambda r: r.at)]
        assert period == sum(every.values()) and found == slow_plan(every)


def test_more_sources_than_a_period_once_had(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "'t' AS text", "concat('site', id % 25000) AS source")
    rows = mixing.mixed(df, shares={"site7": 4}, block_docs=1).collect()
    assert len(rows) == 30_000 and len({r.slot for r in rows}) == 30_000
    assert all(r.release <= r.slot < r.deadline for r in rows)
