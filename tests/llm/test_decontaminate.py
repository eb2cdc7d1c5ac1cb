import random

import pytest

from tests.llm.conftest import SF
from tillroll.llm import decontaminate, queries
from tillroll.llm.decontaminate import Item, Matcher, least_distance, normal


def slow_distance(pattern, text):
    """Dynamic programme over all stretches of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (p != t)))
        row = now
    return min(row)


def edited(draw, text, edits):
    for _ in range(edits):
        at, kind = draw.randrange(len(text)), draw.randrange(3)
        text = text[:at] + ("" if kind == 0 else draw.choice("abcd ")) + text[at + (kind != 1) :]
    return text


def test_query_equals_brute_force(spark, con, texts):
    items = {i: normal(t) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    rows = {r.doc_id: r for r in queries.op2_decontaminate(spark, SF).collect()}
    assert rows.keys() == texts.keys()
    some = [i for i in sorted(texts) if rows[i].contaminated][:6] + [i for i in sorted(texts) if len(texts[i]) < 700][:12]
    for i in some:
        line = normal(texts[i])
        expected = [k for k, t in sorted(items.items()) if slow_distance(t, line) <= int(decontaminate.ERROR_RATE * len(t))]
        assert rows[i].item_ids == expected and rows[i].contaminated == bool(expected)
    exact = {i for i, t in texts.items() if any(x in normal(t) for x in items.values())}
    assert exact and exact <= {i for i, r in rows.items() if r.contaminated}


def test_bit_vectors_equal_the_dynamic_programme():
    draw = random.Random(1)
    for _ in range(200):
        pattern = "".join(draw.choice("abc ") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc ") for _ in range(draw.randrange(0, 120)))
        assert least_distance(pattern, text) == slow_distance(pattern, text)


def test_no_item_within_its_budget_is_missed():
    draw = random.Random(2)
    for _ in range(150):
        item = normal("".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(30, 120))))
        k = int(0.1 * len(item))
        around = "".join(draw.choice("abcdefgh ") for _ in range(60))
        text = f"{around} {edited(draw, item, draw.randrange(0, 2 * k + 1))} {around}"
        distance = slow_distance(item, normal(text))
        assert Matcher([Item(1, item, k)]).hits(text) == ([(1, distance)] if distance <= k else [])


def test_odd_inputs(spark, docs):
    item = "the quick brown fox jumps over the lazy dog near the river bank"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (None, "a second item that is long enough to count"), (3, None), (4, ""), (5, "too short")],
        "item_id long, text string",
    )
    rows = [(1, f"x {item.upper()}!! y"), (2, None), (3, ""), (4, item.replace("quick", "quack")), (5, "too short"),
            (6, "A second, item that is LONG enough to count"), (6, "clean"), (7, "clean " * 50_000 + item), (8, item[:40])]
    df = docs(rows)
    found = decontaminate.with_hits(df, bench)
    assert found.columns == [c for c in df.columns if c != "hits"] + ["hits"]
    hits = sorted((r.doc_id, r.text == "clean", [(h.item_id, h.distance) for h in r.hits]) for r in found.collect())
    assert hits == [(1, False, [(1, 0)]), (2, False, []), (3, False, []), (4, False, [(1, 1)]), (5, False, [(5, 0)]),
                    (6, False, [(None, 0)]), (6, True, []), (7, False, [(1, 0)]), (8, False, [])]
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.hits) for r in kept.collect()) == [(i, "y") for i in (2, 3, 6, 8)]
    assert decontaminate.clean(docs([]), bench).count() == 0
    assert decontaminate.clean(df, bench.where("1 = 0")).count() == len(rows)


@pytest.mark.parametrize("size, step, buffer", [(30, 10**6, 10**6), (30, 10**6, 1), (30, 40, 1), (90, 200, 1), (4_000_000,) * 3])
def test_items_in_blocks(spark, docs, monkeypatch, size, step, buffer):
    for name, value in (("BLOCK_BYTES", size), ("STEP_BYTES", step), ("BUFFER_BYTES", buffer)):
        monkeypatch.setattr(decontaminate, name, value)
    bench = spark.createDataFrame([(i, f"item number {i} says something of its own {i * 7919}") for i in range(5)], "item_id long, text string")
    df = docs([(i, f"before item number {i} says something of its own {i * 7919} after") for i in range(5)])
    hits = {r.doc_id: [h.item_id for h in r.hits if h.distance == 0] for r in decontaminate.with_hits(df, bench).collect()}
    assert hits == {i: [i] for i in range(5)}
    assert decontaminate.clean(df.unionByName(docs([(9, "nothing of it")])), bench).select("doc_id").collect() == [(9,)]


def test_short_items_count_as_whole_lines(spark, docs):
    bench = spark.createDataFrame([(1, "what is 2 + 2 ?"), (2, "Go on"), (3, "?!"), (4, " "), (5, "one\ntwo")], "item_id long, text string")
    rows = [(1, "what is 2 + 2 ?"), (2, "first line\n  go ON!\nthird line"), (3, "let us go on and on"), (4, "so ?! then"), (5, "so\n ?! \nthen"),
            (6, " "), (7, "One, two."), (8, "one\nthree\ntwo"), (9, None), (10, "!?")]
    hits = {r.doc_id: [h.item_id for h in r.hits] for r in decontaminate.with_hits(docs(rows), bench).collect()}
    assert hits == {1: [1], 2: [2], 3: [], 4: [], 5: [3], 6: [], 7: [5], 8: [], 9: [], 10: []}
    assert sorted(r.doc_id for r in decontaminate.clean(docs(rows), bench).collect()) == [3, 4, 6, 8, 9, 10]


def test_a_long_item_does_not_widen_the_blocks(spark):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(600_000))
    bench = spark.createDataFrame([(i, f"short item number {i} of sixty") for i in range(60)] + [(60, long)], "item_id long, text string")
    steps = list(decontaminate.item_steps(bench, decontaminate.ERROR_RATE))
    assert len(steps) == 1 and len(steps[0]) <= 3 and sum(map(len, steps[0])) == 61


def test_a_long_item_is_found_and_costs_nothing_elsewhere():
    draw = random.Random(3)
    long = " ".join(str(draw.randrange(10**6)) for _ in range(40_000))
    matcher = Matcher([Item(1, long, int(0.08 * len(long)))], 20)
    assert matcher.hits(f"before {long} after") == [(1, 0)]
    assert matcher.hits(long[:50_000] + " cut off") == []


def test_a_thousand_blocks_take_one_step_of_one_worker(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 30)
    bench = spark.createDataFrame([(i, f"item number {i} says {i * 7919}") for i in range(1000)], "item_id long, text string")
    found = decontaminate.with_hits(docs([(i, f"so item number {i} says {i * 7919} then") for i in range(3)]), bench)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, h.item_id) for r in found.collect() for h in r.hits if not h.distance} == {(i, i) for i in range(3)}
