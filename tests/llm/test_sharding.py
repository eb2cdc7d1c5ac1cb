import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from tillroll.llm import sharding

UNEVEN = (((1.0, 3.0), (2.0,)), ((0.0, 1.0),), ((5.0,), (1.0, 1.0, 1.0)))


def draw(key, path):
    bits = int(hashlib.md5(f"{key}/{path}".encode()).hexdigest()[:13], 16)
    return (bits + 0.5) / 2**52


def descend(key, tree):
    """The shard of a key, by the same draws."""
    numbers, n = {}, 0
    for r, region in enumerate(tree):
        for k, rack in enumerate(region):
            for s in range(len(rack)):
                numbers[r, k, s], n = n, n + 1
    weigh = lambda x: x if isinstance(x, float) else sum(map(weigh, x))
    node, path, at = tree, "r", []
    for _ in range(3):
        races = [(-math.log(draw(key, f"{path}.{j}")) / weigh(c), j) for j, c in enumerate(node) if weigh(c) > 0]
        j = min(races)[1]
        node, path = node[j], f"{path}.{j}"
        at.append(j)
    return numbers[tuple(at)]


def run(df, **options):
    return [tuple(r) for r in sharding.sharded(df, **options).collect()]


@pytest.mark.parametrize("tree, grown", [(sharding.TREE, sharding.GROWN), (UNEVEN, None)])
def test_equals_brute_force(spark, docs, tree, grown):
    rows = [(i, "é" * (i % 7)) for i in range(300)] + [(None, None), (None, "x"), (5, "again"), (-3, ""), (2**62, "x" * 100_000)]
    found = run(docs(rows).repartition(3), tree=tree, grown=grown)
    expected = Counter()
    for i, text in rows:
        key, body = "" if i is None else str(i), (text or "").encode()
        expected[i, len(body) + 1, zlib.crc32(body), "key", descend(key, tree), None if grown is None else descend(key, grown)] += 1
    assert Counter((*r[:5], r[6]) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r[4]].append((r[5], hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()))
    for shard in slots.values():
        assert sorted(s for s, _ in shard) == list(range(len(shard)))
        assert [h for _, h in sorted(shard)] == sorted(h for _, h in shard)


def test_rows_only_move_into_the_new_shard(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    found = run(df)
    moved = [r for r in found if r[4] != r[6]]
    assert {r[6] for r in moved} == {16} and 4000 / 17 * 0.7 < len(moved) < 4000 / 17 * 1.3
    counts = Counter(r[4] for r in found)
    assert set(counts) == set(range(16)) and max(counts.values()) < 1.4 * 250 and min(counts.values()) > 0.6 * 250


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text")
    lighter = (((1.0, 3.0), (1.0,)), *UNEVEN[1:])  # the one shard of the second rack of the first region
    found = run(df, tree=UNEVEN, grown=lighter)
    for r in found:
        # no other region weighs another, so nothing moves between or within them; none enters the first region
        assert r[4] == r[6] or r[4] in (0, 1, 2)
        if r[4] in (0, 1):
            assert r[6] in (0, 1) or r[6] > 2
    weights = Counter(r[4] for r in found)
    assert 3 not in weights and abs(weights[5] / 3000 - 5 / 15) < 0.05


def test_repeated_rows_columns_and_empty_tables(spark, docs):
    found = run(docs([(7, "same")] * 50 + [(8, "b")]).repartition(4))
    slots = {(r[4], r[5]) for r in found}
    assert len(slots) == 51 and len({r[4] for r in found if r[0] == 7}) == 1
    assert run(docs([])) == []
    names = [*sharding.ADDED, "key", "key_hash", "text_hash", "place", "position", "_slice", "_w_position", "shard_region"]
    df = spark.createDataFrame([(1, "a", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert run(df)[0][:4] == (1, 2, zlib.crc32(b"a"), "key")
    with pytest.raises(ValueError):
        sharding.sharded(df, tree=(((0.0,),),))


def test_order_of_the_input_does_not_matter(spark, docs):
    rows = [(i % 40, f"text {i % 55}") for i in range(200)]
    assert sorted(run(docs(rows).repartition(5))) == sorted(run(docs(rows[::-1]).coalesce(1)))
