import re

import xxhash

from tests.llm.conftest import SF
from tillroll.llm import components, queries, simhash


def fingerprint(text, size=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lower)
    if not found:
        return 0
    lines = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(marks, bits=2):
    """Smallest id reached, by comparing all pairs."""
    parent = {i: i for i in marks}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(marks)
    for i in ids:
        for j in ids:
            if j < i and (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, texts):
    marks = {i: fingerprint(t) for i, t in texts.items()}
    expected = roots(marks)
    rows = queries.op9_simhash(spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {
        i: (marks[i], expected[i]) for i in texts
    }


def test_blocks_and_variants_find_the_same_links(spark):
    import random

    draw = random.Random(5)
    marks = [draw.getrandbits(64) for _ in range(40)]
    marks += [m ^ (1 << draw.randrange(64)) for m in marks[:20] for _ in range(6)]
    marks += [m ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for m in marks[:60]]
    marks = {i: m for i, m in enumerate(dict.fromkeys(marks))}
    signed = [(m - (1 << 64) if m >> 63 else m,) for m in marks.values()]
    df = spark.createDataFrame(signed, "mark long")
    expected = roots(marks)
    sizes = {}
    for i, r in expected.items():
        sizes.setdefault(r, set()).add(marks[i])
    for limit in (0, 3, 1000):  # all by variants, some, none
        links = simhash.links(df, 2, limit)
        found = {}
        for row in components.components(links).collect():
            found.setdefault(row.root, set()).add(row.node % (1 << 64))
        assert sorted(map(sorted, found.values())) == sorted(sorted(s) for s in sizes.values() if len(s) > 1)


def test_odd_inputs(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one Two"), (5, "ONE two"), (5, "ONE two"), (None, "one two"),
            (7, "a b c d"), (8, "word " * 200_000)]
    found = simhash.near_duplicates(docs(rows)).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert len(found) == len(rows)
    assert by[1] == by[2] == by[3] == {("0" * 16, 1)}
    assert by[4] == by[5] == by[None] == {(f"{fingerprint('one two'):016x}", 4)}
    assert simhash.near_duplicates(docs([])).count() == 0


def test_one_row_of_each_group_stays(spark, docs):
    rows = [(3, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (9, "x y z u v w"), (None, "only here now"),
            (None, "only here now")]
    kept = simhash.one_per_group(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "only here now"), (2, "a b c d e f"), (9, "x y z u v w")
    ]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    found = components.components(spark.createDataFrame(chain + star + [(5, 5)], "a long, b long"))
    roots_found = {r.node: r.root for r in found.collect()}
    assert roots_found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1050), 1000)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
