import re
from itertools import permutations

import pytest

from tillroll.llm import audit

LABELS = "doc_id long, quality int, toxic int, bits string"


def fails(row, rows):
    doc_id, text = row[0], row[1] or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    found = ""
    found += "A" * (len(words) < 200)
    found += "B" * (100 * len(set(words)) < 50 * len(words))
    found += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text))
    found += "D" * any(c in "#$%&*|" for c in text)
    found += "E" * any(
        doc_id is not None and r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows
    )
    return found


def brute(rows, labels):
    good = {d for d, q, t in labels if q == 1}
    toxic = {d for d, q, t in labels if t == 1}
    good.discard(None)
    toxic.discard(None)
    result = []
    for part in sorted({r[3] or "" for r in rows}):
        mine = [(r[0], fails(r, rows)) for r in rows if (r[3] or "") == part]
        taken = {}
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                gone = lambda f: any(x in f for x in order[: step - 1])
                out = [d for d, f in mine if letter in f and not gone(f)]
                taken[letter] = taken.get(letter, 0) + len(out)
                result.append([
                    part, order, step, sum(not any(x in f for x in order[:step]) for _, f in mine), len(out),
                    sum(letter in f and gone(f) for _, f in mine), sum(f == letter for _, f in mine),
                    sum(d in good for d in out), sum(d in toxic for d in out), letter, part,
                ])
        for row in result:
            if row[-1] == part:
                row[-1] = taken[row[-2]]
    return sorted(tuple([*row[:-2], row[-1]]) for row in result)


def run(spark, docs, rows, labels):
    said = spark.createDataFrame([(*x, "x") for x in labels], LABELS)
    return sorted(tuple(r) for r in audit.audited(docs(rows), said).collect())


def long_text(start, n=300):
    return " ".join(f"w{start + i}" for i in range(n))


ROWS = [
    (1, long_text(0), "en", "a"), (2, long_text(0), "en", "b"), (3, "SHORT $ text", None, "a"), (4, "SHORT $ text", None, None),
    (5, "the " * 400, None, ""), (6, None, None, "a"), (7, "", None, "b"), (None, "", None, "b"), (None, long_text(0), None, "a"),
    (8, long_text(5) + " #", None, "b"), (8, long_text(5) + " #", None, "b"), (8, long_text(0), None, "c|d"), (9, " ÀÉ" * 50, None, "b"),
    (10, "A" + "b" * 49, None, "b"), (11, "AA" + "b" * 97, None, "b"), (12, "x\x0by\x1cz " * 150, None, "c|d"), (8, "other", None, "b"),
]


@pytest.mark.parametrize("salt", [1, 10_000])
def test_equals_brute_force(spark, docs, monkeypatch, salt):
    monkeypatch.setattr(audit, "SALT_ROWS", salt)
    rows = ROWS + [(100 + i, "copy of many", None, "ab"[i % 2]) for i in range(40)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (8, 1, None), (None, 1, 1), (105, None, 1), (9999, 1, 1)]
    assert run(spark, docs, rows, labels) == brute(rows, labels)


def test_empty_tables(spark, docs):
    assert run(spark, docs, [], [(1, 1, 1)]) == []
    assert run(spark, docs, ROWS[:3], []) == brute(ROWS[:3], [])


def test_no_row_meets_more_than_one(spark, docs):
    """Copies are not expanded into pairs: the join's right side has one row a text and part."""
    rows = docs([(i, "same", None, "a") for i in range(3000)])
    said = spark.createDataFrame([], LABELS)
    first = [r for r in audit.audited(rows, said).collect() if r["filter_order"] == "EABCD" and r["step"] == 1]
    assert [(r["kept"], r["removed"]) for r in first] == [(1, 2999)]


def test_clashing_columns(spark):
    names = ["hash", "digest", "bucket", "bitmap", "part", "bits", "n", "copies", "parts", "part_no", "earlier", "good", "bad", "toxic", "quality", "own", "before", "step", "kept"]
    kind = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    rows = spark.createDataFrame([(1, "a", "s", *names), (2, "a", "s", *names)], kind)
    said = spark.createDataFrame([(2, 1, 1, *names)], "doc_id long, quality int, toxic int, " + ", ".join(f"{n} string" for n in names if n not in ("quality", "toxic")) + ", z string, y string")
    found = [r for r in audit.audited(rows, said).collect() if r["filter_order"] == "EABCD" and r["step"] == 1]
    assert [(r["removed"], r["good_lost"], r["toxic_lost"]) for r in found] == [(1, 1, 1)]


def test_slots_keep_every_wanted_row(spark, monkeypatch):
    monkeypatch.setattr(audit, "SLOT_BITS", 1 << 10)
    rows = spark.range(5000).selectExpr("xxhash64(id) AS hash", "id")
    wanted = rows.where("id % 50 = 0").select("hash")
    found = {r["id"] for r in audit.in_slots(rows, wanted).collect()}
    assert {i for i in range(0, 5000, 50)} <= found and len(found) < 200
    assert audit.in_slots(rows, wanted.limit(0)).count() == 0
