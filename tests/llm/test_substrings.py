import hashlib
import re

from tests.llm.conftest import SF
from tillroll.llm import queries, substrings


def brute(texts, size):
    found = {i: re.findall("[^\x20\x09-\x0d]+", t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(found):
        for j in range(len(found[i]) - size + 1):
            first.setdefault(tuple(found[i][j : j + size]), i)
    result = {}
    for i, ws in found.items():
        gone = {
            k for j in range(len(ws) - size + 1) if first[tuple(ws[j : j + size])] < i for k in range(j, j + size)
        }
        result[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return result


def test_query_equals_brute_force(spark, texts):
    expected = {i: (n, m, hashlib.sha256(k.encode()).hexdigest()) for i, (n, m, k) in brute(texts, 50).items()}
    rows = queries.op6_substrings(spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected


def test_small_windows_and_overlaps(spark, docs):
    texts = {
        1: "a b c d e f g", 2: "x a b c d y", 3: "b c d e\tq b c d e", 4: "", 5: None, 6: "É É É É É É É É", 7: "É É É É É",
        8: "a b c", 9: "w " * 50_000,
    }
    expected = brute(texts, 4)
    found = substrings.without_repeats(docs(list(texts.items())), 4).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == expected


def test_repeated_and_missing_ids(spark, docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "a b c d z"), (None, "a b c d"), (None, "p q r s"), (2, "p q r s")]
    found = sorted((r.doc_id or 0, r.n_removed, r.kept) for r in substrings.without_repeats(docs(rows), 4).collect())
    assert found == [(0, 4, ""), (0, 4, ""), (1, 0, "a b c d"), (1, 0, "a b c d"), (1, 0, "a b c d z"), (2, 0, "p q r s")]
    assert substrings.without_repeats(docs([]), 4).count() == 0
