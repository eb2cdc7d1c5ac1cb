import collections
import math
import re
import zlib

from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tillroll.llm import ppm, queries


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


class Brute:
    """Context counts in dictionaries, searched from the longest context down."""

    def __init__(self, train, order):
        self.order = order
        self.nodes = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
        self.words = collections.Counter()
        for t in train:
            self.words.update(self.tokens(t))
            b = self.line(t)
            for i in range(order, len(b)):
                for k in range(order + 1):
                    self.nodes[k][b[i - k : i]][b[i]] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.memo = {}

    def line(self, t):
        return b"\xff" * self.order + lower(t).encode() + b"\xff"

    @staticmethod
    def tokens(t):
        return [*re.findall("[^\x20\x09-\x0d]+", lower(t)), None]

    def symbol(self, context, s):
        total, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            node = self.nodes[k].get(context[self.order - k :])
            if node is None:
                continue
            rest = {x: c for x, c in node.items() if x not in excluded}
            weight = sum(rest.values())
            if s in node:
                return total + math.log10((node[s] - 0.5) / weight)
            total += math.log10(len(rest) / 2 / weight) if rest else 0.0
            excluded = set(node)
        return total - math.log10(256 - len(excluded))

    def score(self, t):
        b, total = self.line(t), 0.0
        for i in range(self.order, len(b)):
            key = b[i - self.order : i + 1]
            if key not in self.memo:
                self.memo[key] = self.symbol(b[i - self.order : i], b[i])
            total += self.memo[key]
        return total

    def base(self, t):
        return sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in self.tokens(t))


def agrees(rows, texts, brute):
    for r in rows:
        t = texts[r.doc_id]
        assert (r.n_tokens, r.train_tokens) == (len(brute.tokens(t)), brute.n)
        assert r.n_known == sum(w in brute.words for w in brute.tokens(t))
        assert math.isclose(r.base_score, brute.base(t), rel_tol=1e-9)
        assert math.isclose(r.score, brute.score(t), rel_tol=1e-9)


def test_query_equals_brute_force(spark, texts):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    rows = queries.op8_ppm(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in rows} == held
    agrees(rows, texts, Brute([t for i, t in texts.items() if not held[i]], ppm.ORDER))


def test_small_texts_and_chunks(spark, docs, monkeypatch):
    texts = {1: "abra cadabra abra", 2: "Abra", 3: None, 4: "", 5: "çà et là", 6: "zz zz\nzz", 7: "abracadabra " * 3000}
    rows = ppm.log_probabilities(docs(list(texts.items())), F.col("doc_id").isin(2, 6), order=2).collect()
    agrees(rows, texts, Brute([t for i, t in texts.items() if i not in (2, 6)], 2))


def test_probabilities_of_a_context_add_up(spark):
    brute = Brute(["abra cadabra", "abc"], 3)
    for context in (b"abr", b"\xff\xff\xff", b"zab", b"qqq"):
        assert math.isclose(sum(10 ** brute.symbol(context, s) for s in range(256)), 1.0, rel_tol=1e-9)


def test_nothing_to_learn_from_and_repeats(spark, docs):
    rows = ppm.log_probabilities(docs([(1, "ab"), (1, "ab"), (None, "ab")]), F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 3
    assert all(math.isclose(r.score, -3 * math.log10(256)) for r in rows)
    assert ppm.log_probabilities(docs([]), F.lit(False)).count() == 0


def test_sorted_numbering_equals_the_table():
    import numpy as np

    ids = np.array([5, 900, 5, 17, 900, 0], np.int32)
    for limit in (1 << 20, 1):
        ppm_dense, ppm.DENSE = ppm.DENSE, limit
        out, used = ppm.renumbered(ids, 1000)
        ppm.DENSE = ppm_dense
        assert used.tolist() == [0, 5, 17, 900] and out.tolist() == [1, 3, 1, 2, 3, 0]
