import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import ppm, substrings, words
from tillroll.llm.words import PRIME, Powers


def thue_morse(n, swap=False):
    """Letters a and b by the number of ones in a place's binary digits; the pair agrees modulo 2**64 for any odd base."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_mirrored_words_differ(n):
    a, b = words.words(pa.array([thue_morse(n), thue_morse(n, True)])).hashes
    assert a != b
    windows = words.runs(np.array([5, 9], np.uint64)[np.array([[c == "b" for c in thue_morse(n)], [c == "a" for c in thue_morse(n)]]).astype(int)].ravel(),
                         words.WORD_POWERS, np.array([0, n]), np.array([n, 2 * n]))
    assert windows[0] != windows[1]


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_mirrored_words_are_not_mixed_up(spark, docs, n):
    same = " ".join(f"w{i}" for i in range(49))
    rows = docs([(1, f"{same} {thue_morse(n)}"), (2, f"{same} {thue_morse(n, True)}")])
    found = {r["doc_id"]: r["n_removed"] for r in substrings.without_repeats(rows).collect()}
    assert found == {1: 0, 2: 0}
    rows = docs([(1, thue_morse(n)), (2, thue_morse(n, True))])
    known = {r["doc_id"]: r["n_known"] for r in ppm.log_probabilities(rows, held=rows["doc_id"] == 2).collect()}
    assert known == {1: 2, 2: 1}


@pytest.mark.parametrize("at_a_time", [7, 1_000_000])
def test_equal_words_have_equal_hashes_wherever_they_stand(monkeypatch, at_a_time):
    monkeypatch.setattr(words, "BYTES_AT_A_TIME", at_a_time)
    texts = ["one two\tone", None, "", "  two ", "x" * 5000, "one", "tw o", "x" * 5000 + " y"]
    found = words.words(pa.array(texts))
    spelled = [w for t in texts for w in (t or "").split()]
    assert len(found.hashes) == len(spelled)
    assert len(set(found.hashes.tolist())) == len(set(spelled))
    assert len({(w, h) for w, h in zip(spelled, found.hashes.tolist())}) == len(set(spelled))
    which, begun = found.beginnings(2)
    assert [spelled[i] for i in which] == [w for w in spelled if len(w) > 2]
    assert len({(spelled[i][:2], h) for i, h in zip(which, begun.tolist())}) == len({w[:2] for w in spelled if len(w) > 2})


def test_powers_by_doubling():
    lane = Powers(123456789)
    for n in (1, 5, 1000, 33):
        up, down = lane.of(n)
        assert up.tolist() == [pow(123456789, i, PRIME) for i in range(n)]
        assert [int(u) * int(d) % PRIME for u, d in zip(up, down)] == [1] * n
