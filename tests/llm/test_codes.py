import math

import numpy as np
import pytest

from tillroll.llm import codes

KIND = "vec_id long, embedding array<float>, label int, part string, place string, error string"


def brute(rows, parts, entries, rounds, scale=1024):
    """Codes, error and final books by plain loops over whole numbers."""
    good = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not good:
        return [], []
    width = -(-max(len(v) for _, v, _ in good) // parts) * parts
    size = width // parts
    good = [(i, v + [0] * (width - len(v)), label) for i, v, label in good]
    order = sorted({i for i, _, _ in good}, key=lambda i: (i is None, i or 0))[:entries]
    first = [min(v for i, v, _ in good if i == want) for want in order]
    books = [[v[p * size : (p + 1) * size] for v in first] for p in range(parts)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in good:
                cut = v[p * size : (p + 1) * size]
                groups.setdefault(near(cut, books[p])[1], []).append(cut)
            for j, members in groups.items():
                books[p][j] = [sum(column) // len(members) for column in zip(*members)]
    found = []
    for i, v, label in good:
        pairs = [near(v[p * size : (p + 1) * size], books[p]) for p in range(parts)]
        found.append((i, label, [j for _, j in pairs], sum(d for d, _ in pairs)))
    sums = {}
    for _, label, _, error in found:
        sums[label] = sums.get(label, 0) + error
    return sorted(map(repr, [(*f, sums[f[1]]) for f in found])), books


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], KIND).repartition(3)
    found = codes.compressed(df, **options)
    return sorted(repr(tuple(r)) for r in found.rows.select("vec_id", "label", "codes", "error", "label_error").collect()), found.books.tolist()


@pytest.mark.parametrize("block, limit", [(4, codes.EXACT), (256, 0)])
def test_equals_brute_force(spark, monkeypatch, block, limit):
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "EXACT", limit)
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(size=8) + 3 * (i % 5)).astype(np.float32).tolist(), i % 3 or None) for i in range(160)]
    rows += [(500 + i, rows[3][1], 1) for i in range(30)]  # one very common vector
    options = {"parts": 4, "entries": 12, "rounds": 3}
    assert run(spark, rows, **options) == brute(rows, **options)


def test_odd_inputs(spark):
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [math.nan, 1.0], 1), (4, [math.inf, 0.0], 1), (None, [1.0, 1.0], None),
            (5, [0.5], None), (6, [-1.0, -3.0, 0.25], 2), (100, [], 2), (7, [3.0, 1.0], 2), (7, [3.0, -1.0], 3), (7, [3.0, -1.0], 3), (None, [9.0], 4)]
    for options in ({"parts": 2, "entries": 3, "rounds": 2}, {"parts": 4, "entries": 50, "rounds": 4}):
        assert run(spark, rows, **options) == brute(rows, **options)
    assert run(spark, []) == ([], [[]] * 4)
    assert run(spark, [(1, None, 1)]) == ([], [[]] * 4)
    assert run(spark, [(1, [], 1)])[0] == [repr((1, 1, [0, 0, 0, 0], 0, 0))]
    with pytest.raises(ValueError):
        run(spark, [(1, [1e30], 1)])


def test_large_numbers_are_exact(spark):
    rows = [(i, [2.0**17 + i * 0.25, -(2.0**17) - i], 1) for i in range(12)]
    options = {"parts": 1, "entries": 3, "rounds": 2}
    assert run(spark, rows, **options) == brute(rows, **options)


@pytest.mark.parametrize("axes, bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), axis=-1).reshape(-1, axes)
    keys = [k.tobytes() for k in codes.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    ordered = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_every_nearest_entry():
    draw = np.random.default_rng(7)
    shorter = 0
    for _ in range(300):
        entries = draw.integers(-50, 50, (20, 3))
        points = draw.integers(-50, 50, 3) + draw.integers(-6, 6, (9, 3))
        listed = codes.shortlist(points.min(axis=0), points.max(axis=0), entries)
        apart = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        code, distance = codes.nearest(points, entries, listed, np.int64)
        assert code.tolist() == apart.argmin(axis=1).tolist() and distance.tolist() == apart.min(axis=1).tolist()
        shorter += len(listed) < 20
    assert shorter > 200
