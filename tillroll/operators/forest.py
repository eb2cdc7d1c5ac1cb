"""Random forests whose large nodes are split from summed histograms and whose small ones in one task each.

Spark's own forest sums a histogram for every node of every tree down to the last level, which for
hundreds of deep trees is far more than the rows themselves. Here only nodes with more than ``LOCAL_ROWS`` rows
are split that way. The rows of a smaller node are sent to one task, which grows the rest of its branch.
The split found is the same either way. The result is Spark's own forest model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.scoring import trees_of
from tillroll.operators.settle import scratch_path, settled

BINS = 32  # of each feature
LOCAL_ROWS = 2_000_000  # of a node whose branch one task grows
BATCH_ROWS = 600_000_000  # times trees, whose branches are sent and grown at a time; what was sent is removed before the next
LARGE_ROWS = 100_000  # of a node that its task splits by itself, not with all others of the level
CROWDED_ROWS = 500  # of a node on average, from which features are counted together below a large node
LOOKED_UP = 7  # levels down to which every split is compared for all rows
BLOCK_ROWS = 30_000  # of chunks that a task works on together, trees in turn; they fit into a core's cache
SENT_ROWS = 100_000  # of a block whose rows are sent, so that a node gets few pieces
PACKED = 256  # cells of features that are counted together
PASS_NODES = 8_192  # whose histograms one pass over the rows sums
ACCURACY = 10_000  # of the quantiles between bins

NODES = (
    "tree int, node int, n double, total double, squares double, gain double, feature int, bin int"
)
CHUNKS = "chunk long, n int, bins binary, labels binary"
SUMS = "tree int, node int, chunk long, squares double, sums binary"
SENT = "tree int, node int, chunk long, n int, bins binary, labels binary, weights binary"
STORED_NODE = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,"
    "rawCount:long,gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)

ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def fields(layout: str) -> pa.Schema:
    """The Arrow schema of a flat layout."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (column.split() for column in layout.split(","))])


SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", SPLIT),
])


def thresholds(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Ascending cuts of each feature; a value up to a cut lies left of it."""
    at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    columns = [F.get("x", F.lit(i)) for i in range(width)]
    found = rows.agg(
        *[F.percentile_approx(c, at, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"m{i}") for i, c in enumerate(columns)],
    ).first()
    if found["m0"] is None:
        raise ValueError("no rows to learn from")
    # nothing lies right of the greatest value
    return [np.array([v for v in sorted(set(found[f"q{i}"])) if v < found[f"m{i}"]]) for i in range(width)]


def chunked(batches, cuts: list[np.ndarray]):
    """Rows as blocks of bin numbers and labels."""
    first = TaskContext.get().partitionId() << 32
    for i, batch in enumerate(batches):
        if len(batch):
            x = np.asarray(batch.column(0).flatten(), np.float64).reshape(len(batch), len(cuts))
            bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]).astype(np.uint8)
            row = {"chunk": first + i, "n": len(batch), "bins": bins.tobytes(),
                   "labels": np.asarray(batch.column(1), np.float64).tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=fields(CHUNKS))


def drawn(seed: int, tree: int, chunk: int, n: int) -> np.ndarray:
    """How often each row of a chunk is drawn for a tree."""
    return np.random.Generator(np.random.PCG64([seed, tree, chunk])).poisson(1.0, n)


def read(row: dict, width: int):
    return np.frombuffer(row["bins"], np.uint8).reshape(width, row["n"]), np.frombuffer(row["labels"], np.float64)


def blocks(batches, width: int, most: int):
    """Chunks that follow each other in groups, so that sums keep the order of chunks: names and lengths, bin numbers and labels."""
    held, rows = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["chunk"] != held[-1][0] + 1:
                yield joined(held)
                held, rows = [], 0
            held.append((row["chunk"], row["n"], *read(row, width)))
            rows += row["n"]
            if rows >= most:
                yield joined(held)
                held, rows = [], 0
    if held:
        yield joined(held)


def joined(held):
    names, lengths, bins, labels = zip(*held)
    return list(zip(names, lengths)), np.concatenate(bins, axis=1), np.concatenate(labels)


def drawn_rows(seed: int, tree: int, chunks) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a block that are drawn for a tree, and how often."""
    times = np.concatenate([drawn(seed, tree, chunk, n) for chunk, n in chunks])
    hit = np.flatnonzero(times)
    return hit, times.take(hit)


def descended(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """The node of a level that each of some rows reaches; below a node without a split all go left.

    Nodes are numbered 1, 2 and 3, 4 to 7 and so on by level.
    """
    flat, at = bins.ravel(), np.ones(len(rows), np.intp)
    inner = feature >= 0
    start, last = np.where(inner, feature, 0).astype(np.intp) * bins.shape[1], np.where(inner, cut, 255).astype(np.uint8)
    for _ in range(level):
        right = flat.take(start.take(at) + rows) > last.take(at)
        at = 2 * at + right
    return at


def reached(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """The position in a level of the node that each row reaches; below a node without a split all go left.

    Every split of the levels above is compared for all rows, byte by byte, which for few levels is less than looking up each row's own.
    """
    at = np.zeros(bins.shape[1], np.min_scalar_type((1 << level) - 1))
    for above in range(level):
        right = np.zeros(bins.shape[1], bool)
        for i in range(1 << above):
            node = (1 << above) + i
            if feature[node] >= 0:
                right |= (bins[feature[node]] > cut[node]) & (at == i)
        at = 2 * at + right
    return at


def found_nodes(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """As ``descended``, by whatever way is shorter."""
    if level >= LOOKED_UP:
        return descended(bins, rows, feature, cut, level)
    return reached(bins, feature, cut, level).take(rows).astype(np.intp) + (1 << level)


def places(nodes: np.ndarray, level: int) -> np.ndarray:
    """By node of a level, the position of the node or of its ancestor among some nodes without a split, else -1."""
    found = np.full(2 << level, -1, np.int32)
    for i, node in enumerate(nodes.tolist()):
        found[node << (level + 1 - node.bit_length())] = i
    return found


def packs(sizes) -> list[list[int]]:
    """Features in groups whose bins combine to at most ``PACKED`` cells."""
    groups: list[list[int]] = []
    for j in sorted(range(len(sizes)), key=lambda j: -sizes[j]):
        for group in groups:
            if np.prod([sizes[i] for i in group]) * sizes[j] <= PACKED:
                group.append(j)
                break
        else:
            groups.append([j])
    return groups


def codes(bins: np.ndarray, sizes, groups: list[list[int]]) -> list[np.ndarray]:
    """The cell of each row by group, in as few bytes as it needs."""
    out = []
    for group in groups:
        code = bins[group[0]].astype(np.intp)
        for j in group[1:]:
            code = code * sizes[j] + bins[j]
        out.append(code.astype(np.min_scalar_type(int(np.prod([sizes[j] for j in group])) - 1)))
    return out


def cells(place: np.ndarray, nodes: int, coded: list[np.ndarray], sizes, groups, weight: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Weights and weighted labels by node and cell, of each group."""
    times, out = weight * label, []
    for code, group in zip(coded, groups):
        width = int(np.prod([sizes[j] for j in group]))
        key = place * width + code
        out.append(np.stack([np.bincount(key, w, nodes * width).reshape(nodes, width) for w in (weight, times)]))
    return out


def histograms(counted: list[np.ndarray], sizes, groups) -> np.ndarray:
    """Sums, such as weights and weighted labels, by node, feature and bin, from those of the cells."""
    kinds, nodes = counted[0].shape[:2]
    out = np.zeros((kinds, nodes, len(sizes), BINS))
    for cell, group in zip(counted, groups):
        cube = cell.reshape(kinds, nodes, *[sizes[j] for j in group])
        for i, j in enumerate(group):
            out[:, :, j, : sizes[j]] = cube.sum(axis=tuple(2 + k for k in range(len(group)) if k != i))
    return out


def splits(sums: np.ndarray, allowed: np.ndarray | None):
    """Gain, feature and bin of each node's best split by the fall of the variance; gain 0 if there is none."""
    left = np.cumsum(sums, axis=3)[..., :-1]
    whole = sums[:, :, :1].sum(axis=3, keepdims=True)
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        gain = np.where((left[0] >= 1) & (right[0] >= 1), gain / whole[0], 0)
    if allowed is not None:
        gain = np.where(allowed[:, :, None], gain, 0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    gains = flat[np.arange(len(flat)), best]
    gains = np.where(gains > 1e-12, gains, 0)
    return gains, best // (BINS - 1), best % (BINS - 1)


def subset(seed: int, tree: int, nodes, width: int, most: int) -> np.ndarray | None:
    """Which features each node may be split by."""
    if most >= width:
        return None
    allowed = np.zeros((len(nodes), width), bool)
    for i, node in enumerate(nodes):
        allowed[i, np.random.Generator(np.random.PCG64([seed + 1, tree, int(node)])).permutation(width)[:most]] = True
    return allowed


def summed_histograms(batches, trees: dict, wanted: dict, level: int, seed: int, sizes):
    """Histograms of the wanted nodes of some trees, all of one level, over the rows of one task: a row per node."""
    totals, squares, name, groups = {}, {}, None, packs(sizes)
    at_place = {tree: places(nodes, level) for tree, nodes in wanted.items()}
    for chunks, bins, label in blocks(batches, len(sizes), BLOCK_ROWS):
        name = chunks[0][0] if name is None else name
        coded = codes(bins, sizes, groups)
        for tree, nodes in wanted.items():
            hit, weight = drawn_rows(seed, tree, chunks)
            place = at_place[tree].take(found_nodes(bins, hit, *trees[tree], level))
            if (place < 0).any():
                some = np.flatnonzero(place >= 0)
                hit, weight, place = hit.take(some), weight.take(some), place.take(some)
            y, weight, place = label.take(hit), weight.astype(np.float64), place.astype(np.intp)
            found = cells(place, len(nodes), [code.take(hit) for code in coded], sizes, groups, weight, y)
            more = np.bincount(place, weight * y * y, len(nodes))
            if tree in totals:
                for whole, part in zip(totals[tree], found):
                    whole += part
                squares[tree] += more
            else:
                totals[tree], squares[tree] = found, more
    for tree, nodes in wanted.items():
        if tree in totals:
            sums = histograms(totals.pop(tree), sizes, groups)
            yield pa.RecordBatch.from_pylist([
                {"tree": tree, "node": int(node), "chunk": name, "squares": float(squares[tree][i]), "sums": sums[:, i].tobytes()}
                for i, node in enumerate(nodes)
            ], schema=fields(SUMS))


def split_node(group: pa.Table, seed: int, width: int, most: int) -> pa.Table:
    """The best split of one large node from the sums of all tasks."""
    tree, node = group["tree"][0].as_py(), group["node"][0].as_py()
    group = group.sort_by("chunk")  # sums do not depend on which task ended first
    sums = sum(np.frombuffer(x, np.float64) for x in group["sums"].to_pylist()).reshape(2, 1, width, BINS)
    gain, feature, cut = splits(sums, subset(seed, tree, [node], width, most))
    n, total = sums[0, 0, 0].sum(), sums[1, 0, 0].sum()
    return node_table(tree, [node], [n], [total], [sum(group["squares"].to_pylist())], gain, feature, cut)


def node_table(tree, node, n, total, squares, gain, feature, cut) -> pa.Table:
    inner = np.asarray(gain) > 0
    columns = [np.full(len(node), tree), node, n, total, squares, gain, np.where(inner, feature, -1), np.where(inner, cut, -1)]
    schema = fields(NODES)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def small_labels(labels: np.ndarray) -> bytes:
    """Labels in 1, 4 or 8 bytes each: whole numbers, hundredths or as they are, whatever gives them back exactly."""
    if len(labels) and not np.signbit(labels).any():
        if labels.max() <= 255 and (np.floor(labels) == labels).all():
            return labels.astype(np.uint8).tobytes()
        if labels.max() < 2e7:
            hundredths = np.rint(labels * 100)
            if (hundredths / 100 == labels).all():
                return hundredths.astype(np.int32).tobytes()
    return labels.tobytes()


def label_numbers(stored: bytes, n: int) -> np.ndarray:
    return np.frombuffer(stored, {1: np.uint8, 4: np.int32, 8: np.float64}[len(stored) // n])


def whole_labels(stored: bytes, n: int) -> np.ndarray:
    numbers = label_numbers(stored, n)
    labels = numbers.astype(np.float64)
    return labels / 100 if numbers.dtype == np.int32 else labels


def sent_groups(sizes) -> list[list[int]]:
    """Features whose bins are sent as one number of 16 bits."""
    groups, cell_count = [[]], 1
    for j, size in enumerate(sizes):
        if cell_count * size > 1 << 16:
            groups.append([])
            cell_count = 1
        groups[-1].append(j)
        cell_count *= size
    return groups


def unpacked(numbers: np.ndarray, sizes, groups) -> np.ndarray:
    """Bin numbers by feature from the numbers they were sent as."""
    return from_cells(list(numbers), sizes, groups)


def sent_rows(batches, trees: dict, small: dict, seed: int, sizes):
    """The rows of the nodes that one task each will grow, by tree and node."""
    groups = sent_groups(sizes)
    levels = {tree: int(nodes.max()).bit_length() - 1 for tree, nodes in small.items()}
    at_place = {tree: places(nodes, levels[tree]) for tree, nodes in small.items()}
    for chunks, bins, label in blocks(batches, len(sizes), SENT_ROWS):
        numbers, label = np.stack([code.astype(np.uint16) for code in codes(bins, sizes, groups)]), label_numbers(small_labels(label), len(label))
        for tree, nodes in small.items():
            hit, weight = drawn_rows(seed, tree, chunks)
            place = at_place[tree].take(found_nodes(bins, hit, *trees[tree], levels[tree]))
            order = np.argsort(place.astype(np.int16) if len(nodes) < 1 << 15 else place, kind="stable")
            order = order[np.searchsorted(place, 0, sorter=order) :]  # the others have their leaf already
            hit, weight, place = hit.take(order), weight.take(order).astype(np.uint8), place.take(order)
            mine, y = numbers.take(hit, axis=1), label.take(hit)
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            out = []
            for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(hit)]):
                out.append({
                    "tree": tree, "node": int(nodes[place[lo]]), "chunk": chunks[0][0], "n": hi - lo,
                    "bins": mine[:, lo:hi].tobytes(), "labels": y[lo:hi].tobytes(), "weights": weight[lo:hi].tobytes(),
                })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=fields(SENT))


def grown(group: pa.Table, seed: int, sizes, most: int, depth: int) -> pa.Table:
    """The branch below one small node; a node's rows are in this task.

    Nodes of more than ``LARGE_ROWS`` rows are split one by one, their rows kept together; the branches below them level by level.
    """
    tree, root = group["tree"][0].as_py(), group["node"][0].as_py()
    rows = group.sort_by("chunk").to_pylist()
    sent = sent_groups(sizes)
    bins = unpacked(np.concatenate([np.frombuffer(r["bins"], np.uint16).reshape(len(sent), r["n"]) for r in rows], axis=1), sizes, sent)
    label = np.concatenate([whole_labels(r["labels"], r["n"]) for r in rows])
    weight = np.concatenate([np.frombuffer(r["weights"], np.uint8) for r in rows])
    del rows
    grow = lambda *branch: level_by_level(tree, *branch, seed, sizes, most, depth)
    if len(label) <= LARGE_ROWS:
        # each feature by itself, summed in the order of the rows: rounding decides between equal cuts as it always did
        return grow(root, bins, label, weight, [[j] for j in range(len(sizes))])
    groups = packs(sizes)
    waiting, out = [(root, codes(bins, sizes, groups), label, weight, None)], []
    del bins, label, weight
    while waiting:
        node, coded, label, weight, counted = waiting.pop()
        if len(label) <= LARGE_ROWS or node.bit_length() > depth:
            out.append(grow(node, from_cells(coded, sizes, groups), label, weight, groups))
            continue
        if counted is None:
            counted = node_cells(coded, label, weight, sizes, groups)
        gain, feature, cut = splits(histograms(counted, sizes, groups), subset(seed, tree, [node], len(sizes), most))
        times = weight * label
        out.append(node_table(tree, [node], [weight.sum(dtype=np.float64)], [times.sum()], [(times * label).sum()], gain, feature, cut))
        if not gain[0]:
            continue
        at = next(i for i, group in enumerate(groups) if feature[0] in group)
        every = cell_bins(sizes, groups[at])[feature[0]]
        right = (every > cut[0]).take(coded[at])
        sides = [np.flatnonzero(~right), np.flatnonzero(right)]
        children = [[2 * node + i, [code.take(side) for code in coded], label.take(side), weight.take(side), None] for i, side in enumerate(sides)]
        few, many = sorted(children, key=lambda child: len(child[2]))
        if len(many[2]) > LARGE_ROWS:  # what the larger child has is what the smaller one leaves over
            few[4] = node_cells(*few[1:4], sizes, groups)
            many[4] = [whole - part for whole, part in zip(counted, few[4])]
        waiting += children
        del coded, label, weight, right, sides, children, few, many, times
    return pa.concat_tables(out)


def cell_bins(sizes, group: list[int]) -> dict[int, np.ndarray]:
    """By feature of a group, the bin that each cell stands for."""
    every, out = np.arange(int(np.prod([sizes[j] for j in group]))), {}
    for j in reversed(group):
        out[j] = (every % sizes[j]).astype(np.uint8)
        every //= sizes[j]
    return out


def from_cells(coded: list[np.ndarray], sizes, groups: list[list[int]]) -> np.ndarray:
    """Bin numbers by feature from the cells of groups."""
    out = np.empty((len(sizes), len(coded[0])), np.uint8)
    for code, group in zip(coded, groups):
        for j, every in cell_bins(sizes, group).items():
            out[j] = every.take(code)
    return out


def node_cells(coded: list[np.ndarray], label: np.ndarray, weight: np.ndarray, sizes, groups) -> list[np.ndarray]:
    """As ``cells``, of rows that are all in one node."""
    weight = weight.astype(np.float64)
    return cells(np.zeros(1, np.intp), 1, coded, sizes, groups, weight, label)


def level_by_level(
    tree: int, root: int, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, groups: list[list[int]], seed: int, sizes, most: int, depth: int
) -> pa.Table:
    """The branch below a node from its rows, all nodes of a level together; features in groups as long as nodes have many rows."""
    width = len(sizes)
    weight, coded = weight.astype(np.float64), codes(bins, sizes, groups)
    flat, row = bins.ravel(), np.arange(len(label))
    nodes, place, out = np.array([root]), np.zeros(len(label), np.intp), []
    for level in range(root.bit_length() - 1, depth + 1):
        n = np.bincount(place, weight, len(nodes))
        total = np.bincount(place, weight * label, len(nodes))
        squares = np.bincount(place, weight * label * label, len(nodes))
        if level == depth:
            gain = feature = cut = np.zeros(len(nodes), np.int64)
        else:
            if len(groups) < width and len(label) < CROWDED_ROWS * len(nodes):
                groups, coded = [[j] for j in range(width)], [numbers.take(row) for numbers in bins]
            counted = cells(place, len(nodes), coded, sizes, groups, weight, label)
            gain, feature, cut = splits(histograms(counted, sizes, groups), subset(seed, tree, nodes, width, most))
        out.append(node_table(tree, nodes, n, total, squares, gain.astype(np.float64), feature, cut))
        inner = gain > 0
        if not inner.any():
            break
        if not inner.all():
            stay = np.flatnonzero(inner.take(place))
            row, label, weight, place = row.take(stay), label.take(stay), weight.take(stay), place.take(stay)
            coded = [code.take(stay) for code in coded]
        right = flat.take((feature * bins.shape[1]).take(place) + row) > cut.take(place)
        rank = np.cumsum(inner) - 1
        place = 2 * rank.take(place) + right
        nodes = np.stack([2 * nodes[inner], 2 * nodes[inner] + 1], axis=1).ravel()
    return pa.concat_tables(out)


def forest_nodes(
    chunks: DataFrame, width: int, trees: int, depth: int, most: int, seed: int, local_rows: int, sizes: list[int] | None = None
) -> DataFrame:
    """All nodes of all trees: large ones level by level over all rows, then the branches of the small ones.

    ``sizes`` are the bins of each feature, at most ``BINS``.
    """
    sizes = [BINS] * width if sizes is None else sizes
    feature = {t: np.full(2 << depth, -1, np.int64) for t in range(trees)}
    cut = {t: np.full(2 << depth, -1, np.int64) for t in range(trees)}
    rows = chunks.agg(F.sum("n")).first()[0]
    open_nodes = [(t, 1) for t in range(trees)] if rows > local_rows else []
    small = {t: [] if open_nodes else [1] for t in range(trees)}
    large = []
    for level in range(depth + 1):
        here, open_nodes = open_nodes, []
        for first in range(0, len(here), PASS_NODES):
            wanted: dict = {}
            for tree, node in sorted(here[first : first + PASS_NODES]):
                wanted.setdefault(tree, []).append(node)
            wanted = {t: np.array(nodes) for t, nodes in wanted.items()}
            known = {t: (feature[t][: 2 << level], cut[t][: 2 << level]) for t in wanted}
            found = (
                chunks.mapInArrow(
                    lambda b, k=known, w=wanted, at=level: summed_histograms(b, k, w, at, seed, sizes),
                    SUMS,
                )
                .groupBy("tree", "node")
                .applyInArrow(lambda group: split_node(group, seed, width, most), NODES)
            ).toArrow().to_pylist()  # a row per node of this pass
            for r in found:
                if level == depth:
                    r.update(gain=0.0, feature=-1, bin=-1)
                large.append(tuple(r.values()))
                if r["feature"] < 0:
                    continue
                feature[r["tree"]][r["node"]], cut[r["tree"]][r["node"]] = r["feature"], r["bin"]
                for child in (2 * r["node"], 2 * r["node"] + 1):
                    # a child has fewer rows than its parent; what it has is known once it is split or sent
                    if r["n"] > 2 * local_rows:
                        open_nodes.append((r["tree"], child))
                    else:
                        small[r["tree"]].append(child)
    small = {t: np.array(nodes) for t, nodes in small.items() if nodes}
    found = chunks.sparkSession.createDataFrame(large, NODES)
    at_once = max(1, BATCH_ROWS // rows)
    for first in range(0, len(small), at_once):
        batch = {t: small[t] for t in sorted(small)[first : first + at_once]}
        known = {t: (feature[t], cut[t]) for t in batch}
        branches = (
            chunks.mapInArrow(lambda b, k=known, s=batch: sent_rows(b, k, s, seed, sizes), SENT)
            .groupBy("tree", "node")
            .applyInArrow(lambda group: grown(group, seed, sizes, most, depth), NODES)
        )
        found = found.unionByName(settled(branches))
    return found


def numbered(group: pa.Table, cuts: list[np.ndarray], classes: bool) -> pa.Table:
    """One tree in the layout of Spark's stored models; at most 2 ** (depth + 1) nodes."""
    group = group.sort_by("node")
    node, n, total, squares, gain, feature, place = (
        np.asarray(group[c]) for c in ("node", "n", "total", "squares", "gain", "feature", "bin")
    )
    inner, p = feature >= 0, total / n
    child = np.where(inner, np.searchsorted(node, 2 * node), -1)
    if classes:
        said, spread, gain = (p > 0.5).astype(np.float64), 2 * p * (1 - p), 2 * gain
        stats = np.stack([n - total, total], axis=1)
    else:
        said, spread = p, np.maximum(squares / n - p * p, 0)
        stats = np.stack([n, total, squares], axis=1)
    every = np.concatenate([[0], np.cumsum(list(map(len, cuts)))])
    values = np.concatenate(cuts)[(every[feature] + place)[inner]]
    whole = lambda x: pa.array(x, pa.int32())
    split = pa.StructArray.from_arrays([
        whole(feature), pa.ListArray.from_arrays(whole(np.concatenate(([0], np.cumsum(inner)))), pa.array(values)),
        whole(np.full(len(node), -1)),
    ], fields=list(SPLIT))
    nodes = pa.StructArray.from_arrays([
        whole(np.arange(len(node))), pa.array(said), pa.array(spread),
        pa.ListArray.from_arrays(whole(np.arange(len(node) + 1) * stats.shape[1]), pa.array(stats.ravel())),
        pa.array(np.rint(n).astype(np.int64)), pa.array(np.where(inner, gain, -1.0)),
        whole(child), whole(np.where(inner, child + 1, -1)), split,
    ], fields=list(NODE))
    return pa.table({"treeID": whole(np.asarray(group["tree"])), "nodeData": nodes})


class _Forest(Estimator):
    """Fits trees on Poisson draws of the rows; the best cut of up to 32 bins by the fall of the variance.

    For labels 0 and 1 that is the cut of the Gini index, which is twice the variance. ``most`` names how many
    features each node may look at. Rows must have no missing value. The outcome is Spark's model class, so it is
    applied, stored and read like any other.
    """

    classes = False

    def __init__(self, labelCol: str, numTrees: int, maxDepth: int, seed: int, most: int | None = None, localRows: int = LOCAL_ROWS):
        super().__init__()
        self.label, self.trees, self.depth, self.draws, self.most, self.local_rows = labelCol, numTrees, maxDepth, seed, most, localRows

    def _template(self):
        """A model of Spark's own with as many trees, whose nodes are then replaced."""
        raise NotImplementedError

    def _fit(self, dataset: DataFrame):
        spark = dataset.sparkSession
        rows = dataset.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"))
        width = rows.select(F.size("x").alias("w")).first()
        if width is None:
            raise ValueError("no rows to learn from")
        width = width["w"]
        cuts = thresholds(rows, width)
        # a chunk is drawn from by its name, so any task may have it; spread, all cores share every pass
        chunks = rows.mapInArrow(lambda b: chunked(b, cuts), CHUNKS)
        chunks = settled(chunks.repartitionByRange(spark.sparkContext.defaultParallelism, "chunk").sortWithinPartitions("chunk"))
        sizes = [len(c) + 1 for c in cuts]
        nodes = forest_nodes(chunks, width, self.trees, self.depth, self.most or width, self.draws, self.local_rows, sizes)
        classes = self.classes
        layout = nodes.groupBy("tree").applyInArrow(lambda group: numbered(group, cuts, classes), STORED_NODE)
        estimator, kind = self._template()
        tiny = spark.createDataFrame([(Vectors.dense([float(i)] * width), float(i)) for i in range(2)], ["features", self.label])
        path = scratch_path(spark, "forest")
        estimator.fit(tiny).write().save(path)
        layout.write.mode("overwrite").parquet(f"{path}/data")
        model = kind.load(path)
        model._trees_as_arrays = trees_of(spark.read.parquet(f"{path}/data"), kind, [1.0] * self.trees)
        return model


class ForestRegressor(_Forest):
    def _template(self):
        return RandomForestRegressor(labelCol=self.label, numTrees=self.trees, maxDepth=self.depth, seed=self.draws), RandomForestRegressionModel


class ForestClassifier(_Forest):
    """Labels 0 and 1; a tree votes with its leaf's shares, as Spark's model does."""

    classes = True

    def _template(self):
        return RandomForestClassifier(labelCol=self.label, numTrees=self.trees, maxDepth=self.depth, seed=self.draws), RandomForestClassificationModel
