"""Vector code compression: product codes whose codebooks are refined over Hilbert-sorted flat blocks."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import blob
from tillroll.llm.topk import EXACT, matrix
from tillroll.operators.settle import settled

SCALE = 1024
PARTS = 4
ENTRIES = 256  # of each part's codebook
ROUNDS = 4
BLOCK = 256  # points that share one box
BITS = 4  # of each component that place a point on the Hilbert curve
LARGEST = 1 << 30  # components must be smaller, and squared distances must fit a long

BLOCK_LAYOUT = "part int, n int, places binary, points binary, low binary, high binary, total binary"
BLOCK_FIELDS = pa.schema([
    ("part", pa.int32()), ("n", pa.int32()), ("places", pa.binary()), ("points", pa.binary()),
    ("low", pa.binary()), ("high", pa.binary()), ("total", pa.binary()),
])


@dataclass(frozen=True)
class Compressed:
    """rows: vec_id, label, codes (array of entry numbers by part), error and label_error of every kept vector;
    books: the final entries, whole numbers by part, entry and position."""

    rows: DataFrame
    books: np.ndarray

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def kept(vectors: DataFrame, scale: int, label: str) -> DataFrame:
    """vec_id, label, the vector as whole numbers and a number of the row, of all usable vectors."""
    x = F.col("embedding")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(x.isNotNull()).where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"),
        F.monotonically_increasing_id().alias("place"),
    )


def extremes(batches, width: int):
    """Least and greatest of every component."""
    for batch in batches:
        if len(batch):
            v = matrix(batch.column(0), width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(v.min(axis=0)), pa.array(v.max(axis=0))], ["at", "low", "high"]
            )


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of points on a Hilbert curve, as bytes that sort like them; cells are whole numbers of ``bits`` bits.

    The axes are turned and flipped bit by bit from the top and then Gray-coded (Skilling, 2004).
    """
    x = [column.copy() for column in cells.T.astype(np.int64)]
    n = len(x)
    if not n:
        return np.zeros((len(cells), 0), np.uint8)
    top = 1 << (bits - 1)
    for q in (top >> i for i in range(bits - 1)):
        for i in range(n):
            flip = x[i] & q != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for q in (top >> i for i in range(bits - 1)):
        turn ^= np.where(x[-1] & q != 0, q - 1, 0)
    axes = np.stack([column ^ turn for column in x], axis=1)
    planes = (axes[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return np.packbits(planes.reshape(len(cells), -1).astype(np.uint8), axis=1)


def subvectors(batches, low: np.ndarray, high: np.ndarray, parts: int):
    """Every part of every vector with its place on that part's curve."""
    size = len(low) // parts
    span = (high - low + 1)[None, :]
    for batch in batches:
        if not len(batch):
            continue
        v = matrix(batch.column(1), len(low))
        cells = ((v - low[None, :]) << BITS) // span
        for part in range(parts):
            cut = slice(part * size, (part + 1) * size)
            keys = hilbert_keys(cells[:, cut], BITS)
            points = v[:, cut].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), part, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                 batch.column(0), pa.array([p.tobytes() for p in points], pa.binary())],
                ["part", "key", "place", "point"],
            )


def blocks(batches):
    """Runs of sorted points as flat blocks with their box and sum."""
    for batch in batches:
        parts = np.asarray(batch.column(0), np.int64)
        places = np.asarray(batch.column(2), np.int64)
        lengths = set(batch.column(3).to_pylist())
        if not len(batch):
            continue
        width = len(next(iter(lengths))) // 4
        points = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).reshape(len(parts), width)
        cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1])))
        rows = []
        for start, end in zip(cuts, [*cuts[1:], len(parts)]):
            for lo in range(start, end, BLOCK):
                hi = min(lo + BLOCK, end)
                p = points[lo:hi].astype(np.int64)
                rows.append({
                    "part": int(parts[lo]), "n": hi - lo, "places": blob(places[lo:hi]), "points": blob(points[lo:hi]),
                    "low": blob(p.min(axis=0)), "high": blob(p.max(axis=0)), "total": blob(p.sum(axis=0)),
                })
        yield pa.RecordBatch.from_pylist(rows, schema=BLOCK_FIELDS)


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to a point of the box, ascending.

    No point is nearer to an entry than the box is, and none is farther from its nearest entry than the least
    of the greatest distances between box and entries.
    """
    near = np.maximum(np.maximum(low - entries, entries - high), 0)
    far = np.maximum(np.abs(entries - low), np.abs(high - entries))
    return np.flatnonzero((near * near).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(points: np.ndarray, entries: np.ndarray, listed: np.ndarray, exact) -> tuple[np.ndarray, np.ndarray]:
    """Number of each point's nearest listed entry (ties: the first), and its squared distance.

    Whole numbers throughout; they are kept as doubles where no sum can leave the range in which those are exact.
    """
    p, e = points.astype(exact), entries[listed].astype(exact)
    apart = (e * e).sum(axis=1)[None, :] - 2 * (p @ e.T)
    best = apart.argmin(axis=1)
    distance = apart[np.arange(len(p)), best] + (p * p).sum(axis=1)
    return listed[best], distance.astype(np.int64)


def stored_blocks(batches, books: np.ndarray):
    """part, row, points, and the shortlist of every block."""
    for batch in batches:
        for row in batch.to_pylist():
            entries = books[row["part"]]
            low, high = (np.frombuffer(row[k], np.int64) for k in ("low", "high"))
            points = np.frombuffer(row["points"], np.int32).reshape(row["n"], len(low)).astype(np.int64)
            yield row["part"], row, points, entries, shortlist(low, high, entries)


def entry_sums(batches, books: np.ndarray, exact):
    """Points and sums by part and entry, of one task."""
    counts = np.zeros(books.shape[:2], np.int64)
    totals = np.zeros(books.shape, np.int64)
    for part, row, points, entries, listed in stored_blocks(batches, books):
        if len(listed) == 1:  # the whole block goes to one entry
            counts[part, listed[0]] += row["n"]
            totals[part, listed[0]] += np.frombuffer(row["total"], np.int64)
            continue
        code, _ = nearest(points, entries, listed, exact)
        counts[part] += np.bincount(code, minlength=len(entries))
        np.add.at(totals[part], code, points)
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
         pa.array(totals[part, entry].tolist(), pa.list_(pa.int64()))],
        ["part", "entry", "n", "total"],
    )


def assigned(batches, books: np.ndarray, exact):
    """Entry and squared distance of every part of every vector."""
    for part, row, points, entries, listed in stored_blocks(batches, books):
        code, distance = nearest(points, entries, listed, exact)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(row["places"], np.int64)), pa.array(np.full(len(code), part, np.int32)),
             pa.array(code.astype(np.int32)), pa.array(distance)],
            ["place", "part", "code", "error"],
        )


def seeds(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: parts of the vectors of the smallest ids; of rows with one id, the least vector."""
    ids = rows.select(F.col("vec_id").alias("id")).distinct().orderBy(F.asc_nulls_last("id")).limit(entries)
    first = rows.join(F.broadcast(ids), F.col("vec_id").eqNullSafe(F.col("id"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    found = first.orderBy(F.asc_nulls_last("vec_id")).select("v").toArrow()  # at most ``entries`` vectors
    whole = matrix(found["v"].combine_chunks(), width)
    return whole.reshape(len(whole), parts, width // parts).transpose(1, 0, 2).copy()


def compressed(
    vectors: DataFrame, label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Compressed:
    """Product codes of all usable ``vectors`` (vec_id, embedding and a label column).

    Components become floor(scale * x). Vectors are cut into ``parts`` equal parts, each with a codebook that starts from
    the smallest ids and is refined by ``rounds`` of assignment to the nearest entry (squared distance; ties to
    the lower number) and replacement by the floor of the mean; entries without points stay. label_error sums the
    errors of equal labels, missing ones together.

    Each part's subvectors are sorted along a Hilbert curve and stored as flat blocks with box and sum, once. A round
    takes from the boxes which entries can be nearest to a block; only these are compared with its points, and a block
    with one such entry is added as a whole. Tasks sum by entry, so a round moves at most parts * entries sums each.

    Vectors that are missing or hold a missing or non-finite component are left out. Shorter vectors count as
    ending in zeros, as do all where the width is no multiple of ``parts``. A missing vec_id counts as larger than any
    other; repeated rows each get a code. Components from 2**30 on, or distances that do not fit a long, raise an
    error. Other columns are left out; an empty table gives an empty result and empty books.
    """
    rows = settled(kept(vectors, scale, label))
    widest = rows.agg(F.max(F.size("v"))).first()[0]
    if widest is None:
        none = rows.select("vec_id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return Compressed(none.withColumn("label_error", F.col("error")), np.zeros((parts, 0, 0), np.int64))
    width = -(-widest // parts) * parts
    ends = rows.select("v").mapInArrow(lambda b: extremes(b, width), "at long, low long, high long")
    ends = ends.groupBy("at").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("at").collect()
    low, high = (np.array([row[k] for row in ends], np.int64) for k in ("low", "high"))
    largest = max([1, *map(abs, low.tolist()), *map(abs, high.tolist())])
    farthest = width // parts * 4 * largest**2
    if largest >= LARGEST or farthest >= 1 << 62:
        raise ValueError("components are too large for exact distances")
    exact = np.float64 if farthest < EXACT else np.int64
    books = seeds(rows, width, parts, entries)
    flat = (
        rows.select("place", "v")
        .mapInArrow(lambda b: subvectors(b, low, high, parts), "part int, key binary, place long, point binary")
        .repartitionByRange("part", "key", "place")
        .sortWithinPartitions("part", "key", "place")
    )
    flat = settled(flat.mapInArrow(blocks, BLOCK_LAYOUT))
    for _ in range(rounds):
        sums = (
            flat.mapInArrow(lambda b, given=books: entry_sums(b, given, exact), "part int, entry int, n long, total array<long>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width // parts)]).alias("total"))
        )
        after = books.copy()
        for row in sums.collect():  # at most parts * entries rows
            after[row["part"], row["entry"]] = np.array(row["total"], np.int64) // row["n"]
        books = after
    coded = flat.mapInArrow(lambda b: assigned(b, books, exact), "place long, part int, code int, error long")
    by_place = coded.groupBy("place").agg(
        F.array(*[F.max(F.when(F.col("part") == p, F.col("code"))) for p in range(parts)]).alias("codes"),
        F.sum("error").alias("error"),
    )
    done = settled(rows.select("place", "vec_id", "label").join(by_place, "place").drop("place"))
    sums = done.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return Compressed(done.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books)
