"""Exact top-k by inner product: global score histograms, refined until the k-th score is known."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
K = 10
BINS = 1024  # of one round; a round narrows the score range of a query by this factor
QUERY_BLOCK = 2048  # queries that one broadcast holds
EXACT = 2.0**53  # sums of whole numbers below this are exact in floating point


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and the vector as whole numbers, floor(scale * x); unusable vectors are left out."""
    x = F.col("embedding")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(usable).select(
        F.col("vec_id").cast("long"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width: shorter vectors end in zeros, which add nothing to a product."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    out = np.zeros((len(column), width), np.int64)
    flat = np.asarray(column.flatten(), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = columns < width
    out[rows[keep], columns[keep]] = flat[keep]
    return out


def scores(batches, queries: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
    """ids of a run of candidates, their scores by query, and which of them are the query itself."""
    for batch in batches:
        for low in range(0, len(batch), 2048):
            part = batch.slice(low, 2048)
            ids = np.asarray(part.column(0), np.int64)
            v = matrix(part.column(1), queries.shape[1])
            limit = float(np.abs(queries).max(initial=0)) * float(np.abs(v).max(initial=0)) * queries.shape[1]
            if limit < EXACT:
                found = (queries.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
            else:
                found = queries @ v.T
            yield ids, found, ids[None, :] == own[:, None]


def histograms(batches, queries, own, low, width, k):
    """Counts by query and bin from the top bin down to where this task alone has k scores.

    The k-th score of all tasks is no lower than that of one, so lower bins cannot matter.
    Scores above the range are counted in the top bin's place ``BINS``.
    """
    total = np.zeros((len(own), BINS + 1), np.int64)
    for _, found, same in scores(batches, queries, own):
        bins = np.minimum((found - low[:, None]) // width[:, None], BINS)
        use = ~same & (found >= low[:, None])
        rows = np.broadcast_to(np.arange(len(own))[:, None], found.shape)
        total += np.bincount(rows[use] * (BINS + 1) + bins[use], minlength=total.size).reshape(total.shape)
    above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
    rows, bins = np.nonzero((total > 0) & (above < k))
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(bins, pa.int64()), pa.array(total[rows, bins], pa.int64())], ["q", "bin", "n"]
    )


def finalists(batches, queries, own, bound, k):
    """Scores at or above each query's k-th score; of equal ones, k of the smallest ids per task."""
    held = None
    for ids, found, same in scores(batches, queries, own):
        rows, columns = np.nonzero((found >= bound[:, None]) & ~same)
        fresh = np.stack([rows, found[rows, columns], ids[columns]])
        held = fresh if held is None else np.concatenate([held, fresh], axis=1)
        order = np.lexsort((held[2], -held[1], held[0]))
        held = held[:, order]
        starts = np.searchsorted(held[0], held[0], side="left")
        held = held[:, np.arange(held.shape[1]) - starts < k]
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[held[0]], pa.int64()), pa.array(held[2], pa.int64()), pa.array(held[1], pa.int64())],
            ["query_id", "vec_id", "score"],
        )


def top_of_block(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, extent: int, k: int) -> DataFrame:
    """The best k of one block of queries; extent bounds every score's absolute value."""
    spark = rows.sparkSession
    low = np.full(len(ids), -extent, np.int64)
    width = np.full(len(ids), -(-(2 * extent + 1) // BINS), np.int64)
    given = spark.sparkContext.broadcast((queries, ids))
    while True:
        counts = (
            rows.mapInArrow(lambda b, lo=low, w=width: histograms(b, *given.value, lo, w, k), "q long, bin long, n long")
            .groupBy("q", "bin")
            .agg(F.sum("n").alias("n"))
            .withColumn("above", F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin"))) - F.col("n"))
            .where((F.col("above") < k) & (F.col("bin") < BINS))
            # the lowest of these bins holds the k-th score, or the last one if there are fewer
            .groupBy("q")
            .agg(F.min("bin").alias("bin"))
        )
        before = low.copy()
        for row in counts.collect():  # one row per query of the block
            low[row["q"]] = before[row["q"]] + row["bin"] * width[row["q"]]
        if width.max(initial=1) <= 1:
            break
        width = np.maximum(-(-width // BINS), 1)
    return rows.mapInArrow(
        lambda b: finalists(b, *given.value, low, k), "query_id long, vec_id long, score long"
    )


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """The k best of ``vectors`` for each row where ``is_query`` holds: query_id, rank, vec_id, score.

    Vectors are arrays in column embedding under vec_id; score is the inner product of
    floor(scale * x). Every other row is a candidate; ties go to the smaller vec_id. Queries are
    taken in blocks of a fixed size, and a block is all that is broadcast. Rounds of score
    histograms, summed over all tasks, narrow in on each query's k-th score; then only the scores
    that reach it are gathered.

    Vectors that are missing, have no id, or hold a missing or non-finite component take no part.
    Shorter vectors count as ending in zeros. Of rows with one vec_id the least vector is the
    query; none of them is a candidate for it, each is one for others. Scores must fit a long. An empty
    table, or one without queries, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = whole(vectors, scale)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    shape = rows.select(
        F.max(F.size("v")).alias("width"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("norm"),
    ).first()
    width, extent = shape["width"] or 0, int((shape["norm"] or 0.0) ** 2) + 1
    if extent >= 1 << 61:
        raise ValueError("scores do not fit a long")
    found, last = [], None
    while True:
        block = asked if last is None else asked.where(F.col("vec_id") > last)
        block = block.orderBy("vec_id").limit(QUERY_BLOCK).toArrow()
        if not block.num_rows:
            break
        ids = np.asarray(block["vec_id"], np.int64)
        last = int(ids[-1])
        queries = matrix(block["v"].combine_chunks(), width)
        found.append(top_of_block(rows, ids, queries, extent, k))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
