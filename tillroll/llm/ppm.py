"""Prediction by partial matching: byte contexts with escapes and symbol exclusion.

Documents are cut into chunks. Each chunk asks once for every distinct word and byte run it holds;
Spark sums the training counts of all chunks by key, turns them into a context trie, and sends each
chunk the numbers it asked for. No task holds the whole vocabulary or the whole trie.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import blob, chunked, parts_for, text_bytes, utf8
from tillroll.llm.words import LOWER, mixed, words
from tillroll.operators.settle import scratch_path, settled

ORDER = 4  # bytes of context
MARK = 0xFF  # before and after a text; no UTF-8 text holds this byte
SYMBOLS = 256
HALF = 0.5  # of a count, that each symbol of a context gives to symbols not yet seen in it
CHUNK_BYTES = 4_000_000  # text that asks for each of its distinct keys once
PART_BYTES = 16_000_000  # text whose distinct keys one part counts
DENSE = 1 << 23  # entries of a direct lookup table; beyond, keys are sorted instead

DOC, WORD, RUN = 0, 1, 2
LAYOUT = "batch long, part long, train_docs long, keys binary, counts binary, kind int"
FIELDS = pa.schema([
    ("batch", pa.int64()), ("part", pa.int64()), ("train_docs", pa.int64()),
    ("keys", pa.binary()), ("counts", pa.binary()), ("kind", pa.int32()),
])


def packed(batch: pa.RecordBatch) -> bytes:
    """The rows of a chunk as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


def steps(ascending: np.ndarray) -> bytes:
    """Ascending keys as their differences, which are mostly small and so compress."""
    return blob(np.diff(ascending, prepend=np.uint64(0)))


def from_steps(value: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(value, np.uint64), dtype=np.uint64)


def byte_runs(texts, order: int):
    """Of every byte and end mark: the number of its run of order + 1 bytes; the runs, ascending;
    and the places that each text has."""
    body, bounds = utf8(texts)
    sizes = np.diff(bounds)
    line = np.full(len(body) + (order + 1) * len(sizes), MARK, np.uint8)
    # a run starts at each place whose last byte belongs to the same text or is its end mark
    starts = np.ones(len(line), bool)
    for i, (low, size) in enumerate(zip(bounds.tolist(), sizes.tolist())):
        first = low + i * (order + 1)
        line[first + order : first + order + size] = LOWER[body[low : low + size]]
        starts[first + size + 1 : first + size + order + 1] = False
    begins = np.flatnonzero(starts).astype(np.int32 if len(line) < 1 << 31 else np.int64)
    places = np.concatenate(([0], np.cumsum(sizes + 1)))
    present = np.flatnonzero(np.bincount(line, minlength=SYMBOLS))
    narrow = np.zeros(SYMBOLS, np.uint8)
    narrow[present] = np.arange(len(present))
    symbols = narrow[line]
    del line, starts
    ids, runs = symbols[begins].astype(np.int32), present.astype(np.uint64)
    for _ in range(order):
        begins += 1
        kind = np.int32 if len(runs) * len(present) < 1 << 31 else np.int64
        ids = ids.astype(kind)
        ids *= kind(len(present))
        ids += symbols[begins]
        ids, used = renumbered(ids, len(runs) * len(present))
        runs = (runs[used // len(present)] << np.uint64(8)) | present[used % len(present)].astype(np.uint64)
    ids, used = renumbered(ids, len(runs))
    return ids, runs[used], places


def renumbered(ids: np.ndarray, size: int):
    """The ids as ranks among those that occur, and those that occur, ascending."""
    if size > DENSE:
        order = np.argsort(ids, kind="stable")
        ranked = ids[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ids) else np.empty(0, bool)
        out = np.empty(len(ids), np.int32)
        out[order] = np.cumsum(new) - 1
        return out, ranked[new].astype(np.int64)
    seen = np.zeros(size, bool)
    seen[ids] = True
    used = np.flatnonzero(seen)
    rank = np.zeros(size, np.int32)
    rank[used] = np.arange(len(used))
    return rank[ids], used


def word_ids(found):
    """Of every word its number among the distinct hashes, and those, ascending."""
    order = np.argsort(found.hashes)
    ranked = found.hashes[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, bool)
    ids = np.empty(len(ranked), np.int64)
    ids[order] = np.cumsum(new) - 1
    return ids, ranked[new]


def part_order(keys: np.ndarray, parts: int):
    """The part of each key, and the order of the keys by part."""
    part = (mixed(keys) % np.uint64(parts)).astype(np.int64)
    return part, np.argsort(part, kind="stable")


def asked(batches, parts: int, order: int):
    """Of every chunk: its documents, and its distinct words and byte runs with training counts."""
    for batch in chunked(batches, limit=CHUNK_BYTES):
        name = int.from_bytes(os.urandom(8), "big") >> 1
        texts = batch.column(2)
        learns = ~np.asarray(batch.column(1), bool)
        row = {"batch": name, "train_docs": int(learns.sum()), "kind": DOC, "keys": packed(batch)}
        yield pa.RecordBatch.from_pylist([row], schema=FIELDS)
        found = words(texts, lower=True)
        of_words, hashes = word_ids(found)
        of_runs, runs, places = byte_runs(texts, order)
        for kind, of, keys, bounds in ((WORD, of_words, hashes, found.bounds), (RUN, of_runs, runs, places)):
            counted = np.bincount(of[np.repeat(learns, np.diff(bounds))], minlength=len(keys))
            part, by = part_order(keys, parts)
            cuts = np.searchsorted(part[by], np.arange(parts + 1))
            rows = [
                {"batch": name, "part": p, "kind": kind, "keys": steps(keys[by[lo:hi]]), "counts": blob(counted[by[lo:hi]].astype(np.int32))}
                for p, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo
            ]
            for lo in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[lo : lo + 64], schema=FIELDS)


def blobs(column: pa.ChunkedArray):
    """The values of a binary column, none of them copied."""
    for value in column:
        yield value.as_buffer()


def all_keys(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all requests on end, and where each request ends."""
    ends = np.cumsum([len(x) // 8 for x in map(memoryview, blobs(column))])
    keys = np.empty(int(ends[-1]), np.uint64)
    for end, value in zip(ends.tolist(), blobs(column)):
        steps = np.frombuffer(value, np.uint64)
        np.cumsum(steps, dtype=np.uint64, out=keys[end - len(steps) : end])
    return keys, ends


def all_counts(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.int32) for x in blobs(column)])


def summed(group: pa.Table):
    """Distinct keys of a part, ascending, their counts, and where each request has its keys."""
    requests, ends = all_keys(group["keys"])
    keys, inverse = word_ids_of(requests)
    total = np.bincount(inverse, weights=all_counts(group["counts"]), minlength=len(keys)).astype(np.int64)
    return keys, total, np.split(inverse, ends[:-1])


def word_ids_of(values: np.ndarray):
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    inverse = np.empty(len(values), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ranked[new], inverse


def word_counts(group: pa.Table) -> pa.Table:
    """To each request the counts of its words; the first also carries the part's totals."""
    _, total, places = summed(group)
    n = len(places)
    types, tokens = np.zeros(n, np.int64), np.zeros(n, np.int64)
    types[0], tokens[0] = np.count_nonzero(total), total.sum()
    return pa.table({
        "batch": group["batch"], "part": group["part"],
        "values": pa.array([blob(total[p].astype(np.float64)) for p in places], pa.binary()),
        "types": types, "tokens": tokens,
    })


def run_counts(group: pa.Table) -> pa.Table:
    part = group["part"][0].as_py()
    keys, _ = all_keys(group["keys"])
    order = np.argsort(keys)
    keys = keys[order]
    counts = all_counts(group["counts"])[order]
    del order
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    total = np.add.reduceat(counts, starts, dtype=np.int64)
    return pa.table({
        "part": np.full(len(starts), part, np.int64), "run": keys[starts].view(np.int64), "c": total,
    })


def run_scores(requests: pa.Table, scored: pa.Table) -> pa.Table:
    runs = np.asarray(scored["run"], np.int64).view(np.uint64)
    order = np.argsort(runs)
    runs, values = runs[order], np.asarray(scored["score"], np.float64)[order]
    del order
    found = (blob(values[np.searchsorted(runs, from_steps(x))]) for x in blobs(requests["keys"]))
    return pa.table({"batch": requests["batch"], "part": requests["part"], "values": pa.array(found, pa.binary())})


def low_bytes(run: str, n: int) -> Column:
    return F.col(run).bitwiseAND(F.lit((1 << (8 * n)) - 1))


def trie_scores(runs: DataFrame, order: int) -> DataFrame:
    """part, run and log10 of the probability of the run's last byte after the others.

    ``runs`` has every run asked for, with its training count c (0 if unseen). Level k holds runs of
    k bytes of context and one symbol. Escapes follow method D: of a context's total count, half for
    each different symbol goes to "something new", and that half is taken from the symbol. After an
    escape the symbols of the longer context are excluded from the counts of the shorter one. Of a run at level k, ``after`` is the log
    probability of its symbol once the context has been left, ``score`` that of the whole search
    from this context down; both need only the level below, so levels are built upwards.
    """
    counts = {order: runs.select("run", "c")}
    for k in range(order - 1, -1, -1):
        shorter = counts[k + 1].groupBy(low_bytes("run", k + 1).alias("run")).agg(F.sum("c").alias("c"))
        counts[k] = settled(shorter)
    level = None
    for k in range(order + 1):
        now = counts[k].withColumn("context", F.shiftrightunsigned("run", 8))
        if level is None:
            now = now.withColumn("low_c", F.lit(0).cast("long"))
        else:
            below = level.select(
                F.col("run").alias("low_run"), F.col("c").alias("low_c"), F.col("total").alias("low_total"),
                F.col("kinds").alias("low_kinds"), F.col("score").alias("low_score"), F.col("after").alias("low_after"),
            )
            now = now.join(below, low_bytes("run", k) == F.col("low_run"))
        same = Window.partitionBy("context")
        seen = F.col("c") > 0
        now = (
            now.withColumn("total", F.sum("c").over(same))
            .withColumn("kinds", F.sum(seen.cast("long")).over(same))
            .withColumn("excluded", F.sum(F.when(seen, F.col("low_c")).otherwise(0)).over(same))
        )
        if level is None:
            after = -F.log(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1)).cast("double"))
            unknown = F.lit(-float(np.log(SYMBOLS)))
        else:
            left = (F.col("low_total") - F.col("excluded")).cast("double")
            new = (F.col("low_kinds") - F.col("kinds")).cast("double")
            after = (
                F.when(F.col("kinds") == 0, F.col("low_score"))
                .when(F.col("low_c") > 0, F.log(F.try_divide(F.col("low_c") - HALF, left)))
                .when(new > 0, F.log(F.try_divide(new * HALF, left)) + F.col("low_after"))
                .otherwise(F.col("low_after"))
            )
            unknown = F.col("low_score")
        weight = F.col("total").cast("double")
        now = now.withColumn("after", after).withColumn(
            "score",
            F.when(F.col("kinds") == 0, unknown)
            .when(seen, F.log(F.try_divide(F.col("c") - HALF, weight)))
            .otherwise(F.log(F.try_divide(F.col("kinds") * HALF, weight)) + F.col("after")),
        )
        level = settled(now.select("run", "c", "total", "kinds", "score", "after"))
    return runs.select("part", "run").join(
        level.select("run", (F.col("score") / float(np.log(10))).alias("score")), "run"
    )


def scored_docs(docs: pa.Table, answers: pa.Table, order: int, train_docs: int) -> pa.Table:
    """Sums of one chunk's answers over its documents."""
    docs = unpacked(docs["keys"][0].as_py())
    texts = docs["text"].combine_chunks()

    def lookup(kind, keys):
        mine = answers.filter(pc.equal(answers["kind"], kind)).sort_by("part")
        values = np.concatenate([np.frombuffer(x, np.float64) for x in mine["values"].to_pylist()] or [np.empty(0)])
        out = np.empty(len(keys))
        _, by = part_order(keys, int(answers["parts"][0].as_py()))
        out[by] = values
        return out

    def sums(values, bounds):
        total = np.zeros(len(bounds) - 1)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            total[full] = np.add.reduceat(values, bounds[:-1][full])
        return total

    found = words(texts, lower=True)
    ids, hashes = word_ids(found)
    counts = lookup(WORD, hashes)[ids]
    run_ids, runs, places = byte_runs(texts, order)
    scores = lookup(RUN, runs)[run_ids]
    n_words = np.diff(found.bounds)
    return pa.table({
        "doc_id": docs["doc_id"], "held_out": docs["held"],
        "n_tokens": n_words + 1,
        "n_known": sums((counts > 0).astype(np.float64), found.bounds).astype(np.int64) + (train_docs > 0),
        "log_counts": sums(np.log10(counts + 0.5), found.bounds) + np.log10(train_docs + 0.5),
        "score": sums(scores, places),
    })


def log_probabilities(docs: DataFrame, held: Column, order: int = ORDER) -> DataFrame:
    """Every row of ``docs`` scored by what the rows learn where ``held`` is false.

    Texts are lower-cased (A-Z); a missing text is empty. score: log10 probability of the text's
    bytes and its end. base_score: log10 probability of its words and one end by smoothed counts,
    sum of log10((c + 0.5) / (N + 0.5 * (V + 1))). n_tokens counts words and the end, n_known those with c > 0;
    train_tokens is N. Words are runs other than ASCII white space, compared by 64-bit hashes. Repeated
    rows stay and count as often as they occur; with nothing to learn from, every byte has probability
    1/256; an empty table gives an empty result; other columns are left out.
    """
    spark = docs.sparkSession
    parts = parts_for(text_bytes(docs), PART_BYTES)
    path = scratch_path(spark, "asked")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held, F.lit(False)).alias("held"), "text")
    rows.mapInArrow(lambda batches: asked(batches, parts, order), LAYOUT).write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(LAYOUT).parquet(path)
    requests = stored.where(F.col("kind") == RUN).select("batch", "part", "keys", "counts")
    by_word = settled(
        stored.where(F.col("kind") == WORD).select("batch", "part", "keys", "counts")
        .groupBy("part")
        .applyInArrow(word_counts, "batch long, part long, values binary, types long, tokens long")
    )
    runs = settled(requests.groupBy("part").applyInArrow(run_counts, "part long, run long, c long"))
    scores = trie_scores(runs, order)
    by_run = (
        requests.select("batch", "part", "keys").groupBy("part")
        .cogroup(scores.groupBy("part"))
        .applyInArrow(run_scores, "batch long, part long, values binary")
    )
    answers = (
        by_word.select("batch", "part", "values", F.lit(WORD).alias("kind"))
        .unionByName(by_run.withColumn("kind", F.lit(RUN)))
        .withColumn("parts", F.lit(parts))
    )
    chunks = stored.where(F.col("kind") == DOC)
    train_docs = chunks.agg(F.sum("train_docs").alias("n")).first()["n"] or 0
    totals = by_word.agg(F.sum("types").alias("types"), F.sum("tokens").alias("tokens")).first()
    n = (totals["tokens"] or 0) + train_docs
    v = (totals["types"] or 0) + (train_docs > 0)
    found = chunks.select("batch", "keys").groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda left, right: scored_docs(left, right, order, train_docs),
        "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double",
    )
    base = F.col("log_counts") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score",
    )
