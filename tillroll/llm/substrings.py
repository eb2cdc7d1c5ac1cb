"""Substring de-duplication: rolling hashes of every word window, counted across documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import blob, chunked, parts_for, text_bytes, text_key
from tillroll.llm.words import STEP, WORD_POWERS, mixed, runs, words

WINDOW = 50
ANCHOR_WORDS = 3  # a window travels to the part that its smallest run of so many words names
PART_BYTES = 8_000_000  # text whose windows one part compares
CHUNK_BYTES = 2_000_000  # text whose windows are compared before they are sent
NO_ID = (1 << 63) - 1  # a missing doc_id counts as larger than any other

LOCAL, SENT = 0, 1


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int, anchor: int):
    """Of every window of ``size`` words: text number, first word, hash, and its anchor's hash."""
    n = np.maximum(np.diff(bounds) - size + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    if not len(doc):
        return doc, doc, np.empty(0, np.uint64), np.empty(0, np.uint64)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][doc]
    whole = runs(hashes, WORD_POWERS, at, at + size)
    starts = np.arange(len(hashes) - anchor + 1)
    low = mixed(runs(hashes, WORD_POWERS, starts, starts + anchor) ^ np.uint64(STEP))
    span, step = size - anchor + 1, 1  # least of span neighbours, by doubling
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[: len(low) - (span - step)], low[span - step :])
    return doc, at - bounds[:-1][doc], whole, low[at]


def merged(doc: np.ndarray, first: np.ndarray, size: int):
    """Windows sorted by text and first word, as maximal intervals of words (text, start, end)."""
    if not len(doc):
        return doc, first, first
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (first[1:] > first[:-1] + size)))
    opens = np.flatnonzero(new)
    closes = np.concatenate((opens[1:], [len(doc)])) - 1
    return doc[opens], first[opens], first[closes] + size


def first_of(ids: np.ndarray, hashes: np.ndarray):
    """For each window: is its document the smallest that holds its hash, and the order used."""
    order = np.lexsort((ids, hashes))
    h, d = hashes[order], ids[order]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.empty(len(ids), bool)
    later[order] = d > least
    return later


def sent_windows(batches, parts: int, size: int):
    """Windows by part: each hash of a chunk once, with the rest already known to be repeated."""
    names = ["part", "kind", "ids", "keys", "doc", "first", "count", "hashes"]
    for batch in chunked(batches, limit=CHUNK_BYTES):
        ids = np.asarray(batch.column(0).fill_null(NO_ID), np.int64)
        keys = np.asarray(batch.column(1).fill_null(0), np.int64)
        found = words(batch.column(2))
        doc, first, hashes, anchor = window_hashes(found.hashes, found.bounds, size, ANCHOR_WORDS)
        if not len(doc):
            continue
        later = first_of(ids[doc], hashes)
        rows = []
        if later.any():
            d, lo, hi = merged(doc[later], first[later], size)
            rows.append((int(anchor[0] % np.uint64(parts)), LOCAL, blob(ids[d]), blob(keys[d]), b"",
                         blob(lo.astype(np.int32)), blob(hi.astype(np.int32)), b""))
        doc, first, hashes = doc[~later], first[~later], hashes[~later]
        part = (anchor[~later] % np.uint64(parts)).astype(np.int64)
        # neighbours mostly share an anchor, so a run of windows needs its place only once
        new = np.flatnonzero(np.concatenate((
            [True], (part[1:] != part[:-1]) | (doc[1:] != doc[:-1]) | (first[1:] != first[:-1] + 1)
        ))) if len(doc) else np.empty(0, np.int64)
        count = np.diff(np.concatenate((new, [len(doc)])))
        order = np.argsort(part[new], kind="stable")
        run_part = part[new][order]
        by_part = np.repeat(np.arange(len(new)), count)  # windows in the order of their parts
        rank = np.empty(len(new), np.int64)
        rank[order] = np.arange(len(new))
        windows = hashes[np.argsort(rank[by_part], kind="stable")]
        run_doc, run_first, run_count = doc[new][order], first[new][order], count[order]
        ends = np.cumsum(run_count)
        cuts = np.flatnonzero(np.concatenate(([True], run_part[1:] != run_part[:-1]))) if len(new) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(new)]):
            used, local = np.unique(run_doc[lo:hi], return_inverse=True)
            from_w = ends[lo - 1] if lo else 0
            rows.append((int(run_part[lo]), SENT, blob(ids[used]), blob(keys[used]), blob(local.astype(np.int32)),
                         blob(run_first[lo:hi].astype(np.int32)), blob(run_count[lo:hi].astype(np.int32)),
                         blob(windows[from_w : ends[hi - 1]])))
        for row in rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=SENT_SCHEMA)


SENT_SCHEMA = pa.schema([
    ("part", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()),
    ("doc", pa.binary()), ("first", pa.binary()), ("count", pa.binary()), ("hashes", pa.binary()),
])
FOUND_SCHEMA = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def repeated(group: pa.Table, size: int) -> pa.Table:
    """Word intervals of one part that a smaller document also holds."""
    def of(name, kind, dtype):
        picked = group.filter(pc.equal(group["kind"], kind))[name]
        return [np.frombuffer(x, dtype) for x in picked.to_pylist()]

    out = []
    local = [of(n, LOCAL, t) for n, t in (("ids", np.int64), ("keys", np.int64), ("first", np.int32), ("count", np.int32))]
    if local[0]:
        out.append([np.concatenate(x) for x in local])
    sent = [of(n, SENT, t) for n, t in (("ids", np.int64), ("keys", np.int64), ("doc", np.int32),
                                        ("first", np.int32), ("count", np.int32), ("hashes", np.uint64))]
    if sent[0]:
        ids, keys = np.concatenate(sent[0]), np.concatenate(sent[1])
        base = np.cumsum([0, *map(len, sent[0])])[:-1]
        run_doc = np.concatenate([d + b for d, b in zip(sent[2], base)])
        run_first, run_count = np.concatenate(sent[3]).astype(np.int64), np.concatenate(sent[4])
        hashes = np.concatenate(sent[5])
        doc = np.repeat(run_doc, run_count)
        offset = np.arange(len(doc)) - np.repeat(np.cumsum(run_count) - run_count, run_count)
        first = np.repeat(run_first, run_count) + offset
        later = first_of(ids[doc], hashes)
        doc, first = doc[later], first[later]
        order = np.lexsort((first, doc))
        d, lo, hi = merged(doc[order], first[order], size)
        out.append([ids[d], keys[d], lo.astype(np.int32), hi.astype(np.int32)])
    columns = [np.concatenate([o[j] for o in out]) for j in range(4)]
    return pa.table([pa.array(c) for c in columns], schema=FOUND_SCHEMA)


def removals(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Word intervals [lo, hi) to remove: id, key (text_key), lo, hi; intervals may overlap.

    Every window's hash is sent to the part that its anchor names (equal windows have equal
    anchors), after one row per chunk and hash has been taken out: of copies within a chunk only
    the one of the smallest doc_id travels, the others are known to be repeated.
    """
    parts = parts_for(text_bytes(docs), PART_BYTES)
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    sent = rows.mapInArrow(
        lambda batches: sent_windows(batches, parts, size),
        "part long, kind int, ids binary, keys binary, doc binary, first binary, count binary, hashes binary",
    )
    return sent.repartition(parts, "part").groupBy("part").applyInArrow(
        lambda group: repeated(group, size), "id long, key long, lo int, hi int"
    )


def without_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` as doc_id, n_words, n_removed, kept (the words left, joined by a space).

    A word goes if a window of ``size`` consecutive words covers it whose word sequence also starts
    in a document with a smaller doc_id; windows are judged on the input. Words are runs of
    characters other than ASCII white space. A missing text has no words; a missing doc_id counts
    as larger than any other. Rows of one doc_id never remove from each other. Texts shorter than a
    window stay whole, an empty table gives an empty result, other columns are left out. ``docs``
    should be a stored table, whose rows come in the same order should a lost task read them again.
    """
    spans = (
        removals(docs, size)
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    )
    rows = docs.select(
        F.col("doc_id").cast("long"), "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.coalesce(text_key(), F.lit(0)).alias("_key"),
    )
    joined = rows.join(
        spans, (F.col("_id") == F.col("id")) & (F.col("_key") == F.col("key")), "left"
    ).select("doc_id", "text", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))
    return joined.mapInArrow(kept_words, "doc_id long, n_words long, n_removed long, kept string")


def kept_words(batches):
    for batch in chunked(batches, limit=4_000_000):
        n_words, n_removed, kept = [], [], []
        lows, highs = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for text, lo, hi in zip(batch.column(1).cast(pa.binary()).to_pylist(), lows, highs):
            found = (text or b"").split()
            n_words.append(len(found))
            stay, at = [], 0
            for a, b in zip(lo or (), hi or ()):
                if a > at:
                    stay += found[at:a]
                at = max(at, b)
            stay += found[at:]
            n_removed.append(len(found) - len(stay))
            kept.append(b" ".join(stay).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )
