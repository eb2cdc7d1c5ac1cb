"""Language identification by error-correcting output codes over letter n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunked

UNKNOWN = "und"
BUCKETS = 1 << 15  # hashed letter trigrams
SMOOTHING = 0.5
EXHAUSTIVE = 6  # up to so many languages every possible bit is used
CALIBRATION_DOCS = 5_000  # documents, about, on which the bits' reliability is measured
SHARPNESS = 4.0  # of the score as a function of the decoding loss
AMBIGUOUS = 0.1  # least lead of the best language's score over the next


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram around a letter, and where each text's trigrams start and end.

    Letters are lower-cased, everything else counts as a space, so word edges are part of a trigram.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    line = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), np.uint32)
    table = np.full(int(line.max(initial=32)) + 1, 32, np.uint32)
    for code in np.flatnonzero(np.bincount(line)):
        if chr(code).isalpha():
            table[code] = ord(chr(code).lower()[0])
    line = table[line]
    middle = np.flatnonzero(line[1:-1] != 32) + 1
    mix = (
        line[middle - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        + line[middle].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        + line[middle + 1].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    )
    mix ^= mix >> np.uint64(29)
    mix *= np.uint64(0xBF58476D1CE4E5B9)
    starts = np.concatenate(([0], np.cumsum(sizes + 1))) + 1
    return (mix >> np.uint64(49)).astype(np.int64), np.searchsorted(middle, starts)


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 per language; columns are the bits.

    Few languages get the exhaustive code, every split into two groups. More get seeded random splits, ten
    bits for each doubling, of which the draw with the widest least distance is taken.
    """
    if n <= 1:
        return np.ones((n, 0))
    if n <= EXHAUSTIVE:
        return np.array([(1, *bits) for bits in product((1, -1), repeat=n - 1)][1:], float).T
    draw = np.random.Generator(np.random.PCG64(n))
    best = None
    for _ in range(50):
        code = draw.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - (code @ code.T)[~np.eye(n, dtype=bool)].max()) / 2
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x buckets: log odds of a trigram for the bit's two groups, 0 if never seen
    learnt: np.ndarray  # which buckets were seen
    scale: np.ndarray  # of each bit's mean log odds, so that 1 is a usual margin
    trust: np.ndarray  # languages x bits: how reliably the bit is right for the language

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean log odds of every text and bit over the trigrams that were learnt, and the number of
        all its trigrams."""
        grams, bounds = letter_grams(texts)
        n = np.diff(bounds)
        out = np.zeros((len(texts), len(self.weights)))
        full = np.flatnonzero(n)
        if len(full):
            starts = bounds[:-1][full]
            learnt = np.maximum(np.add.reduceat(self.learnt[grams].astype(np.int64), starts), 1)
            for b, row in enumerate(self.weights):
                out[full, b] = np.add.reduceat(row[grams], starts) / learnt
        return out * self.scale, n

    def decoded(self, texts: list[str]):
        """Language number, score and lead of every text, and whether it has a letter.

        Loss-weighted decoding: a language's loss is the mean of exp(-margin) towards its
        codeword, bits weighted by how reliable they are for it.
        """
        margins, n = self.margins(texts)
        if self.code.shape[1]:
            bits = np.exp(-np.clip(self.code[None] * margins[:, None], -4, 4))
            loss = (bits * self.trust[None]).sum(axis=2) / self.trust.sum(axis=1)[None]
        else:
            loss = np.zeros((len(texts), len(self.languages)))
        chance = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        score = chance[np.arange(len(texts)), best]
        rest = np.sort(chance, axis=1)[:, -2] if chance.shape[1] > 1 else np.zeros(len(texts))
        return best, score, score - rest, n > 0


def fit(docs: DataFrame, learns: Column) -> Model | None:
    """Binary classifiers from the rows where ``learns`` holds and lang is given; None without any.

    Trigrams are counted for each language over all of these rows, in Spark. A bit's two groups
    weigh their languages equally, however many documents each has. The model's size is fixed by
    ``BUCKETS`` and the number of languages. Reliability is measured on about ``CALIBRATION_DOCS`` of them.
    """
    rows = docs.where(learns & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = rows.select("lang", "text")

    def count(batches):
        totals = {}
        for batch in chunked(batches):
            langs = batch.column(0).to_pylist()
            grams, bounds = letter_grams(batch.column(1).to_pylist())
            owner = np.repeat(np.arange(len(langs)), np.diff(bounds))
            names, number = np.unique(np.array(langs, object).astype(str), return_inverse=True)
            own = number[owner]
            inside = grams[bounds[0] : bounds[-1]]
            counts = np.bincount(own * BUCKETS + inside, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for name, row, docs_of in zip(names, counts, np.bincount(number, minlength=len(names))):
                old = totals.setdefault(str(name), [np.zeros(BUCKETS, np.int64), 0])
                old[0] += row
                old[1] += int(docs_of)
        for name, (row, docs_of) in totals.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1), pa.string()), pa.array([*used, -1], pa.int32()),
                 pa.array([*row[used], docs_of], pa.int64())], ["lang", "bucket", "n"])

    table = (
        known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    if not table.num_rows:
        return None
    names = sorted(set(table["lang"].to_pylist()))
    number = np.array([names.index(x) for x in table["lang"].to_pylist()])
    bucket, n = np.asarray(table["bucket"]), np.asarray(table["n"], np.float64)
    counts = np.zeros((len(names), BUCKETS))
    grams = bucket >= 0
    counts[number[grams], bucket[grams]] = n[grams]
    share = counts + SMOOTHING
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(len(names))
    weights = np.array([
        np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(share[code[:, b] < 0].mean(axis=0)) for b in range(code.shape[1])
    ]).reshape(code.shape[1], BUCKETS)
    learnt = counts.sum(axis=0) > 0
    model = Model(names, code, weights * learnt, learnt, np.ones(len(weights)), np.ones(code.shape))
    if not len(weights):
        return model
    step = max(1, int(n[~grams].sum()) // CALIBRATION_DOCS)

    def tried(batches):
        for batch in chunked(batches):
            margins, _ = model.margins(batch.column(1).to_pylist())
            truth = [names.index(x) for x in batch.column(0).to_pylist()]
            bits = np.tile(np.arange(margins.shape[1]), len(truth))
            right = (margins * code[truth] > 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(truth, margins.shape[1]), pa.int32()), pa.array(bits, pa.int32()),
                 pa.array(right.ravel(), pa.int64()), pa.array(np.abs(margins).ravel(), pa.float64())],
                ["lang", "bit", "right", "size"])

    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("lang", "text")
    seen = sample.mapInArrow(tried, "lang int, bit int, right long, size double").groupBy("lang", "bit").agg(
        F.count("*").alias("n"), F.sum("right").alias("right"), F.sum("size").alias("size")
    ).collect()  # one row per language and bit
    total, size = np.zeros(len(weights)), np.zeros(len(weights))
    for row in seen:
        model.trust[row["lang"], row["bit"]] = (row["right"] + 1) / (row["n"] + 2)
        total[row["bit"]] += row["n"]
        size[row["bit"]] += row["size"]
    model.scale = np.where(size > 0, total / np.maximum(size, 1e-9), 1.0)
    return model


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row of ``docs`` with lang_pred, score (0 to 1) and ambiguous (no clear lead) added.

    A missing text, one without letters, or any text under a model that learnt nothing, is ``und``
    with score 0. Columns of these three names are replaced; all others, nulls and repeated rows
    stay as they are; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    given = docs.select(*names)
    if model is None:
        return given.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BUCKETS and the languages

    def run(batches):
        for batch in chunked(batches):
            fitted = shared.value
            texts = batch.column(batch.schema.get_field_index("text")).fill_null("").to_pylist()
            best, score, lead, letters = fitted.decoded(texts)
            langs = [fitted.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(np.where(letters, score, 0.0)),
                 pa.array(letters & (lead < AMBIGUOUS))],
                names=[*names, "lang_pred", "score", "ambiguous"])

    schema = given.withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False)}
    ).schema
    return given.mapInArrow(run, schema)


def confident(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose language is found without ambiguity; all rows if nothing was learnt."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in chunked(batches):
            texts = batch.column(batch.schema.get_field_index("text")).fill_null("").to_pylist()
            _, _, lead, letters = shared.value.decoded(texts)
            yield batch.filter(pa.array(letters & (lead >= AMBIGUOUS)))

    return docs.mapInArrow(run, docs.schema)
