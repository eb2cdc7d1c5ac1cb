"""Toxicity: every significant passage of a text, found by maximum-scoring segments."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunked, text_key
from tillroll.llm.words import Words, words
from tillroll.operators.settle import settled

TRAIN_DOCS = 50_000  # labelled rows, about, that a fit reads at most
PRIOR = 0.02  # weight of the Dirichlet prior, as a share of all counted words
MIN_Z = 1.96  # of a feature's log odds, to count at all
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that are features beside the whole word
DRIFT = 0.1  # taken from every word's log odds, so that ordinary text scores below zero
SIGNIFICANT = 0.05  # largest chance of a passage's score in clean text
SLOTS = 1 << 20  # of the table that tells quickly which features are known
SAME = 1e-6  # scores that differ by less are equal: they are differences of running sums over a whole chunk


def features(found: Words):
    """Of the whole words and of each length of beginning: which words, and their hashes."""
    yield np.arange(len(found.hashes)), found.hashes
    yield from found.all_beginnings(BEGINNINGS)


@dataclass
class Found:
    """Of one text."""

    n: int  # words
    segments: list[tuple[int, int, float]]  # maximal-scoring: first, end, score
    raised: np.ndarray  # scores of the words above zero
    news: np.ndarray  # the same without words that only repeat
    fresh: list[float]  # scores of the maximal segments when words that only repeat say nothing


@dataclass
class Model:
    hashes: np.ndarray  # of the features that tell, ascending
    odds: np.ndarray
    certainty: np.ndarray  # absolute z of the odds
    law: tuple[float, float] = (1.0, 1.0)  # lambda and K of the extreme-value law of segment scores in clean text
    once: tuple[float, float] = (1.0, 1.0)  # the same where a word counts once in a text
    offset: float = 0.0  # of the logistic curve from evidence to score
    slope: float = 1.0

    def word_scores(self, found: Words) -> np.ndarray:
        """Log odds of every word less the drift, by its most certain feature, wherever the word stands."""
        scores, certainty = np.zeros(len(found.hashes)), np.zeros(len(found.hashes))
        known = np.zeros(SLOTS, bool)
        known[(self.hashes & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        for which, hashes in features(found):
            maybe = np.flatnonzero(known[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), max(len(self.hashes) - 1, 0))
            right = self.hashes[at] == hashes[maybe] if len(self.hashes) else np.zeros(0, bool)
            at, word = at[right], which[maybe[right]]
            better = self.certainty[at] > certainty[word]
            scores[word[better]] = self.odds[at[better]]
            certainty[word[better]] = self.certainty[at[better]]
        return scores - DRIFT

    def segments(self, texts: pa.Array):
        """What is found in each text: in all its words, and in those that do not only repeat."""
        found = words(texts, letters=True)
        scores = self.word_scores(found)
        raised = np.flatnonzero(scores > 0)
        cuts = np.searchsorted(raised, found.bounds)
        kept = scanned(scores, raised, cuts)
        again = [lo + repeated(k, raised[lo:hi], found.hashes[raised[lo:hi]]) for k, lo, hi in zip(kept, cuts, cuts[1:])]
        news = np.ones(len(raised), bool)
        news[np.concatenate([np.empty(0, np.int64), *again])] = False
        once = scores.copy()
        once[raised[~news]] = -DRIFT
        fresh = scanned(once, raised[news], np.searchsorted(raised[news], found.bounds))
        for i, (lo, hi, first, end) in enumerate(zip(cuts, cuts[1:], found.bounds, found.bounds[1:])):
            segments = [(int(a - first), int(b - first), s) for a, b, s in kept[i]]
            here = scores[raised[lo:hi]]
            yield Found(int(end - first), segments, here, here[news[lo:hi]], [s for _, _, s in fresh[i]])

    def chance(self, n: int, score: float) -> float:
        """Probability that n words of clean text hold a segment of that score (Karlin and Altschul)."""
        return reached(self.law, n, score)

    def evidence(self, n: int, fresh) -> float:
        return float(sum(-np.log(max(reached(self.once, n, s), 1e-300)) for s in fresh))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * evidence, -500, 500)))


def reached(law: tuple[float, float], n: int, score: float) -> float:
    decay, rate = law
    return float(-np.expm1(-rate * n * np.exp(-decay * score)))


def maximal_segments(places: list[int], before: list[float], after: list[float]):
    """All maximal-scoring segments (Ruzzo and Tompa) as (first, end, score), in linear time.

    Given are the words of positive score and the running sums before and after each; what lies
    between them only lowers the sum, so no other word can begin or end a segment.
    """
    kept: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    for place, low, high in zip(places, before, after):
        start = place
        while kept:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j -= 1
            if j < 0 or kept[j][3] >= high:
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
        kept.append((start, place + 1, low, high))
    return [(a, b, high - low) for a, b, low, high in kept]


def scanned(scores: np.ndarray, raised: np.ndarray, cuts: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """Maximal-scoring segments of each text, whose raised words are raised[cuts[i]:cuts[i + 1]]."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    texts = (raised[lo:hi] for lo, hi in zip(cuts, cuts[1:]))
    return [maximal_segments(p.tolist(), total[p].tolist(), total[p + 1].tolist()) if len(p) else [] for p in texts]


def repeated(segments, places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of one text's raised words are no news. A word counts in the strongest segment that holds it,
    the first of equals, and there at its first place."""
    if not segments:
        return np.empty(0, np.int64)
    score = np.round(np.array([s for _, _, s in segments]) / SAME)
    which = np.searchsorted(np.array([a for a, _, _ in segments]), places, side="right") - 1
    order = np.lexsort((places, -score[which], hashes))
    return order[1:][hashes[order][1:] == hashes[order][:-1]]


def law_of(raised: np.ndarray, segments: np.ndarray, n: int) -> tuple[float, float]:
    """lambda and K from n words of clean text: the scores of its raised words and of its segments.

    lambda > 0 makes the mean of exp(lambda * score) one; K fits the number of segments in the upper
    half. One raised word and one segment more than seen stand for what a larger text would hold.
    """
    scores = np.append(raised, raised.max(initial=1.0))
    rest = max(n + 1 - len(scores), 1)
    low, high = 0.0, 1.0

    def excess(x):
        return float(np.expm1(np.minimum(x * scores, 700)).sum() + rest * np.expm1(-x * DRIFT))

    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    decay = max(high, 1e-3)
    middle = float(np.median(segments)) if len(segments) else float(scores.max())
    upper = int((segments >= middle - SAME).sum()) + 1
    return decay, upper * float(np.exp(decay * middle)) / max(n, 1)


def feature_counts(batches):
    """With how many different words, summed over the texts of each label, every feature occurs."""
    for batch in chunked(batches):
        labels = np.asarray(batch.column(1), np.int64)
        found = words(batch.column(0), letters=True)
        doc = np.repeat(np.arange(len(batch)), np.diff(found.bounds))
        order = np.lexsort((found.hashes, doc))
        h, d = found.hashes[order], doc[order]
        once = np.zeros(len(order), bool)
        if len(order):
            once[order[np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))]] = True
        for which, hashes in features(found):
            use = once[which]
            h, label = hashes[use], labels[doc[which[use]]]
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            h, label = h[order], label[order]
            cuts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            toxic = np.add.reduceat(label, cuts)
            total = np.diff(np.concatenate((cuts, [len(h)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[cuts].view(np.int64)), pa.array(toxic), pa.array(total - toxic)], ["word", "toxic", "fine"])


def fit(docs: DataFrame, labels: DataFrame, learns: Column, train_docs: int = TRAIN_DOCS) -> Model:
    """Word log odds, the extreme-value law and the score's curve, from labelled texts.

    ``labels`` has doc_id and toxic (0 or 1; 1 wins if an id has both); ``learns`` picks the ids that may be
    read. Of more than ``train_docs`` such rows a fixed share is taken by a hash of the id. Equal texts count
    once. Three quarters of them give the log odds of words and of their beginnings, with a Dirichlet
    prior in proportion to the features' overall counts; the last quarter, scored by those, gives the
    extreme-value law (from its clean texts) and the logistic curve. Without both labels every score
    is the same, at the share of toxic rows (0 without any).
    """
    given = (
        labels.where(F.col("toxic").isin(0, 1) & learns).groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max("toxic").cast("long").alias("label"))
    )
    step = max(1, -(-given.count() // train_docs))
    sample = given.where(F.pmod(F.xxhash64("_id"), F.lit(step)) == 0)
    # about train_docs rows of two numbers at most
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(sample), "_id")
    texts = settled(
        texts.where("text IS NOT NULL").groupBy(text_key().alias("key"))
        .agg(F.max("label").alias("label"), F.first("text").alias("text"))
    )
    last = F.pmod(F.shiftright("key", 7), F.lit(4)) == 0
    counts = settled(
        texts.where(~last).select("text", "label").mapInArrow(feature_counts, "word long, toxic long, fine long")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("fine").alias("fine"))
    )
    sums = counts.agg(F.sum("toxic").alias("t"), F.sum("fine").alias("f")).first()
    n_toxic, n_fine = float(sums["t"] or 0), float(sums["f"] or 0)
    rates = texts.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, toxic_docs = rates["n"], rates["t"] or 0
    share = min(max(toxic_docs / n if n else 0.0, 1e-6), 1 - 1e-6)
    if not 0 < toxic_docs < n or not n_toxic or not n_fine:
        nothing = np.empty(0)
        return Model(np.empty(0, np.uint64), nothing, nothing, offset=float(np.log(share / (1 - share))), slope=0.0)
    prior = PRIOR * (n_toxic + n_fine)
    weight = PRIOR * (F.col("toxic") + F.col("fine"))
    t, f = F.col("toxic") + weight, F.col("fine") + weight
    delta = F.log(t / (n_toxic + prior - t)) - F.log(f / (n_fine + prior - f))
    telling = (
        counts.select("word", delta.alias("odds"), (F.abs(delta) / F.sqrt(1 / t + 1 / f)).alias("z"))
        .where(F.col("z") >= MIN_Z)
        .toArrow()  # features of at most about train_docs texts
    )
    hashes = np.asarray(telling["word"], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    model = Model(hashes[order], np.asarray(telling["odds"], np.float64)[order], np.asarray(telling["z"], np.float64)[order])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def weighed(batches):
        for batch in chunked(batches):
            found = list(shared.value.segments(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([t.n for t in found], pa.int64()), batch.column(1),
                 *(pa.array(x, pa.list_(pa.float64())) for x in (
                     [[s for _, _, s in t.segments] for t in found], [t.raised for t in found],
                     [t.fresh for t in found], [t.news for t in found]))],
                ["n", "label", "segments", "raised", "fresh", "news"])

    tried = (
        texts.where(last).select("text", "label")
        .mapInArrow(weighed, "n long, label long, segments array<double>, raised array<double>, fresh array<double>, "
                    "news array<double>")
        .toArrow()  # a quarter of the sample, without its texts
    )
    size, label = np.asarray(tried["n"], np.int64), np.asarray(tried["label"], np.float64)
    clean = np.flatnonzero(label == 0)
    n_clean = int(size[clean].sum())
    seen = {c: tried[c].to_pylist() for c in ("raised", "segments", "news", "fresh")}
    pooled = {c: np.array([x for i in clean for x in found[i]], np.float64) for c, found in seen.items()}
    model.law = law_of(pooled["raised"], pooled["segments"], n_clean)
    model.once = law_of(pooled["news"], pooled["fresh"], n_clean)
    x = np.array([model.evidence(m, fresh) for m, fresh in zip(size, seen["fresh"])])
    model.offset, model.slope = logistic(x, label, share)
    return model


def logistic(x: np.ndarray, y: np.ndarray, rate: float) -> tuple[float, float]:
    """Offset and slope of the likeliest logistic curve, with a weak pull of the slope towards 0.1."""
    offset, slope = float(np.log(rate / (1 - rate))), 0.1
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(offset + slope * x, -30, 30)))
        w = p * (1 - p)
        gradient = np.array([(y - p).sum(), ((y - p) * x).sum() - (slope - 0.1)])
        curve = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1.0]])
        step = np.clip(np.linalg.solve(curve, gradient), -1, 1)
        offset, slope = offset + step[0], slope + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(offset), float(max(slope, 0.0))


SEGMENTS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` with score (0 to 1), predicted (1 from 0.5 on) and passages added.

    Words are lower-cased and without ASCII punctuation. passages has every maximal-scoring segment whose
    score clean text of that length reaches with probability ``SIGNIFICANT`` at most, as first word, end
    word and that probability; a word counts at each of its places. The score follows the sum of the
    negative logarithms over all segments of a second scan, in which a word counts at one place of its text,
    in the strongest segment that holds it: a thing said again is a passage again but no new evidence. A missing or empty text has no passage and
    the lowest score. Columns of the three names are replaced; other
    columns and repeated rows stay; an empty table gives an empty result.
    """
    added = ("score", "predicted", "passages")
    names = [c for c in docs.columns if c not in added]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the fit bounds its size

    def run(batches):
        for batch in chunked(batches):
            texts = batch.column(batch.schema.get_field_index("text"))
            fitted = shared.value
            found = list(fitted.segments(texts))
            score = fitted.score(np.array([fitted.evidence(t.n, t.fresh) for t in found], np.float64))
            chances = [[(a, b, fitted.chance(t.n, s)) for a, b, s in t.segments] for t in found]
            rows = [[{"first": a, "end": b, "p": p} for a, b, p in c if p <= SIGNIFICANT] for c in chances]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(rows, SEGMENTS)],
                names=[*names, *added])

    given = docs.select(*names)
    schema = given.withColumns({
        "score": F.lit(0.0), "predicted": F.lit(0),
        "passages": F.array().cast("array<struct<first:int,end:int,p:double>>"),
    }).schema
    return given.mapInArrow(run, schema)
