"""Personal data: fixed patterns as seeds, and identifiers found by the contexts that seeds share."""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import aside, back, chunked, column, text_key
from tillroll.llm.words import STEP, mixed, words
from tillroll.operators.settle import settled

KINDS = ("email", "ip", "card", "phone")
MIN_SUPPORT = 3  # different seeds or accepted values that a context must precede before it counts as a pattern
MIN_CONFIDENCE = 0.8  # of a pattern, and of an identifier that patterns find
SPECIFIC_DIGITS = 8  # digits, the fewest of a fixed pattern's phone, that make an accepted value known anywhere
CANDIDATE_DIGITS = 4  # digits that make a token, or a run of groups of digits, a possible identifier
EMAIL, IP_KIND, CARD_KIND, PHONE_KIND = (1 << k for k in range(4))  # kinds that a possible identifier fits
ANY = EMAIL | IP_KIND | CARD_KIND | PHONE_KIND
MOST_DIGITS = ((CARD_KIND, 19), (PHONE_KIND, 15))  # of a run of groups, as of the fixed patterns
SLOTS = 1 << 20  # of the table that tells which contexts are worth counting

DIGIT = re.compile("[0-9]")
TOKEN = re.compile("[^\x20\x09-\x0d]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile("[0-9]++(?:[ -][0-9]++)*+")
GROUP = re.compile(r"\(?[0-9][0-9()./-]*")
AT = re.compile(r"\x20?[(\[{<]\x20?at\x20?[)\]}>]\x20?|\x20at\x20|@", re.IGNORECASE)
DOT = r"(?:\.|\x20?[(\[{<]\x20?dot\x20?[)\]}>]\x20?|\x20dot\x20)"
HOST = re.compile(rf"[A-Za-z0-9-]++({DOT}[A-Za-z0-9-]++)*+", re.IGNORECASE)
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str):
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", found.end() if found else at + 1)


def is_ip(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def is_card(match: str) -> bool:
    digits = [int(c) for c in match if c not in " -"] if len(match) < 40 else []
    doubled = (sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return 16 <= len(digits) <= 19 and (sum(digits[::-2]) + sum(doubled)) % 10 == 0


def is_phone(match: str) -> bool:
    return 8 <= sum(map(match.count, "0123456789")) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Number of the kind, start and end (code points) of the seeds, by kind, then start."""
    spans = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern, valid in ((1, IP, is_ip), (2, CARD, is_card), (3, PHONE, is_phone)):
            spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return spans


def addresses(text: str):
    """Start and end of what has the shape of an email address: the @ or the dots may be written out, in
    brackets or as words, and a host without dots will do unless only the word "at" stands for the @."""
    free = 0
    at = AT.search(text)
    while at:
        start = at.start()
        while True:
            while start > free and (text[start - 1] in LOCAL or text[start - 1].isalnum()):
                start -= 1
            if start - 5 <= free or start == at.start() or text[start - 5 : start].lower() != " dot ":
                break
            start -= 5
        host = HOST.match(text, at.end()) if start < at.start() else None
        if host and (at[0].lower() != " at " or host[1]):
            yield start, host.end()
            free = host.end()
        else:
            free = at.end()
        # the space that ends one "at" may begin the next
        at = AT.search(text, free if host and free == host.end() else free - (text[free - 1] == " "))


def groups(text: str, tokens):
    """Runs of two or more tokens of digits and ( ) . / -, one space apart: the tokens' numbers and
    where each group ends. Other punctuation behind a group ends its run."""
    run, ends = [], []
    for i, (a, b) in enumerate(tokens):
        found = GROUP.match(text, a, b) if text[a] in "(0123456789" else None
        end = found.end() if found else a
        while found and end > a and text[end - 1] in "(./-":
            end -= 1
        if found and not text[end:b].strip(",;:.!?"):
            if run and (run[-1] != i - 1 or text[tokens[i - 1][1] : a] != " " or ends[-1] != tokens[i - 1][1]):
                if len(run) > 1:
                    yield run, ends
                run, ends = [], []
            run.append(i)
            ends.append(end)
    if len(run) > 1:
        yield run, ends


def joined(text: str, tokens):
    """First token, start, end and the kinds that fit, for the runs of groups. A run longer than the longest number of
    a kind is cut before the group that exceeds it, and what is left is a run again."""
    for run, ends in groups(text, tokens):
        counts = [sum(map(text[tokens[i][0] : e].count, "0123456789")) for i, e in zip(run, ends)]
        for kind, most in MOST_DIGITS:
            first, digits = 0, 0
            for j in range(len(run) + 1):
                if j == len(run) or digits and digits + counts[j] > most:
                    if digits >= CANDIDATE_DIGITS and j - first > 1:
                        yield run[first], tokens[run[first]][0], ends[j - 1], kind
                    first, digits = j, 0
                if j < len(run):
                    digits += counts[j]


def candidates(text: str, tokens):
    """Start, end and fitting kinds of what may be an identifier: tokens with some digits, runs of groups
    of digits, and what has the shape of an email address."""
    taken = {}  # kinds of which something wider starts at the token
    for i, a, b, kind in joined(text, tokens):
        taken[i] = taken.get(i, 0) | kind
        yield a, b, kind
    plain = {}
    for i, (a, b) in enumerate(tokens):
        piece = text[a:b]
        if not DIGIT.search(piece) or sum(map(piece.count, "0123456789")) < CANDIDATE_DIGITS:
            continue
        while not text[a].isalnum():
            a += 1
        while not text[b - 1].isalnum():
            b -= 1
        plain[i] = a, b
    starts = [a for a, _ in tokens]
    for a, b in addresses(text):
        i = bisect_right(starts, a) - 1
        low, high = plain.get(i, (a, b))
        if low >= a and high <= b:  # else the token is more than the address
            taken[i] = taken.get(i, 0) | EMAIL
            yield a, b, EMAIL
    for i, (a, b) in plain.items():
        if ANY & ~taken.get(i, 0):
            yield a, b, ANY & ~taken.get(i, 0)


def contexts(text: str):
    """Of every seed and every other possible identifier: kind (-1: none), start, end, value, the kinds
    that fit and the two words before it (None where the text has none)."""
    seeds = base_spans(text)
    if not seeds and not DIGIT.search(text) and not AT.search(text):
        return
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    covered = sorted((a, b) for _, a, b in seeds)
    spans = [(kind, a, b, 1 << kind) for kind, a, b in seeds]
    for a, b, fits in candidates(text, tokens):
        i = bisect_right(covered, (b,))
        if not any(x < b and a < y for x, y in covered[max(0, i - 2) : i + 1]):
            spans.append((-1, a, b, fits))
    for kind, a, b, fits in spans:
        i = bisect_right(starts, a) - 1
        before = [text[x:y] for x, y in tokens[max(0, i - 2) : i]]
        yield kind, a, b, text[a:b], fits, before[-1] if before else None, before[0] if len(before) > 1 else None


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(STEP) ^ second)


def occurrences(batches):
    """One row for each seed or candidate and each of its contexts: the word before it, and the two.
    One without words before it has one row, its context missing."""
    for batch in chunked(batches):
        rows = []
        for j, text in enumerate(batch.column(2).to_pylist()):
            if text:
                rows += [(j, *found) for found in contexts(text)]
        if not rows:
            continue
        where, kind, start, end, value, fits, near, far = zip(*rows)
        has_near = np.array([n is not None for n in near])
        near_hash = np.zeros(len(rows), np.uint64)
        near_hash[has_near] = words(pa.array([n for n in near if n is not None], pa.string()), lower=True).hashes
        has_far = np.array([f is not None for f in far])
        far_hash = words(pa.array([f for f in far if f is not None], pa.string()), lower=True).hashes
        both = np.flatnonzero(has_far)
        index = np.concatenate((np.arange(len(rows)), both))
        cue = np.concatenate((near_hash, pair(far_hash, near_hash[both]))).view(np.int64)
        cue = pa.array(cue, mask=~np.concatenate((has_near, np.ones(len(both), bool))))
        place = pa.array(np.array(where)[index])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(place), batch.column(1).take(place), pa.array(np.array(kind, np.int32)[index]),
             pa.array(np.array(start, np.int32)[index]), pa.array(np.array(end, np.int32)[index]),
             pa.array(np.array(value, object)[index], pa.string()), pa.array(np.array(fits, np.int32)[index]), cue],
            ["doc_id", "text_key", "kind", "lo", "hi", "value", "fits", "cue"])


def cue_counts(batches, wanted: np.ndarray):
    """How often each wanted context is followed by a word."""
    for batch in chunked(batches):
        found = words(batch.column(0), lower=True)
        n = len(found.hashes)
        last, first = np.zeros(n, bool), np.zeros(n, bool)
        some = np.flatnonzero(np.diff(found.bounds))
        last[found.bounds[1:][some] - 1] = True
        first[found.bounds[:-1][some]] = True
        cues = [found.hashes[~last]]
        second = np.flatnonzero(~first & ~last)
        cues.append(pair(found.hashes[second - 1], found.hashes[second]))
        cues = np.concatenate(cues)
        cues = np.sort(cues[wanted[(cues & np.uint64(SLOTS - 1)).astype(np.int64)]])
        starts = np.flatnonzero(np.concatenate(([True], cues[1:] != cues[:-1]))) if len(cues) else np.empty(0, np.int64)
        counts = np.diff(np.concatenate((starts, [len(cues)])))
        yield pa.RecordBatch.from_arrays([pa.array(cues[starts].view(np.int64)), pa.array(counts)], ["cue", "total"])


def totals(docs: DataFrame, cues: DataFrame) -> DataFrame:
    """How often a word follows each of the cues, in one pass over the texts: cue, total."""
    slots = cues.select(F.col("cue").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).distinct()
    wanted = np.zeros(SLOTS, bool)
    wanted[np.asarray(slots.toArrow()["slot"], np.int64)] = True  # at most SLOTS numbers
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    counted = docs.select("text").mapInArrow(lambda batches: cue_counts(batches, shared.value), "cue long, total long")
    return counted.groupBy("cue").agg(F.sum("total").alias("total")).join(cues.select("cue").distinct(), "cue", "left_semi")


def bootstrapped(docs: DataFrame, seeds: DataFrame, behind: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Accepted values (value, of, score) and the patterns (cue, of, confidence) that hold with them.

    seeds has cue, of, value and n, behind has cue, of, value and n of the possible identifiers, a row for
    each kind that fits. Both results are None where no seed has a context."""
    accepted = counted = trusted = None
    n_accepted = 0
    while True:
        found = behind.join(accepted, ["value", "of"]) if accepted is not None else None
        evidence = seeds.select("cue", "of", F.col("n").alias("seeds"))
        if found is not None:
            evidence = evidence.unionByName(found.select("cue", "of", F.lit(0).cast("long").alias("seeds")))
        strong = settled(
            evidence.groupBy("cue", "of").agg(F.count("*").alias("support"), F.sum("seeds").cast("double").alias("seeds"))
            .where(F.col("support") >= MIN_SUPPORT)
        )
        new = strong.select("cue").distinct()
        if counted is not None:
            new = new.join(counted, "cue", "left_anti")
        if not new.isEmpty():
            counted = settled(totals(docs, new) if counted is None else counted.unionByName(totals(docs, new)))
        if counted is None:
            return None, None
        patterns = strong.join(counted, "cue")
        # only values behind a pattern of a kind that fits can score
        edges = settled(behind.join(patterns.select("cue", "of"), ["cue", "of"]))
        known = edges.withColumn("score", F.lit(0.0)) if accepted is None else (
            edges.join(accepted, ["value", "of"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        )
        gain = known.groupBy("cue", "of").agg(
            F.sum(F.col("n") * F.col("score")).alias("gain"), F.sum(F.col("n") * (1 - F.col("score"))).alias("open")
        )
        right = F.col("seeds") + F.coalesce("gain", F.lit(0.0))
        trusted = settled(
            patterns.join(gain, ["cue", "of"], "left")
            .withColumn("confidence", F.least(right / (F.col("total") - F.coalesce("open", F.lit(0.0)) / 2), F.lit(0.999)))
            .where(F.col("confidence") >= MIN_CONFIDENCE)
            .select("cue", "of", "confidence")
        )
        best = Window.partitionBy("value").orderBy(F.desc("score"), "of")  # at most a row for each kind
        chosen = (
            edges.join(trusted, ["cue", "of"]).groupBy("value", "of")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
            .where(F.col("score") >= MIN_CONFIDENCE)
            .withColumn("r", F.row_number().over(best)).where("r = 1").select("value", "of", "score")
        )
        if accepted is not None:
            chosen = accepted.unionByName(chosen.join(accepted, "value", "left_anti"))
        accepted = settled(chosen)
        before, n_accepted = n_accepted, accepted.count()
        if n_accepted == before:
            return accepted, trusted


def discovered(docs: DataFrame) -> DataFrame:
    """Identifiers that no fixed pattern matches: doc_id, text_key, kind (number), lo, hi.

    A context is the word, or the two words, before a seed or an accepted value. It becomes a pattern of
    their kind if at least ``MIN_SUPPORT`` different ones follow it. Its confidence is the share of
    all its occurrences, ordinary words included, that they follow, accepted values by their score;
    possible identifiers not accepted count half. What has the shape of an identifier scores the noisy-or of
    the confident patterns before it, and with ``MIN_CONFIDENCE`` it is accepted for good, as of the kind it scores
    highest for. Accepted values support patterns of the next round; the rounds end when nothing is accepted any more.

    Such shapes are a token with at least ``CANDIDATE_DIGITS`` digits, for every kind; groups of digits
    one space apart with as many, together, for cards and phones up to the digits that the fixed patterns allow; and
    name, @, host for emails, also without a dot or with "at" and "dot" written out.

    An accepted value is marked behind the confident patterns of its kind. It is marked wherever else it
    stands, too, if it has ``SPECIFIC_DIGITS`` digits or the shape of an address, or if at least half of all its
    places are behind such patterns; so a year that once stands behind one does not mark all the others.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    seen = settled(rows.mapInArrow(
        occurrences, "doc_id long, text_key long, kind int, lo int, hi int, value string, fits int, cue long"
    ))
    with_cue = seen.where("cue IS NOT NULL")
    seeds = settled(with_cue.where("kind >= 0").groupBy("cue", F.col("kind").alias("of"), "value").agg(F.count("*").alias("n")))
    possible = with_cue.where("kind < 0").groupBy("cue", "value", "fits").agg(F.count("*").alias("n"))
    kinds = F.filter(F.array(*map(F.lit, range(len(KINDS)))), lambda k: F.getbit("fits", k) == 1)
    behind = settled(
        possible.select("cue", "value", "n", F.explode(kinds).alias("of")).groupBy("cue", "value", "of").agg(F.sum("n").alias("n"))
    )
    accepted, trusted = bootstrapped(docs, seeds, behind)
    if accepted is None:
        return seen.select("doc_id", "text_key", "kind", "lo", "hi").limit(0)
    place = ["doc_id", "text_key", "lo", "hi", "value", "fits", "of"]
    spots = settled(
        seen.where("kind < 0").join(accepted.select("value", "of"), "value").where(F.expr("getbit(fits, of) = 1"))
        .join(trusted, ["cue", "of"], "left")
        .groupBy(*place).agg(F.max(F.col("confidence").isNotNull().cast("int")).alias("led"))
    )
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    anywhere = spots.groupBy("value").agg(
        (2 * F.sum("led") >= F.count("*")).alias("mostly")
    ).where("mostly").select("value")
    known = (digits >= SPECIFIC_DIGITS) | (F.col("fits") == EMAIL)
    out = [F.col(c) for c in ("doc_id", "text_key")] + [F.col("of").alias("kind"), F.col("lo"), F.col("hi")]
    sure = spots.where((F.col("led") == 1) | known)
    return sure.select(*out).unionByName(spots.where((F.col("led") == 0) & ~known).join(anywhere, "value", "left_semi").select(*out))


SPANS = "array<struct<kind:int,lo:int,hi:int>>"
SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())]))


def with_discovered(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as user (its columns other than text), text, and found, what contexts discover in it."""
    found = discovered(docs.select("doc_id", "text")).groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("kind", "lo", "hi"))).alias("found")
    )
    rows = docs.select(
        aside(c for c in docs.columns if c != "text").alias("user"), "text",
        F.col("doc_id").cast("long").alias("own_id"), text_key().alias("own_key"),
    )
    joined = rows.join(found, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")), "left")
    return joined.select("user", "text", F.coalesce("found", F.array().cast(SPANS)).alias("found"))


def unpacked(names: list[str]) -> list:
    """The caller's columns in their order."""
    return [F.col("text") if n == "text" else back("user", [n])[0] for n in names]


def outermost(spans: list[dict]) -> list[dict]:
    """The spans that lie within no other, by kind, then start."""
    kept, reach = [], -1
    for s in sorted(spans, key=lambda s: (s["lo"], -s["hi"], s["kind"])):
        if s["hi"] > reach:
            kept.append(s)
            reach = s["hi"]
    return sorted(kept, key=lambda s: (s["kind"], s["lo"], s["hi"]))


def annotated(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its spans: base and found, arrays of (kind, lo, hi) in code points.

    base has the matches of the fixed patterns (email, ip, card, phone by number), found what their
    contexts discover beyond them. A missing or empty text has neither. Other columns and repeated
    rows stay; columns named base or found are replaced; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("base", "found")]
    given = with_discovered(docs.select(*map(column, names))).withColumn("base", F.array().cast(SPANS))

    def run(batches):
        for batch in chunked(batches):
            texts = batch.column(1).to_pylist()
            wide = [outermost(f) for f in batch.column(2).to_pylist()]
            spans = [[{"kind": k, "lo": a, "hi": b} for k, a, b in base_spans(t or "")] for t in texts]
            columns = [batch.column(0), batch.column(1), pa.array(wide, SPAN), pa.array(spans, SPAN)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return given.mapInArrow(run, given.schema).select(*unpacked(names), "base", "found")


def span_text(spans):
    """kind:start:end of each span, by kind, then start, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(spans)
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["lo"], s["hi"])), ","
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span of personal data replaced by its kind in square brackets.

    Spans that overlap become one, named by the first. n_chars, where the table has it, follows the
    text; rows without personal data stay as they are.
    """
    names = docs.columns
    marked = with_discovered(docs)

    def run(batches):
        for batch in chunked(batches):
            texts, found = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            spans = [base_spans(t) + [(s["kind"], s["lo"], s["hi"]) for s in f] if t else [] for t, f in zip(texts, found)]
            texts = [covered(t, s) if s else t for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["user", "text"])

    out = marked.mapInArrow(run, marked.select("user", "text").schema).select(*unpacked(names))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out


def covered(text: str, spans) -> str:
    parts, at = [], 0
    for kind, low, high in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if low >= at:
            parts += [text[at:low], f"[{KINDS[kind].upper()}]"]
        at = max(at, high)
    return "".join(parts) + text[at:]
