"""Language and toxicity fits against plain versions that count strings, without hashes or numpy passes."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from tests.llm.test_toxicity import slow_segments
from tillroll.llm import language, toxicity
from tillroll.llm.common import text_key

LANGUAGES = {
    "de": "der die das und ist nicht ein eine mit auf für über straße",
    "en": "the of and is not a an with on for over street house",
    "fr": "le la les et est pas un une avec sur pour rue déjà",
}


def trigrams(text):
    line = " " + "".join(c.lower()[0] if c.isalpha() else " " for c in text) + " "
    return [line[i - 1 : i + 2] for i in range(1, len(line) - 1) if line[i] != " "]


def plain_language(rows):
    """A function from text to (language, score, lead), learnt from (text, language) pairs."""
    names = sorted({lang for _, lang in rows})
    counts = {n: Counter(g for text, lang in rows if lang == n for g in trigrams(text)) for n in names}
    every = {g for c in counts.values() for g in c}

    def share(name, gram):
        return (counts[name][gram] + 0.5) / (sum(counts[name].values()) + 0.5 * language.BUCKETS)

    # every split of the languages in two groups, the first language's group coming first
    splits = [set(names) - set(out) for k in range(1, len(names)) for out in combinations(names[1:], k)]

    def raw(text, group):
        grams = [g for g in trigrams(text) if g in every]
        rest = [n for n in names if n not in group]
        odds = [math.log(sum(share(n, g) for n in group) / len(group)) - math.log(sum(share(n, g) for n in rest) / len(rest))
                for g in grams]
        return sum(odds) / max(len(grams), 1)

    sizes = [sum(abs(raw(text, s)) for text, _ in rows) / len(rows) for s in splits]
    trust = {}
    for n in names:
        own = [text for text, lang in rows if lang == n]
        for b, s in enumerate(splits):
            right = sum((raw(text, s) > 0) if n in s else (raw(text, s) < 0) for text in own)
            trust[n, b] = (right + 1) / (len(own) + 2)

    def decode(text):
        loss = {}
        for n in names:
            terms = [(trust[n, b], max(-4, min(4, raw(text, s) / sizes[b] * (1 if n in s else -1)))) for b, s in enumerate(splits)]
            loss[n] = sum(t * math.exp(-m) for t, m in terms) / sum(t for t, _ in terms)
        weight = {n: math.exp(-language.SHARPNESS * loss[n]) for n in names}
        order = sorted(names, key=lambda n: -weight[n])
        chance = [weight[n] / sum(weight.values()) for n in order]
        return order[0], chance[0], chance[0] - chance[1]

    return decode


def test_language_equals_the_plain_version(spark, docs):
    draw = random.Random(5)
    rows = []
    for i in range(90):
        lang = draw.choice(list(LANGUAGES))
        said = [draw.choice(LANGUAGES[lang].split()) for _ in range(draw.randrange(2, 9))]
        if i % 6 == 0:  # some words of another language
            said += [draw.choice(LANGUAGES[draw.choice(list(LANGUAGES))].split()) for _ in range(3)]
        rows.append((i, ("7! " if i % 9 == 0 else "") + " ".join(said).title(), lang))
    buckets = defaultdict(set)
    for _, text, _ in rows:
        grams, _ = language.letter_grams([text])
        for name, number in zip(trigrams(text), grams.tolist()):
            buckets[number].add(name)
    assert all(len(names) == 1 for names in buckets.values())  # or the plain version would differ
    df = docs(rows)
    decode = plain_language([(text, lang) for i, text, lang in rows if i < 70])
    found = language.identified(df, language.fit(df, F.col("doc_id") < 70)).collect()
    assert len(found) == 90
    for r in found:
        best, score, lead = decode(r.text)
        assert r.lang_pred == best and abs(r.score - score) < 1e-9, r.text
        assert r.ambiguous == (lead < language.AMBIGUOUS)


def parts_of(word):
    return [word, *[(size, word[:size]) for size in toxicity.BEGINNINGS if len(word) > size]]


def plain_odds(rows):
    """Log odds and certainty of every feature that tells, from (text, label) pairs."""
    seen = {0: Counter(), 1: Counter()}
    for text, label in rows:
        seen[label].update(f for word in set(text.split()) for f in parts_of(word))
    n = {label: sum(seen[label].values()) for label in (0, 1)}
    prior = toxicity.PRIOR * (n[0] + n[1])
    found = {}
    for f in seen[0] | seen[1]:
        both = toxicity.PRIOR * (seen[0][f] + seen[1][f])
        t, u = seen[1][f] + both, seen[0][f] + both
        odds = math.log(t / (n[1] + prior - t)) - math.log(u / (n[0] + prior - u))
        z = abs(odds) / math.sqrt(1 / t + 1 / u)
        if z >= toxicity.MIN_Z:
            found[f] = odds, z
    return found


def plain_scan(text, odds):
    """Of a text: words, segments, raised scores, those that are news, and the segments of the second scan."""
    said, scores = text.split(), []
    for word in said:
        known = [odds[f] for f in parts_of(word) if f in odds]
        scores.append((max(known, key=lambda x: x[1])[0] if known else 0.0) - toxicity.DRIFT)
    segments = slow_segments(scores)
    inside = {i: k for k, (a, b, _) in enumerate(segments) for i in range(a, b)}
    kept = set()
    for word in set(said):
        places = [i for i, w in enumerate(said) if w == word and scores[i] > 0]
        if places:
            kept.add(min(places, key=lambda i: (-segments[inside[i]][2], i)))
    once = [s if s <= 0 or i in kept else -toxicity.DRIFT for i, s in enumerate(scores)]
    return len(said), segments, [s for s in scores if s > 0], [scores[i] for i in sorted(kept)], slow_segments(once)


def check_law(law, raised, segments, n):
    """lambda makes the mean of exp(lambda * score) one, K fits the segments in the upper half."""
    decay, rate = law
    raised = [*raised, max([1.0, *raised])]
    rest = max(n + 1 - len(raised), 1)
    total = sum(math.exp(decay * s) for s in raised) + rest * math.exp(-decay * toxicity.DRIFT)
    assert abs(total / (len(raised) + rest) - 1) < 1e-9
    ordered = sorted(segments)
    middle = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2
    upper = sum(s >= middle - 1e-9 for s in ordered) + 1
    assert math.isclose(rate, upper * math.exp(decay * middle) / n, rel_tol=1e-6)


def test_toxicity_equals_the_plain_version(spark, docs):
    draw = random.Random(17)
    common = [f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    foul = ["grubby", "grubbier", "slime", "rotten", "vilest"]

    def text(bad):
        said = [draw.choice(common) for _ in range(draw.randrange(20, 40))]
        for _ in range(draw.randrange(3, 7) if bad else draw.randrange(0, 2)):
            said[draw.randrange(len(said))] = draw.choice(foul)
        return " ".join(said)

    rows = [(i, text(i % 3 == 0)) for i in range(240)]
    label = {i: int(i % 3 == 0) for i, _ in rows}
    df = docs(rows)
    labels = spark.createDataFrame(list(label.items()), "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.col("doc_id") < 200)
    last = {r.doc_id: r.last for r in df.select("doc_id", (F.pmod(F.shiftright(text_key(), 7), F.lit(4)) == 0).alias("last")).collect()}
    learnt = [(t, label[i]) for i, t in rows if i < 200 and not last[i]]
    held = [(t, label[i]) for i, t in rows if i < 200 and last[i]]
    odds = plain_odds(learnt)
    assert len(model.hashes) == len(odds)
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(sorted(model.odds), sorted(o for o, _ in odds.values())))
    scans = [(plain_scan(t, odds), y) for t, y in held]
    clean = [s for s, y in scans if not y]
    words = sum(s[0] for s in clean)
    check_law(model.law, [x for s in clean for x in s[2]], [x[2] for s in clean for x in s[1]], words)
    check_law(model.once, [x for s in clean for x in s[3]], [x[2] for s in clean for x in s[4]], words)

    def chance(law, n, score):
        return -math.expm1(-law[1] * n * math.exp(-law[0] * score))

    def score(scan):
        evidence = sum(-math.log(chance(model.once, scan[0], s)) for _, _, s in scan[4])
        return evidence, 1 / (1 + math.exp(-(model.offset + model.slope * evidence)))

    # the curve is the likeliest one: no gradient left, but for the pull of the slope
    errors = [(y - score(s)[1], score(s)[0]) for s, y in scans]
    assert abs(sum(e for e, _ in errors)) < 1e-5
    assert abs(sum(e * x for e, x in errors) - (model.slope - 0.1)) < 1e-4
    found = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    for i, t in rows:
        scan = plain_scan(t, odds)
        assert abs(found[i].score - score(scan)[1]) < 1e-9
        assert found[i].predicted == (found[i].score >= 0.5)
        significant = [(a, b) for a, b, s in scan[1] if chance(model.law, scan[0], s) <= toxicity.SIGNIFICANT]
        assert [(p.first, p.end) for p in found[i].passages] == significant
