import collections
import hashlib
import random
import re

from tests.llm.conftest import SF
from tillroll.llm import pii, queries


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    """The four patterns as given, searched from the left."""
    t, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def named(spans):
    return [(pii.KINDS[k], a, b) for k, a, b in spans]


def test_query_equals_brute_force(spark, texts):
    rows = queries.op3_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r.doc_id])
        counts = collections.Counter(k for k, _, _ in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in pii.KINDS]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) <= set(r.spans.split(","))


def test_patterns_on_random_texts():
    draw = random.Random(7)
    for alphabet in ("a@.b-", "0123456789 -", "01.2 ", "+0123 ()-.", "a@.1+ -5é"):
        for _ in range(1500):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(0, 45)))
            assert named(pii.base_spans(text)) == brute(text), text
    good = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "a.b@c.de@f.gh", "1.2.3.4.5.6.7.8", "256.1.1.1",
            "+1 (523) 555-1055.", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x@y", "é1@a.b", "00001.2.3.4"]
    for text in good + [" ".join(good)]:
        assert named(pii.base_spans(text)) == brute(text)


def test_long_runs_take_linear_time():
    for piece in ("1", "a@", "1.", "+1", "a.", "a", "1 "):
        pii.base_spans(piece * 200_000)


def text_with(lead, value):
    return f"some words here {lead} {value} and more words"


def test_contexts_find_unseen_identifiers(spark, docs):
    card = [n for n in (str(4000000000000000 + i) for i in range(200)) if luhn(n)]
    rows = [(i, text_with("card number:", card[i])) for i in range(6)]
    rows += [(10, text_with("card number:", "9999-123X")), (11, text_with("order of", "9999-777X"))]
    rows += [(20 + i, text_with("the", f"user{i}@mail.example.com")) for i in range(5)]
    rows += [(30, "the 12345 things"), (31, "the cat the dog the bird the 5555 and the fish " * 3), (32, None), (33, ""),
             (34, "plain " * 30_000)]
    rows += [(10, text_with("card number:", "9999-123X"))]
    found = pii.annotated(docs(rows))
    assert found.columns == docs(rows).columns + ["base", "found"]
    by = collections.defaultdict(set)
    for r in found.collect():
        by[r.doc_id].add(tuple((s.kind, r.text[s.lo : s.hi]) for s in r.found))
    assert by[10] == {((2, "9999-123X"),)}
    assert all(by[i] == {()} for i in by if i != 10)
    assert found.count() == len(rows)


def test_redaction(spark, docs):
    rows = [(1, "write a@b.cd or +1 523 555 1055!"), (1, "nothing"), (2, None), (3, ""), (None, "x@y.zz")]
    df = docs(rows).withColumnRenamed("slot", "base").withColumnRenamed("hits", "found")
    out = pii.redacted(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id or 0, r.text or "", r.n_chars or 0, r.base, r.found) for r in out.collect())
    assert got == [(0, "[EMAIL]", 7, "x", "y"), (1, "nothing", 7, "x", "y"), (1, "write [EMAIL] or [PHONE]!", 25, "x", "y"),
                   (2, "", 0, "x", "y"), (3, "", 0, "x", "y")]
    assert pii.redacted(docs([])).count() == 0


def test_shapes_without_four_digits_in_a_token(spark, docs):
    rows = [(i, text_with("mail me:", f"user{i}@mail.example.com")) for i in range(12)]
    rows += [(20 + i, text_with("ring me:", f"+1 523 555 10{i:02}")) for i in range(12)]
    hidden = {100: "jane.doe(at)example.com", 101: "jane@localhost", 102: "jane dot doe at example dot com",
              110: "555 123 4567", 111: "(555) 123-4567"}
    rows += [(i, text_with("mail me:" if i < 110 else "ring me:", value)) for i, value in hidden.items()]
    rows += [(200, text_with("look", "at me")), (201, text_with("sum of", "555 765 4321"))]
    by = {r.doc_id: r for r in pii.annotated(docs(rows)).collect()}
    for i, value in hidden.items():
        assert [(s.kind, by[i].text[s.lo : s.hi]) for s in by[i].found] == [(0 if i < 110 else 3, value)]
    assert all(not r.found for i, r in by.items() if i not in hidden)
    out = {r.doc_id: r.text for r in pii.redacted(docs(rows)).collect()}
    assert out[110] == text_with("ring me:", "[PHONE]") and out[100] == text_with("mail me:", "[EMAIL]")


def test_shapes_take_linear_time():
    for piece in ("1 ", "a at ", "a dot ", "a@", " at", "(1) ", "a dot b at c ", "1234 5678 ", "(at)"):
        list(pii.contexts(piece * 100_000))


def test_accepted_values_make_patterns_until_nothing_is_new(spark, docs):
    card = [n for n in (str(4000000000000000 + i) for i in range(2000)) if luhn(n)]
    known = [f"9999-{i}AB" for i in range(1, 9)]
    later = [f"8888-{i}CD" for i in range(1, 4)]
    rows = [(i, text_with("number:", card[i])) for i in range(80)]
    rows += [(100 + i, text_with("number:", v)) for i, v in enumerate(known)]
    rows += [(200 + i, text_with("has badge=", v)) for i, v in enumerate(known + later)]
    rows += [(300 + i, text_with("holds pass=", v)) for i, v in enumerate(later + ["7777-1EF"])]
    rows += [(400, "9999-1AB stands first"), (401, text_with("in the year", "9999")), (402, text_with("order of", "6666-1GH"))]
    by = {r.doc_id: r for r in pii.annotated(docs(rows)).collect()}
    marked = {i: [(s.kind, r.text[s.lo : s.hi]) for s in r.found] for i, r in by.items()}
    values = dict(enumerate(known, 100)) | dict(enumerate(known + later, 200)) | dict(enumerate(later + ["7777-1EF"], 300))
    values[400] = "9999-1AB"
    assert marked == {i: [(2, values[i])] if i in values else [] for i in by}
    redacted = " ".join(r.text for r in pii.redacted(docs(rows)).collect())
    assert not any(v in redacted for v in values.values())


def test_a_common_number_is_marked_behind_patterns_only(spark, docs):
    rows = [(i, text_with("ring me:", f"+1 523 555 10{i:02}")) for i in range(20)]
    rows += [(30, text_with("ring me:", "2024")), (31, text_with("ring me:", "555-765-4321")), (32, text_with("code", "555-765-4321"))]
    rows += [(40 + i, text_with("in the year", "2024")) for i in range(4)]
    by = {r.doc_id: [r.text[s.lo : s.hi] for s in r.found] for r in pii.annotated(docs(rows)).collect()}
    assert {i: f for i, f in by.items() if f} == {30: ["2024"], 31: ["555-765-4321"], 32: ["555-765-4321"]}


def brute_graph(rows):
    """Accepted values and marked places of (doc, text), by dictionaries."""
    places, follows = [], collections.Counter()
    for doc, text in rows:
        tokens = [w.lower() for w in re.findall("[^\x20\x09-\x0d]+", text or "")]
        for i in range(1, len(tokens)):
            follows[(tokens[i - 1],)] += 1
            if i > 1:
                follows[tuple(tokens[i - 2 : i])] += 1
        for kind, a, b, value, fits, near, far in pii.contexts(text or ""):
            cues = [(near.lower(),)] if near else []
            cues += [(far.lower(), near.lower())] if far else []
            places.append((doc, kind, a, b, value, fits, cues))
    accepted = {}
    while True:
        behind = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0, 0]))  # pattern -> value -> seed, known, open
        for _, kind, _, _, value, fits, cues in places:
            for k in range(4) if kind < 0 else [kind]:
                if kind >= 0 or fits >> k & 1:
                    score = accepted[value][1] if kind < 0 and accepted.get(value, (None,))[0] == k else 0
                    for cue in cues:
                        entry = behind[cue, k][value, kind >= 0]
                        entry[0] += kind >= 0
                        entry[1] += score if kind < 0 else 0
                        entry[2] += 1 - score if kind < 0 else 0
        trusted, doubt = {}, collections.defaultdict(lambda: 1.0)
        for (cue, k), values in behind.items():
            if sum(e[0] > 0 or e[1] > 0 for e in values.values()) >= pii.MIN_SUPPORT:
                right, free = sum(e[0] + e[1] for e in values.values()), sum(e[2] for e in values.values())
                if right / (follows[cue] - free / 2) >= pii.MIN_CONFIDENCE:
                    trusted[cue, k] = min(0.999, right / (follows[cue] - free / 2))
        for (cue, k), confidence in trusted.items():
            for value, seed in behind[cue, k]:
                if not seed:
                    doubt[value, k] *= 1 - confidence
        fresh = {}
        for (value, k), d in sorted(doubt.items()):
            if value not in accepted and 1 - d > fresh.get(value, (None, 0))[1]:
                fresh[value] = k, 1 - d
        if not fresh:
            break
        accepted |= fresh
    spots = {}
    for doc, kind, a, b, value, fits, cues in places:
        if kind < 0 and value in accepted and fits >> accepted[value][0] & 1:
            spots[doc, a, b, value, fits] = any((cue, accepted[value][0]) in trusted for cue in cues)
    led, all_of = collections.Counter(), collections.Counter()
    for (_, _, _, value, _), behind_one in spots.items():
        led[value] += behind_one
        all_of[value] += 1
    return {
        (doc, accepted[value][0], a, b) for (doc, a, b, value, fits), behind_one in spots.items()
        if behind_one or len(re.findall("[0-9]", value)) >= 8 or fits == pii.EMAIL or 2 * led[value] >= all_of[value]
    }


def test_graph_equals_brute_force(spark, docs):
    draw = random.Random(11)
    card = [n for n in (str(4000000000000000 + i) for i in range(4000)) if luhn(n)]
    values = card[:40] + [f"+1 523 555 {i}" for i in range(1000, 1030)] + [f"{i}-X{i % 7}" for i in range(3000, 3040)] + [f"u{i}@host" for i in range(9)]
    leads = ["number:", "my card", "call", "the", "ring me", "badge", ""]
    rows = []
    for i in range(600):
        lead = draw.randrange(len(leads))
        spread = values[draw.randrange(len(values))] if draw.random() < 0.05 else values[(lead * 17 + draw.randrange(24)) % len(values)]
        rows.append((i, f"{leads[lead]} {spread} and so on" if draw.random() < 0.95 else f"so {leads[lead]} it goes"))
    got = {(r.doc_id, r.kind, r.lo, r.hi) for r in pii.discovered(docs(rows).select("doc_id", "text")).collect()}
    expected = brute_graph(rows)
    assert expected and got == expected
