import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import pii
from tidewire.llm.queries import op9_contextual_pii, table

from . import cases

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    return {"email": True, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def expected(text):
    spans = sorted((m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(PATTERNS[kind], text or "") if holds(kind, m[0]))
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest()), joined


HARD = [
    "a@b.c_d@e.f g", "x%@y.z.", "a@b", "@b.c", "a.b+c@d-e.f.g,h@i.jj", "no-at.sign" * 300, "q" * 20_000 + " a@b.cd", "a@b" + ".c" * 20_000,
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.00255", "1.2.3", "9" * 3000 + ".1.2.3", "300.1.1.1.1.1.1", "1..2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111  1111 1111 1111", "41111111111111111111111111", "0 " * 15_000, "12-34 5678-9012", "5500005555555559 4012888888881881",
    "+1 (234) 555-6789", "+12", "++123456789", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+49.30.1234567-", "ünï +1 (234) 555-6789 漢 10.0.0.1 😀 a@b.cd", "+1" + "(" * 5000, "tel:+123456789,mail:a@b.cd",
]


def test_base_spans_of_hard_and_awkward_texts(spark):
    texts = [t for _, t, _ in cases.rows()] + HARD
    rows = pii.find(cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    wanted = {i: expected(t) for i, t in enumerate(texts)}
    assert {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in rows} == {i: w[0] for i, w in wanted.items()}
    assert all(set(filter(None, wanted[r["doc_id"]][1].split(","))) <= set(r["spans"].split(",")) for r in rows)
    assert pii.find(cases.documents(spark)).count() == len(cases.rows()) and pii.find(cases.no_documents(spark)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = op9_contextual_pii(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    assert {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in rows} == {i: expected(t)[0] for i, t in texts.items()}


def test_contexts_find_what_the_patterns_do_not(spark):
    texts = [f"write to mailto: user{i}@example{i}.org today please" for i in range(12)] + [f"server address= 10.0.{i}.7 answered" for i in range(12)]
    texts += ["write to mailto: user77(at)example.org today please", "server address= 10.0.0.0.x7 answered", "the year 2024 was good", "nothing at 9 in all", "mailto: nobody"]
    rows = {r["doc_id"]: r["spans"] for r in pii.find(cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert rows[24] == "email:17:" + str(17 + len("user77(at)example.org"))
    assert "ip:16:" in rows[25]
    assert rows[26] == rows[27] == rows[28] == ""
    assert all(rows[i].count(":") == 2 for i in range(24))


def test_frequent_words_are_no_patterns(spark):
    texts = [f"word a{i}@b.org word plain text word more word word" for i in range(30)] + ["word 12345 word"]
    rows = {r["doc_id"]: r["spans"] for r in pii.find(cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert rows[30] == "" and all(rows[i].startswith("email:5:") for i in range(30))


def test_redaction_replaces_spans_and_keeps_columns(spark):
    docs = cases.documents(spark, [(1, "ü a@b.cd, 10.0.0.1!", "s"), (1, "ü a@b.cd, 10.0.0.1!", "s"), (None, None, None), (2, "plain", "s"), (3, "+4111 1111 1111 1111", None)])
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    assert sorted((r["text"] or "") for r in clean.collect()) == ["", "+4111 1111 1111 1111".replace("4111 1111 1111 1111", "[CARD]"), "plain", "ü [EMAIL], [IP]!", "ü [EMAIL], [IP]!"]


def test_many_matches_in_one_text(spark):
    text = " ".join(f"a{i}@b.org" for i in range(3000))
    (row,) = pii.find(cases.documents(spark, [(1, text, None)])).collect()
    assert row["n_email"] == 3000 and row["base_sha256"] == expected(text)[0][4]


def test_native(spark):
    plan = pii.base_spans(cases.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("lengths", [[1], [3, 0, 5], list(range(200)), [7] * 129])
def test_starts(spark, lengths):
    (row,) = spark.createDataFrame([(lengths,)], "a array<int>").select(pii._starts(F.col("a")).alias("s")).collect()
    assert row["s"] == [sum(lengths[:i]) for i in range(len(lengths))]


def spans_of(spark, texts):
    return {r["doc_id"]: r["spans"] for r in pii.find(cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}


def test_groups_of_digits_are_one_candidate(spark):
    """The patterns of full numbers also find one that no base pattern knows, whole."""
    texts = [f"call the phone +1 555 {100 + i} {4000 + i} now and wait" for i in range(8)]
    texts += ["call the phone 555 123 4567 now and wait", "call the phone 555 123 4567, then go", "in 2024 17 of 30 came"]
    rows = spans_of(spark, texts)
    assert rows[8] == "phone:15:27" and rows[9] == "phone:15:27" and rows[10] == ""


def test_found_identifiers_induce_patterns(spark):
    """Second generation: what ``reach me at`` finds is the evidence for ``signed off by``, which no seed ever follows."""
    texts = [f"please reach me at user{i}@mail{i}.org today" for i in range(30)]
    found = [f"contact-{i}(at)mail" for i in range(5)]
    texts += [f"please reach me at {f}@ today" for f in found]
    texts += [f"signed off by {f}@ yesterday" for f in found] + ["signed off by other-7(at)mail@ yesterday", "signed off and gone", "count 7 of 9"]
    rows = spans_of(spark, texts)
    assert all(rows[i].startswith("email:19:") for i in range(35))
    assert all(rows[i].startswith("email:14:") for i in range(35, 41))
    assert rows[41] == rows[42] == ""


def slow_trust(spans, words):
    """Patterns by brute force. ``spans`` are (token, kind or None, left words, right words), nearest first; ``words`` of every text."""
    edges, occurrences = {}, {}
    for token, _, left, right in spans:
        named = [("l", *reversed(left[:n])) for n in (1, 2, 3) if len(left) >= n] + [("r", *right[:n]) for n in (1, 2, 3) if len(right) >= n]
        named += [("b", left[0], right[0])] if left and right else []
        for p in named:
            edges.setdefault(p, {}).setdefault(token, 0)
            edges[p][token] += 1
    for w in words:
        for i in range(len(w)):
            for n in (1, 2, 3):
                if i + n <= len(w):
                    for side in "lr":
                        occurrences[(side, *w[i : i + n])] = occurrences.get((side, *w[i : i + n]), 0) + 1
            if i + 2 < len(w):
                occurrences["b", w[i], w[i + 2]] = occurrences.get(("b", w[i], w[i + 2]), 0) + 1
    seeds = {(t, k): 1.0 for t, k, _, _ in spans if k is not None}
    trusted, number = dict(seeds), None
    while True:
        good = {}
        for p, tokens in edges.items():
            total = max(occurrences.get(p, 0), sum(tokens.values()))
            for k in range(4):
                held = [(n, trusted[t, k]) for t, n in tokens.items() if (t, k) in trusted]
                trust = min(sum(n * b for n, b in held) / total, 1)
                if len(held) >= pii.MIN_SEEDS and trust >= pii.MIN_TRUST:
                    good[p, k] = trust
        for (p, k), trust in good.items():
            for t in edges[p]:
                if (t, k) not in seeds:
                    trusted[t, k] = max(trusted.get((t, k), 0), trust)
        if len(trusted) == number:
            return sorted(round(x, 9) for x in good.values())
        number = len(trusted)


def test_graph_equals_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(4)
    opening = ["mail me at", "write to", "the address is", "see", "also call"]
    texts = []
    for i in range(300):
        some = [f"{rng.choice(opening)} {rng.choice([f'u{rng.randrange(60)}@h.org', f'x{rng.randrange(40)}y', f'10.0.0.{rng.randrange(50)}'])} {rng.choice(['or', 'and', 'now'])} so" for _ in range(3)]
        texts.append(" ".join(["start", *some, "end"]))
    docs = cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    monkeypatch.setattr(pii, "MIN_TRUST", 0.2)
    for most in (pii.MAX_BROADCAST, 0):
        monkeypatch.setattr(pii, "MAX_BROADCAST", most)
        marked, known, seeds = pii.graph(pii.stage(pii.base_spans(docs), "test"), docs)
        got = sorted(round(r["trust"], 9) for r in pii.trusted_patterns(known, seeds).collect())
        spans = []
        for t in texts:
            words = t.split()
            for i, w in enumerate(words):
                if any(c.isdigit() or c == "@" for c in w):
                    kind = 0 if "@" in w else 1 if w.count(".") == 3 else None
                    left = next((words[i - n : i] for n in range(i + 1, 0, -1) if not any(c.isdigit() for x in words[i - n : i] for c in x) and i >= n), [])
                    right = next((words[i + 1 : i + 1 + n] for n in range(len(words), 0, -1) if i + n < len(words) and not any(c.isdigit() for x in words[i + 1 : i + 1 + n] for c in x)), [])
                    spans.append((w, kind, left[::-1][:3], right[:3]))
        assert got == slow_trust(spans, [t.split() for t in texts]) and len(got) > 5


def test_redaction_of_overlapping_spans_and_long_texts(spark):
    import time

    def slow(text, spans):
        out, at = "", 0
        for kind, a, b in spans:
            if a >= at:
                out += text[at:a] + f"[{kind.upper()}]"
            at = max(at, b)
        return out + text[at:]

    texts = [t for t in HARD if len(t) < 3000] + ["ü" * 1023 + " a@b.cd " + "é" * 2040 + " 10.0.0.1 z", " ".join(f"ü a{i}@b.org" for i in range(500)), "+4111 1111 1111 1111 a@b.cd"]
    docs = cases.documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    spans = {r["doc_id"]: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in filter(None, r["spans"].split(",")))] for r in pii.find(docs).collect()}
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()} == {i: slow(t, spans[i]) for i, t in enumerate(texts)}
    took = {}
    for n in (5_000, 20_000):
        rows = spark.createDataFrame([(1, " ".join(f"a{i}@b.org" for i in range(n)))], "doc_id long, text string")
        rows = pii.stage(rows, "test")
        found = pii.stage(pii.all_spans(rows, "text").select("text", "spans"), "test")
        began = time.monotonic()
        found.select(F.length(pii._masked(F.col("text"), F.col("spans")))).collect()
        took[n] = time.monotonic() - began
    assert took[20_000] < 8 * took[5_000] + 2
