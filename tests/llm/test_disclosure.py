import hashlib
import math
import random
import re

import pytest

from filedrop.llm.disclosure import find_spans, op8, sanitise

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    only = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(only(m)) <= 19 and luhn(only(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only(m)) <= 15),
    ]
    found = [(m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m.group())]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_equal_leftmost_matches(docs):
    rng = random.Random(2)
    parts = ["a@b.c", "a@b", "@", ".", "1.2.3.4", "300.1.1.1", "0255.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (385) 555-6708", "+49", "é", "😀", " ", "-", "\n", "7", "12", "x", "+", "_d@e.f", "..", "9999999999999995"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["12 " * 40_000, "9" * 50_000, "+1" + " " * 20_000, "x" * 100_000 + "@", "a@b.c " * 2_000, ""]
    got = find_spans(docs(list(enumerate(texts)))).collect()
    for r in got:
        want = brute(texts[r["doc_id"]])
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == want
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w[0] == k for w in want) for k in KINDS]
    assert len(got) == len(texts)


def test_terms_that_disclose_an_entity(docs):
    # "zorro" only occurs with the address, "the" everywhere, "once" with it once only.
    rows = [(i, "the fox and the hen") for i in range(60)]
    rows += [(100, "the Zorro wrote a.b@c.org the 77 fox once"), (101, "mail A.B@c.org Zorro 77 the hen")]
    out = {r["doc_id"]: r for r in find_spans(docs(rows)).collect()}
    text = dict(rows)
    terms = {text[d][s["start"] : s["end"]] for d in (100, 101) for s in out[d]["spans"] if s["kind"] == "term"}
    assert terms == {"Zorro", "77"} and not out[0]["spans"]
    assert [s["kind"] for s in out[100]["spans"]] == ["term", "email", "term"]
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs(rows)).collect()}
    assert clean[100] == "the  wrote [EMAIL] the  fox once" and clean[0] == text[0]


def test_generalised_terms_keep_their_kind(docs):
    # Seen in one more document, the terms tell most of the address, not all of it.
    rows = [(i, f"w{i} the") for i in range(2000)]
    rows += [(3000 + i, "Zorro x@y.zz 77 pico the") for i in range(2)] + [(3010, "Zorro 77 pico")]
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs(rows)).collect()}
    assert clean[3000] == "[NAME] [EMAIL] [NUMBER] [TERM] the" and clean[3010] == "Zorro 77 pico"


def test_terms_are_sought_in_whole_documents(docs):
    far = "the fox and the hen " * 40
    rows = [(i, far) for i in range(60)] + [(100, f"Zorro {far}a.b@c.org Zorro {far}zorro éa.b@c.org"), (101, f"{far}a.b@c.org {far}Zorro")]
    out = {r["doc_id"]: r["spans"] for r in find_spans(docs(rows)).collect()}
    text = dict(rows)
    assert [text[100][s["start"] : s["end"]] for s in out[100]] == ["Zorro", "a.b@c.org", "Zorro", "zorro", "a.b@c.org"]
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs(rows)).collect()}
    assert "orro" not in clean[100] + clean[101] and clean[0] == far
    # Documents that hold both count, however far apart: "pico" is in four, with the address in three of them.
    rows = [(i, f"w{i}") for i in range(2000)] + [(3000 + i, f"pico {far} x@y.zz") for i in range(3)] + [(3010, f"pico {far}")]
    assert {s["value"]: s["share"] for r in find_spans(docs(rows)).collect() for s in r["spans"] if r["doc_id"] == 3000 and s["kind"] == "term"
            }["pico"] == pytest.approx(math.log2(3 * 2004 / (4 * 3)) / math.log2(2004 / 3))


def test_places_of_terms_in_a_long_text(docs):
    # Blocks of terms, signs of more than one code unit, and the covering sign itself in the text.
    text = " ".join(["é1", "😀x", "a\uffffb", "-"][i % 4] for i in range(1500)) + " m@n.org M@N.org"
    rows = [(1, text), (2, text), (None, text), (None, text)] + [(i, "q") for i in range(10, 90)]
    want = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text[: text.index("m@n")])]
    for r in find_spans(docs(rows)).collect():
        got = [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term"]
        assert got == ([] if r["doc_id"] and r["doc_id"] >= 10 else want)


def test_nulls_repeats_and_clashing_columns(docs, rows):
    df = docs([(None, "x@y.zz"), (None, "x@y.zz"), (1, None), (1, "x@y.zz q"), (2, "")], "base", "spans", "_text", "n_ip")
    clean = sanitise(df)
    assert clean.columns == df.columns and clean.count() == 5
    assert rows(clean, "doc_id", "text") == [(1, "[EMAIL] q"), (1, None), (2, ""), (None, "[EMAIL]"), (None, "[EMAIL]")]
    assert find_spans(docs([])).count() == 0 and sanitise(docs([])).count() == 0


def test_digest_columns(spark, tmp_path):
    texts = ["no data", None, "a@b.c and 1.2.3.4"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op8(spark, str(tmp_path)).collect():
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(texts[r["doc_id"]] or ""))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and r["spans"].startswith(listed)


def test_many_spans_in_one_document(docs):
    # Whole log: entities of the same documents count once, and masking is linear in the spans.
    n = 10_000
    log = "\n".join(f"u{i}@é{i % 7}x.org u{i}@x{i}.org +1 385 555 {i:05d} 😀" for i in range(n))
    rows = [(1, log), (2, log + " Zorro"), (3, "é Zorro")] + [(i, f"w{i}") for i in range(10, 50)]
    out = {r["doc_id"]: r for r in find_spans(docs(rows)).collect()}
    want = brute(log)
    assert [(s["kind"], s["start"], s["end"]) for s in out[1]["base"]] == want and len(want) > 1.9 * n
    clean = {r["doc_id"]: r["text"] for r in sanitise(docs(rows)).collect()}
    assert clean[1].count("[EMAIL]") == n and clean[1].count("[PHONE]") == n and "@x" not in clean[1] and clean[3] == rows[2][1]


def test_overlapping_spans_are_covered_by_the_first(docs):
    # A phone number that is a card number too, and an address that holds an IP address.
    text = "é +4111 1111 1111 1111 x a.1.2.3.4@b.org " * 300
    at, want = 0, []
    for kind, a, b in brute(text):
        if b <= at:
            continue
        if a >= at:
            want += [text[at:a], f"[{kind.upper()}]"]
        at = b
    assert {r["text"] for r in sanitise(docs([(1, text), (2, "q")])).collect()} == {"".join(want) + text[at:], "q"}


def test_terms_equal_pointwise_information_by_hand(docs):
    rng = random.Random(5)
    people = [f"p{i}@x.org" for i in range(12)] + ["p0@x.org", "10.0.0.1"]
    rows = []
    for i in range(300):
        said = [f"t{int(40 * rng.random() ** 2)}" for _ in range(rng.randint(0, 12))]
        said += rng.sample(people, rng.choice([0, 0, 1, 2, 3])) + [f"t{100 + rng.randint(0, 60)}"]
        rng.shuffle(said)
        rows.append((i, " ".join(said)))
    rows += rows[:40] + [(None, rows[3][1])] * 2
    held = [({w for w in t.split() if w in people}, {w for w in t.split() if w not in people}) for _, t in rows]
    n, want = len(rows), {}
    for e in people:
        mine = [terms for who, terms in held if e in who]
        for t in set().union(*mine) if 2 <= len(mine) < n else ():
            n_te, n_t = sum(t in terms for terms in mine), sum(t in terms for _, terms in held)
            share = math.log2(n_te * n / (n_t * len(mine))) / math.log2(n / len(mine))
            if n_te >= 2 and share >= 0.8:
                want[e, t] = share
    assert len(want) > 5
    for r in find_spans(docs(rows), keep=("doc_id", "text")).collect():
        who = [w for w in r["text"].split() if w in people]
        told = {t: max(want[e, t] for e in who if (e, t) in want) for t in r["text"].split() if any((e, t) in want for e in who)}
        got = {s["value"]: pytest.approx(s["share"]) for s in r["spans"] if s["kind"] == "term"}
        assert got == told
