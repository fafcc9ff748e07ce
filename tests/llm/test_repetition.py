from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from filedrop.llm.repetition import WINDOW, measure, repeat_lengths, repetition_rules
from filedrop.llm.text import utf8


def brute_lengths(words):
    n, best = len(words), [0] * len(words)
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                best[i] = max(best[i], k)
    return best


def brute(text, words, least=8):
    ws = words(text)
    grams = Counter(tuple(ws[i : i + WINDOW]) for i in range(len(ws) - WINDOW + 1))
    inside = set()
    for i in range(len(ws) - WINDOW + 1):
        if grams[tuple(ws[i : i + WINDOW])] > 1:
            inside |= set(range(i, i + WINDOW))
    lines = [x for x in (text or "").split("\n") if words(x)]
    best = brute_lengths(ws)
    cover = {k for i, b in enumerate(best) if b >= least for k in range(i, i + b)}
    failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(inside), failed, len(cover), max(best, default=0))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), max_size=4))
def test_longest_repeats_equal_all_pairs(texts):
    bounds = np.cumsum([0, *map(len, texts)])
    words = np.array([w for t in texts for w in t], np.uint64)
    got = repeat_lengths(words, bounds)
    assert got.tolist() == [b for t in texts for b in brute_lengths(t)]


def test_rules_equal_brute_force(docs, rows, words):
    line = "eins zwei drei vier fünf sechs sieben acht neun zehn"
    texts = [
        None, "", " \n\t", "a", "a a a a", line, f"{line}\n{line}\n\n{line} ", "é|ü <b>\x0b#\u2003x y", "x " * 300,
        " ".join(f"w{i}" for i in range(90)), " ".join(f"w{i}" for i in range(70)) + "\n" + line + "\n" + line,
        " ".join(f"w{i % 60}" for i in range(120)),
    ]
    df = repetition_rules(docs([(i, t) for i, t in enumerate(texts)] + [(5, line), (None, line)], "kept"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "covered_words", "longest_repeat")
    got = rows(df, "doc_id", *names)
    assert got == sorted(
        [(i, *brute(t, words)) for i, t in enumerate(texts)] + [(5, *brute(line, words)), (None, *brute(line, words))],
        key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r),
    )
    kept = dict((r[0], r[1]) for r in rows(df, "doc_id", "kept"))
    assert kept[9] and kept[10] and not kept[11] and not kept[0]


def test_long_repeat_in_a_long_text_is_rejected(docs):
    part = " ".join(f"p{i}" for i in range(250))
    text = " ".join(f"w{i}" for i in range(20_000)) + " " + part + " x " + part
    row = repetition_rules(docs([(1, text)]), spans=True).first()
    assert not row["base_failed"] and not row["kept"]
    assert (row["longest_repeat"], row["covered_words"]) == (250, 500)
    assert [text[s["start"] : s["end"]] for s in row["spans"]] == [part, part]


def test_spans_count_code_points():
    text = "äöü " + "é1 é2 é3 é4 é5 é6 é7 é8 - é1 é2 é3 é4 é5 é6 é7 é8"
    data, at = utf8(pa.array(["ß", text]))
    from filedrop.llm.repetition import _spans

    found = _spans(measure(data, at, 8, 0.5, 200)["_words"], at).to_pylist()
    assert found[0] == [] and [text[s["start"] : s["end"]] for s in found[1]] == ["é1 é2 é3 é4 é5 é6 é7 é8"] * 2


def test_empty_table(docs):
    assert repetition_rules(docs([])).count() == 0


def test_coverage_alone_rejects(docs):
    # A block of 70 words four times in 1,000: under half of the words repeat, no repeat is long.
    block = " ".join(f"b{i}" for i in range(70))
    plain = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    page = " ".join(f"{block} {plain(k, 180)}" for k in range(4))
    one = f"{block} {plain(0, 400)} {block} {plain(1, 460)}"
    got = {r["doc_id"]: r for r in repetition_rules(docs([(1, page), (2, one)])).collect()}
    assert (got[1]["n_words"], got[1]["covered_words"], got[1]["longest_repeat"]) == (1000, 280, 70)
    assert not got[1]["base_failed"] and not got[1]["kept"]
    assert got[2]["covered_words"] == 140 and got[2]["kept"]
