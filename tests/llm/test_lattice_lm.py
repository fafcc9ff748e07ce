import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from filedrop.llm.lattice_lm import BEGIN, VOCABULARY, Lattices, Pieces, load_vocabulary, score_texts

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def small():
    p = {"a": 0.2, "b": 0.1, "ab": 0.15, BEGIN: 0.1, BEGIN + "a": 0.2, "bab": 0.05}
    return Pieces({k: math.log(v) for k, v in p.items()}, [math.log(1e-4)] * 256, math.log(0.1))


def brute(pieces, text):
    if not text:
        return 1.0
    total = 0.0
    for n in range(1, len(text) + 1):
        piece = text[:n]
        if piece in pieces.log_p:
            total += math.exp(pieces.log_p[piece]) * brute(pieces, text[n:])
        elif n == 1:
            total += math.exp(pieces.sign(piece)) * brute(pieces, text[1:])
    return total


@pytest.mark.parametrize("text", ["", "a", "ab", "abab", "babab", "xab", "é", BEGIN + "abbab", BEGIN + "x"])
def test_forward_adds_up_all_segmentations(text):
    assert math.exp(small().forward(text)[-1]) == pytest.approx(brute(small(), text))


def test_expected_counts_equal_weighted_segmentations():
    pieces, text = small(), BEGIN + "abab"

    def paths(rest):
        if not rest:
            yield 1.0, []
        for n in range(1, len(rest) + 1):
            if rest[:n] in pieces.log_p:
                for p, tail in paths(rest[n:]):
                    yield p * math.exp(pieces.log_p[rest[:n]]), [rest[:n], *tail]

    want, whole = Counter(), 0.0
    for p, path in paths(text):
        whole += p
        for piece in path:
            want[piece] += p
    got, by_byte = {}, np.zeros(256)
    pieces.expected(text, 3, got, by_byte)
    assert not by_byte.any() and got == pytest.approx({k: 3 * v / whole for k, v in want.items()})


def test_long_words_do_not_underflow():
    value = small().forward(BEGIN + "ab" * 50_000)[-1]
    assert math.isfinite(value) and value < -10_000


def test_many_words_at_once_equal_one_by_one():
    rng = random.Random(3)
    for pieces in (small(), load_vocabulary(VOCABULARY)):
        words = ["".join(rng.choice("abxé日😀") for _ in range(rng.randint(1, 12))).encode() for _ in range(300)]
        words += [b"ab" * 100, b"the", "ñandú".encode()]
        weights = np.arange(len(words)) % 5
        lattices = Lattices(pieces)
        text = lambda w: BEGIN + w.decode()
        assert lattices.scores(words) == pytest.approx([pieces.forward(text(w))[-1] for w in words])
        want, by_byte = {}, np.zeros(256)
        for w, n in zip(words, weights):
            pieces.expected(text(w), n, want, by_byte)
        counts, bytes_ = lattices.expected(words, weights)
        assert counts == pytest.approx([want.get(k, 0.0) for k in lattices.names], abs=1e-9)
        assert bytes_ == pytest.approx(by_byte, abs=1e-9)


def test_vocabulary_is_a_distribution():
    p = load_vocabulary(VOCABULARY)
    total = sum(map(math.exp, p.log_p.values())) + sum(map(math.exp, p.log_byte)) + math.exp(p.log_end)
    assert total == pytest.approx(1)


def test_scores_equal_brute_force(docs):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["The", "the", "river", "ÉCOLE", "école", "x1", "日本", "a\x0bb"]) for _ in range(rng.randint(0, 30)))
             for _ in range(80)] + [None, "", "q" * 40_000, "held only-words " * 3]
    rows = list(enumerate(texts)) + [(None, "null id"), (3, texts[3]), (90, "The river"), (91, "the"), (92, " river")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = lambda t: (t or "").encode().translate(LOWER).split() + [None]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    # Small parts, so that words and texts meet across several of them.
    got = score_texts(docs(rows, "n", "score", "part"), part_bytes=20_000).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in rows:
        r, words = by_id[i], tokens(t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held(i), len(words), sum(c[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words))
        assert math.isfinite(r["score"]) and r["score"] < 0
    # A text's probability is the product over its words and the end.
    of = {r["doc_id"]: r["score"] for r in got}
    end = of[80]
    assert of[81] == end and of[90] - end == pytest.approx(of[91] - end + of[92] - end)


def test_empty_table_and_no_training_rows(docs):
    assert score_texts(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = score_texts(docs([(held, "a b")])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0) and row["base_score"] == 0
