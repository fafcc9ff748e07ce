import hashlib
import random
import zlib

import numpy as np

from filedrop.llm.periodic_runs import find_runs, op12, periodic_runs
from filedrop.llm.text import mix


def brute_runs(w, least=12, copies=2):
    found = {}
    for q in range(1, len(w) // copies + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            first = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - first >= (copies - 1) * q and i - first + q >= least:
                found.setdefault((first - q, i - first + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def kernel(texts, **limits):
    bounds = np.cumsum([0] + [len(t) for t in texts])
    words = mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(5))
    out = [[] for _ in texts]
    for s, n, q in zip(*find_runs(words, bounds, **limits)):
        t = int(np.searchsorted(bounds, s, "right")) - 1
        out[t].append((int(s - bounds[t]), int(n), int(q)))
    return out


def doubled(n, make):
    word = make([0])
    while len(word) < n:
        word = make(word)
    return word[:n]


def test_runs_equal_all_lags_of_all_texts():
    rng = random.Random(1)
    texts = [[], [0], [0] * 11, [0] * 12, [0, 1] * 6, [0, 1] * 5 + [0]]
    for _ in range(1500):
        k, t, n = rng.choice([1, 2, 2, 3, 5]), [], rng.randrange(160)
        while len(t) < n:
            unit = [rng.randrange(k) for _ in range(rng.randrange(1, 40))]
            t += unit * rng.randrange(1, 8) + unit[: rng.randrange(len(unit) + 1)]
        texts.append(t)
    # Runs that meet inside a repetition of smaller period, and words without cubes.
    texts += [[0, 1] * k + [0, 0] + [1, 0] * k for k in (5, 30, 61)]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    texts += [fib[-1], doubled(700, lambda w: w + [1 - x for x in w]), doubled(600, lambda w: w + [2] + w)]
    got = kernel(texts)
    assert got == [brute_runs(t) for t in texts] and sum(map(len, got)) > 3000
    assert kernel(texts[:400], least=20, copies=3) == [brute_runs(t, 20, 3) for t in texts[:400]]


def test_memory_and_time_stay_in_proportion_to_one_long_repetition():
    n = 400_000
    for period in (1, 2, 1000):
        words = mix(np.arange(n, dtype=np.uint64) % np.uint64(period))
        assert [x.tolist() for x in find_runs(words, np.array([0, n]))] == [[0], [n], [period]]


def test_runs_and_collapsed_texts(docs, rows):
    song = "la " * 13 + "end\tof song"
    long = " ".join(f"w{i % 40_000}" for i in range(90_000))
    df = docs([(1, song), (1, song), (2, None), (3, ""), (4, " \n\x0b"), (None, "a b " * 6), (5, "a b " * 5), (6, long),
               (7, "ÄÖ ß " * 7 + "ÄÖ"), (8, "x " * 30)], "runs", "collapsed", "__text")
    got = rows(periodic_runs(df), "doc_id", "n_words", "runs", "collapsed")
    plain = [(i, n, [tuple(r) for r in runs], c if len(c) < 99 else len(c.split())) for i, n, runs, c in got]
    assert plain == [
        (1, 16, [(0, 13, 1)], "la end of song"), (1, 16, [(0, 13, 1)], "la end of song"), (2, 0, [], ""), (3, 0, [], ""),
        (4, 0, [], ""), (5, 10, [], "a b a b a b a b a b"), (6, 90_000, [(0, 90_000, 40_000)], 40_000),
        (7, 15, [(0, 15, 2)], "ÄÖ ß"), (8, 1, [], "x " * 30), (None, 12, [(0, 12, 2)], "a b"),
    ]
    assert periodic_runs(docs([])).count() == 0


def test_query_equals_brute_force(spark, docs, words, tmp_path):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(30)]
    data = []
    for i in range(400):
        t = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        data.append((i, " ".join(t + t[:30] * rng.randrange(3))))
    data += [(400, None), (401, ""), (None, "q " * 20), (10**12, "r s t " * 9)]
    docs(data).write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, text in data:
        w = words(text)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[i] = (len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                   sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    got = op12(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(data)
    assert sum(v[0] for v in want.values()) > 40
