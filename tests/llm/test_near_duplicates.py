import random
from collections import Counter

import numpy as np

from filedrop.llm import graph
from filedrop.llm.graph import components
from filedrop.llm.near_duplicates import (
    REGISTERS, banding, keep_first, least_shared, near_duplicates, signatures, weighted_jaccard,
)


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = np.repeat(rng.integers(0, 1 << 62, 60, np.uint64), rng.integers(1, 9, 60))
    shared = []
    for _ in range(12):
        a = rng.integers(0, 1 << 62, 60).astype(np.uint64)
        wa, wb = rng.integers(0, 12, 60), rng.integers(0, 12, 60)
        x, y = np.repeat(a, wa), np.repeat(a, wb)
        points = signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        expected = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        shared.append((points[0] == points[1]).mean() - expected)
    assert abs(np.mean(shared)) < 3 * 0.5 / np.sqrt(REGISTERS * len(shared))


def test_overlap_of_multisets():
    one = (np.array([1, 2, 5], np.uint64), np.array([2, 1, 1]))
    two = (np.array([1, 5, 9], np.uint64), np.array([1, 1, 3]))
    assert weighted_jaccard(one, two) == 2 / 7


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"n{i:02}", f"n{i + 1:02}") for i in range(0, 17)]
    random.Random(3).shuffle(chain)
    star = [("a", f"s{i}") for i in range(20)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + [("z", "z")], "a string, b string")).collect()}
    assert {got[f"n{i:02}"] for i in range(18)} == {"n00"} and {got[f"s{i}"] for i in range(20)} == {"a"} and "z" not in got
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    ids, n = list(range(1000)), []
    random.Random(8).shuffle(ids)
    written = graph.written
    monkeypatch.setattr(graph, "written", lambda df, tag: n.append(tag) or written(df, tag))
    for chain in (ids, sorted(ids)):
        n.clear()
        links = spark.createDataFrame(list(zip(chain, chain[1:])), "a bigint, b bigint")
        assert {(r["node"], r["root"]) for r in components(links).collect()} == {(i, 0) for i in ids}
        # Steps along paths, and rounds: each a few times the logarithm of 1,000.
        assert n.count("hang") <= 30 and n.count("half-links") <= 8


def brute_groups(texts, words, similarity=0.8):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, x in enumerate(ids):
        for y in ids[:k]:
            both, all_ = sum((sets[x] & sets[y]).values()), sum((sets[x] | sets[y]).values())
            if both >= similarity * all_ and (all_ or texts):
                root[max(find(x), find(y))] = min(find(x), find(y))
    return {i: find(i) for i in ids}


def variants(base, n, edits, rng):
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(len(w)), edits):
            w[at] = f"e{rng.random()}"
        out.append(" ".join(w))
    return out


def test_groups_equal_all_pairs(docs, words):
    rng = random.Random(5)
    texts = []
    # Variants are alike through their base only, whose id is not the smallest.
    for g, (n, edits) in enumerate([(40, 2), (12, 3), (30, 5)]):
        base = [f"g{g}w{i}" for i in range(150)]
        texts += variants(base, n // 2, edits, rng) + [" ".join(base)] + variants(base, n // 2, edits, rng)
    texts += ["x " * 50, "x " * 51, "x " * 300, "one two", "one  two ", "one two three", "a b c d e", "a b c d f"]
    rows = list(enumerate(texts))
    want = brute_groups(rows, words)
    found = near_duplicates(docs([(i, t) for i, t in rows])).collect()
    got = {r["doc_id"]: r["group_id"] for r in found}
    assert got == want
    assert sum(r["is_first"] for r in found) == len(set(want.values()))


def test_nulls_empties_repeats_and_other_columns(docs, rows):
    long = " ".join(f"w{i}" for i in range(30_000))
    df = docs([(3, None), (4, ""), (5, " \n"), (7, "a b"), (7, "a b"), (7, "c d"), (None, "a b"), (None, "q r"), (9, long),
               (-4, long + " z")], "node", "group_id", "digest")
    got = rows(near_duplicates(df), "doc_id", "group_id", "is_first")
    assert got == [(-4, -4, True), (3, 3, True), (4, 3, False), (5, 5, True), (7, 7, True), (7, 7, True), (7, 7, True),
                   (9, -4, False), (None, 7, False), (None, None, True)]
    kept = rows(keep_first(df), "doc_id", "text")
    assert [k for k, _ in kept] == [-4, 3, 5, 7, 7, None] and keep_first(df).columns == df.columns
    assert near_duplicates(docs([])).count() == 0


def test_bands_follow_the_similarity():
    assert [banding(s) for s in (0.5, 0.8, 0.9, 1.0)] == [(60, 2), (24, 5), (17, 7), (1, 120)]
    assert least_shared(0.8) == 74 and least_shared(0.01) == 0


def test_groups_at_other_similarities(docs, words):
    rng = random.Random(9)
    texts = []
    for g in range(8):
        base = [f"h{g}w{i}" for i in range(300)]
        texts += variants(base, 5, 2 + 4 * g, rng) + [" ".join(base)]
    for similarity in (0.5, 0.9):
        rows = list(enumerate(texts))
        want = brute_groups(rows, words, similarity)
        for least in (None, 0):
            got = {r["doc_id"]: r["group_id"] for r in near_duplicates(docs(rows), similarity, least).collect()}
            assert got == want and 8 < len(set(want.values())) < 48
