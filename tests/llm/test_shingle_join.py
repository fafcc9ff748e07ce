import random

import numpy as np
import pytest

from filedrop.llm.shingle_join import first_tokens, jaccard_components, needed, op13, prefixes, shared_least
from filedrop.llm.text import mix


def brute(rows, words, percent=80):
    """Size of each row's set, and the smallest id in reach; rows without a set keep their own id."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = words((text or "").translate(lower))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and find(x) != find(y) and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if find(y) == find(x) and rows[y][0] is not None]
        out.append((i, len(sets[x]), min(ids, default=None) if sets[x] else i))
    return sorted(out, key=repr)


def changed(text, edits, rng):
    w = list(text)
    for at in rng.sample(range(len(w)), edits):
        w[at] = f"e{rng.random()}"
    return w


def corpus(rng):
    texts, passage = [], [f"p{i}" for i in range(60)]
    for g, (n, edits) in enumerate([(60, 2), (25, 3), (30, 5), (20, 8)]):
        base = [f"g{g}w{i}" for i in range(150)]
        texts += [changed(base, edits, rng) for _ in range(n)] + [base]
    # Chains, each a few words from the last; and texts that share one passage of most of their length.
    for g in range(3):
        text = [f"c{g}w{i}" for i in range(120)]
        for _ in range(12):
            texts.append(text)
            text = changed(text, 2, rng)
    texts += [passage + [f"q{rng.random()}" for _ in range(k % 25)] for k in range(120)]
    texts += [["x"] * k for k in (1, 4, 5, 6, 50)] + [["one", "two"], ["ONE", "Two"], ["a", "b", "c", "d", "e", "f"]]
    rng.shuffle(texts)
    return [(i * 3 - 100, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("percent", [50, 80, 96])
def test_components_equal_all_pairs(docs, words, percent):
    rows = corpus(random.Random(percent))
    got = [tuple(r)[:3] for r in jaccard_components(docs(rows).repartition(5), percent).collect()]
    assert sorted(got, key=repr) == brute(rows, words, percent)


def test_filters_lose_no_pair():
    rng = np.random.default_rng(4)
    for percent in (55, 80, 95):
        for _ in range(300):
            n = int(rng.integers(1, 90))
            pool = mix(rng.integers(0, 1 << 40, 3 * n).astype(np.uint64))
            a = np.unique(pool[:n])
            b = np.unique(np.concatenate([a[rng.random(len(a)) < percent / 100 + rng.random() / 4], pool[n : n + int(rng.integers(0, n // 4 + 1))]]))
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both) or not both:
                continue
            first = np.intersect1d(a[: first_tokens(len(a), percent)], b[: first_tokens(len(b), percent)])
            assert len(first) >= max(shared_least(len(a), percent), shared_least(len(b), percent))
            rarity = {t: int(rng.integers(0, 4)) for t in np.concatenate([a, b])}
            p, q = (prefixes(x.view(np.int64), np.array([rarity[t] for t in x]), len(x) - needed(len(x), percent) + 1) for x in (a, b))
            assert all(np.intersect1d(x, y).size for x, y in zip(p, q))


def test_nulls_empties_repeats_and_other_columns(docs, words):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(3, None), (4, ""), (5, " \n"), (7, "a b"), (7, "A B"), (7, "c d"), (None, "a b"), (None, "q r"), (None, "q  R"),
            (9, long), (-4, long + " z"), (9, long), (None, None)]
    # A third of the rows are equal, in all columns.
    rows += [(2, "s t u v w x y")] * 20 + [(None, "k l m n o p")] * 20 + [(60 + i, f"m{i} n") for i in range(5)]
    df = docs(rows, "node", "n", "component_id", "d1", "text_hash", "tokens")
    got = [tuple(r)[:3] for r in jaccard_components(df).collect()]
    assert sorted(got, key=repr) == brute(rows, words)
    assert jaccard_components(docs([])).count() == 0
    with pytest.raises(ValueError):
        jaccard_components(df, 0)


def test_query_returns_its_columns(spark, docs, words, tmp_path):
    rows = corpus(random.Random(1))[:150]
    docs(rows, "source").write.parquet(f"{tmp_path}/documents.parquet")
    got = op13(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, words)
