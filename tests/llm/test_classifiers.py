import random
import zlib

import numpy as np
import pytest

from filedrop.llm import quality_cnn as cnn
from filedrop.llm import toxicity as tox
from filedrop.llm.samples import labelled_sample

RNG = random.Random(11)


def sentence(n):
    return " ".join(RNG.choice("river stone walk green quiet morning paper window garden little".split()) for _ in range(n))


def labelled(n):
    """Texts with quality and toxicity: junk marks make a text bad, insults and made-up stems make it toxic."""
    rows = []
    for i in range(n):
        words = sentence(RNG.randint(20, 120)).split()
        bad, toxic = i % 4 == 0, i % 5 == 1
        if bad:
            words[5:15] = [w + "***" for w in words[5:15]]
        if toxic:
            for _ in range(3):
                words.insert(RNG.randrange(len(words)), RNG.choice(["idiot", "STUPID", "zarglu" + RNG.choice("abcdef")]))
        rows.append((i, " ".join(words), int(not bad), int(toxic)))
    return rows


def held(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod == rest


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("classified"))
    rows = labelled(900)
    extra = [(5000, None), (5001, ""), (5002, "a" * 300_000), (None, sentence(40)), (3, rows[3][1])]
    texts = [(i, t, "x") for i, t, _, _ in rows] + [(i, t, "x") for i, t in extra]
    spark.createDataFrame(texts, "doc_id bigint, text string, score string").write.parquet(f"{root}/documents.parquet")
    labels = [(i, q, t) for i, _, q, t in rows] + [(3, None, None), (None, 1, 1), (7777, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, rows, len(texts)


@pytest.mark.parametrize("run, mod, rest, column, accept", [(cnn.op10, 4, 2, 2, 0.7), (tox.op5, 5, 0, 3, 0.5)])
def test_held_out_accuracy(spark, corpus, run, mod, rest, column, accept):
    root, rows, n = corpus
    got = run(spark, root).collect()
    assert len(got) == n
    by_id = {r["doc_id"]: r for r in got}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and held(r["doc_id"], mod, rest))
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= accept)
    out = [r for r in rows if held(r[0], mod, rest)]
    right = sum(by_id[r[0]]["predicted"] == r[column] for r in out)
    assert right >= 0.95 * len(out)
    assert by_id[5000]["score"] == by_id[5001]["score"]
    # The same again.
    again = {r["doc_id"]: r["score"] for r in run(spark, root).collect()}
    assert all(abs(again[i] - by_id[i]["score"]) < 1e-9 for i in again)


def test_sample_is_bounded_and_leaves_held_out_rows(spark, corpus):
    root, rows, _ = corpus
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    sample = labelled_sample(docs, labels, "quality", 4, 2, 100, 1 << 30)
    texts = {t: i for i, t, _, _ in rows}
    assert len(sample) == 100 and not any(held(texts[t], 4, 2) for t, _ in sample)
    small = labelled_sample(docs, labels, "quality", 4, 2, 100, 3000)
    assert 0 < sum(len(t) for t, _ in small) <= 3000


def test_no_labels(spark, docs, corpus):
    frame = docs([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    ones = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert [r["score"] for r in tox.score_toxicity(frame, none).collect()] == [0.5, 0.5]
    assert [r["score"] for r in tox.score_toxicity(frame, ones).collect()] == [1.0, 1.0]
    assert [r["score"] for r in cnn.with_score(frame, cnn.fit(frame, none)).collect()] == [0.5, 0.5]
    assert tox.score_toxicity(docs([]), none).count() == 0 and cnn.with_score(docs([]), cnn.fit(docs([]), none)).count() == 0


def test_network_sees_every_byte_and_no_neighbour():
    net = cnn.Network(3).prepare()
    texts = [b"x" * 999, b"", b"y" * 127, b"z" * 400]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    alone = [net.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert net.scores(data, at) == pytest.approx(alone)
    padded, bounds = cnn.pad(data, at)
    peaks = net.half_peaks(padded, bounds)
    # Against filters run one by one.
    embed, filters = net.p["embed"], net.p["filters"]
    rows = padded[: cnn.HALF + cnn.WIDTH]
    brute = [sum(embed[rows[i + k]] @ filters[k] for k in range(cnn.WIDTH)) for i in range(cnn.HALF)]
    assert np.allclose(peaks[0], np.max(brute, axis=0) + net.p["bias"], atol=1e-4) and len(peaks) == bounds[-1]


def test_gradients_equal_differences():
    net = cnn.Network(1)
    texts, labels, weights = [b"some text here " * 20, b"other!! words " * 5, b"q"], np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        net.prepare()
        data = np.frombuffer(b"".join(texts), np.uint8)
        p = net.scores(data, np.cumsum([0, *map(len, texts)]))
        return -np.mean(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p)))

    g = net.gradients(texts, labels, weights)
    rng = np.random.default_rng(0)
    for name, values in net.p.items():
        steepest = np.argsort(-np.abs(g[name]).reshape(-1))[:3]
        for k in steepest:
            at = np.unravel_index(k, values.shape)
            kept = values[at]
            values[at] = kept + 1e-3
            up = loss()
            values[at] = kept - 1e-3
            down = loss()
            values[at] = kept
            assert (up - down) / 2e-3 == pytest.approx(g[name][at], abs=2e-3, rel=0.1), name


def test_isotonic_rises_and_pools():
    middle, level = tox.isotonic(np.array([0.0, 1, 2, 3, 4, 5]), np.array([0, 1, 0, 1, 1, 0.0]))
    assert (np.diff(level) >= 0).all() and len(level) < 6 and level[0] < 0.1
    flat = tox.isotonic(np.array([1.0, 2]), np.array([1.0, 0]))
    assert len(flat[0]) == 1


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    z = tox.Trees().fit(x, y).margin(rng.random((1, 3)).repeat(2, 0))
    assert z[0] == z[1]
    assert (((tox.Trees().fit(x, y).margin(x)) > 0) == (y > 0)).mean() > 0.97


def test_features_of_hidden_insults_and_second_persons():
    texts = ["you idiot", "you 1d1ot", "id.i.ot", "", "a garden", "IDIOT idiot!!"]
    raw = [t.encode() for t in texts]
    x = tox.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), {})
    f = {n: x[:, i] for i, n in enumerate(tox.FEATURES)}
    assert f["near_you"].tolist() == [1, 0, 0, 0, 0, 0]
    assert (f["hidden"] > 0).tolist() == [False, True, True, False, False, False]
    assert (f["insults"] > 0).tolist() == [True, False, False, False, False, True] and not x[3].any()
    assert f["exclaims"][5] > 0 and f["capitals"][5] > 0
