"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of two lexicons (insults that are stated, and word beginnings learned from the
training rows), how close insults stand to a second person, capitals, punctuation, and obfuscation (words that only read
as insults once signs are put back to letters). One pass makes them, held as a narrow table; trees and calibration are
fitted on the driver on a bounded sample of training rows, and scored in a second pass over the narrow table.

The word beginnings are chosen by log-odds of documents in training rows; the choice, trees and calibration see no row of
the held-out remainder. Trees grow on three quarters of the sample, the isotonic curve is fitted on the rest.

Defined results: null and empty texts have zero features and get the score of those. Without training rows of both
classes every score is the share of label 1, or 0.5 without any. Repeated rows and missing ids keep a row each (a missing
id is not held out). Only ``doc_id`` and ``text`` are read of the documents.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.samples import training_labels
from filedrop.llm.text import in_remainder, table, text_slices, written

MOD, HELD_OUT = 5, 0
#: Most labelled rows that the lexicon, and the trees and the calibration, are fitted on.
SAMPLE_ROWS = 20_000
#: Word beginnings learned, lengths in bytes, and toxic documents in which one must occur.
LEARNED, LENGTHS, LEAST_DOCS = 500, (4, 5, 6, 8), 8
NEAR = 5  # words between an insult and a second person

# Common insults, by language.
INSULTS = """
idiot idiots stupid moron morons loser losers scum trash pathetic worthless disgusting clown clowns dumb dumbass fool
fools jerk bastard bastards bitch bitches asshole assholes shit bullshit crap fuck fucking fucker cunt dick prick slut
whore retard retarded imbecile cretin freak creep pig pigs swine vermin filth garbage ugly coward liar hate
idiota estúpido imbécil basura tonto inútil asqueroso patético mierda puta cabrón pendejo
crétin connard salaud ordure débile abruti pathétique merde pute
dummkopf trottel arschloch abschaum blödmann widerlich wertlos schwein scheisse hure
""".split()
# Second persons.
SECOND = "you your yours yourself u ur youre du dich dir dein deine euch euer tu te toi ton ta vous votre usted ustedes tus".split()
# Signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = ["insults", "insult_density", "learned", "learned_density", "learned_weight", "near_you", "you_density",
            "capitals", "capital_words", "exclaims", "questions", "punctuation", "hidden", "hidden_density", "log_words"]

_LETTERS = set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'") | set(range(128, 256))


def _plain_table() -> bytes:
    """Lower case, anything but letters a blank; bytes above ASCII stay."""
    return bytes((ord(chr(b).lower()) if b < 128 else b) if b in _LETTERS and b != 0x27 else 0x20 for b in range(256))


def _leet_table() -> bytes:
    """As above, but signs that stand for letters become those letters."""
    out = bytearray(_plain_table())
    for sign, letter in LEET.items():
        out[ord(sign)] = ord(letter)
    return bytes(out)


PLAIN, READ = _plain_table(), _leet_table()
_DROPPED = b"*.-_'#%&+~^`|"  # signs put between or for letters
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_ALPHA = _UPPER.copy()
_ALPHA[97:123] = 1
_PUNCTUATION = np.zeros(256, np.int64)
_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 1


def beginnings(raw: bytes) -> set[bytes]:
    """Distinct word beginnings of a text, a word of three letters or fewer excluded."""
    words = set(raw.translate(PLAIN).split())
    return {w[:n] for n in LENGTHS for w in words if len(w) >= n}


def learn_lexicon(texts: DataFrame) -> dict[bytes, float]:
    """``beginning: weight`` of the beginnings that tell toxic documents (``text, label``) from others best."""

    def count(batches):
        seen: dict[bytes, list[int]] = {}

        def flush():
            keys = list(seen)
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array([seen[k][0] for k in keys], pa.int64()),
                 pa.array([seen[k][1] for k in keys], pa.int64())], names=["term", "clean", "toxic"])
            seen.clear()
            return out

        for batch, data, at in text_slices(batches):
            raw = data.tobytes()
            for i, j, y in zip(at, at[1:], batch.column("label").to_pylist()):
                for term in beginnings(raw[i:j]):
                    seen.setdefault(term, [0, 0])[y] += 1
                if len(seen) > 300_000:
                    yield flush()
        yield flush()

    counted = texts.select("text", "label").mapInArrow(count, "term binary, clean bigint, toxic bigint")
    totals = texts.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in totals}
    if not n.get(0) or not n.get(1):
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    best = (
        counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= LEAST_DOCS).withColumn("odds", odds).filter("odds > 2")
        .orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "term").limit(LEARNED)
    )
    return {bytes(r["term"]): r["odds"] for r in best.collect()}


def features(data: np.ndarray, at: np.ndarray, lexicon: dict[bytes, float]) -> np.ndarray:
    """``(texts, FEATURES)`` of float64."""
    insults = {w.encode() for w in INSULTS}
    second = {w.encode() for w in SECOND}
    lengths = sorted({len(k) for k in lexicon}, reverse=True)
    get = lexicon.get
    raw = data.tobytes()
    out = np.zeros((len(at) - 1, len(FEATURES)))
    for t, (i, j) in enumerate(zip(at, at[1:])):
        text = raw[i:j]
        words = text.translate(PLAIN).split()
        n = len(words)
        if not n:
            continue
        distinct = set(words)
        place = {}
        if not distinct.isdisjoint(insults):
            place = {k for k, w in enumerate(words) if w in insults}
        weights = []
        if lengths:
            known = {}
            for w in distinct:
                odds = max((get(w[:m], 0.0) for m in lengths if len(w) >= m), default=0.0)
                if odds:
                    known[w] = odds
            if known:
                weights = [known[w] for w in words if w in known]
        you = [k for k, w in enumerate(words) if w in second] if not distinct.isdisjoint(second) else []
        near = sum(1 for k in you if any(p in place for p in range(k - NEAR, k + NEAR + 1))) if place else 0
        read = text.translate(READ, _DROPPED).split()
        hidden = sum(1 for w in read if w in insults) if not set(read).isdisjoint(insults) else 0
        hidden = max(0, hidden - len(place))
        out[t, :7] = (math.log1p(len(place)), 100 * len(place) / n, math.log1p(len(weights)), 100 * len(weights) / n,
                      sum(weights) / len(weights) if weights else 0, near, 100 * len(you) / n)
        out[t, 12:] = math.log1p(hidden), 100 * hidden / n, math.log(n)
    size = np.maximum(np.diff(at), 1)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[at])
    capital = _UPPER[data]
    run = capital.copy()
    run[1:] &= capital[:-1]
    out[:, 7] = total(capital) / np.maximum(total(_ALPHA[data]), 1)
    out[:, 8] = total(run) / size
    out[:, 9] = 100 * total((data == 0x21).astype(np.int64)) / size
    out[:, 10] = 100 * total((data == 0x3F).astype(np.int64)) / size
    out[:, 11] = total(_PUNCTUATION[data]) / size
    return out


class Trees:
    """Logistic boosting of small trees on binned features; the predictions of a tree are looked up for all rows at once."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, least: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        ranks = np.linspace(0, 1, self.bins + 1)[1:-1]
        # Most texts have no insult at all: quantiles of the values that do occur keep edges among those that have.
        self.edges = [np.unique(np.concatenate([np.quantile(np.unique(c), ranks), np.quantile(c, ranks)])) for c in x.T]
        b = self._binned(x)
        width = max(len(e) for e in self.edges) + 1
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = math.log(share / (1 - share))
        z = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            z += self._grow(b, y - p, np.maximum(p * (1 - p), 1e-9), width)
        return self

    def _grow(self, b, gradient, hessian, width):
        nodes = (1 << self.depth) - 1
        feature, split = np.zeros(nodes, np.int64), np.full(nodes, width, np.int64)
        at = np.zeros(len(b), np.int64)
        for level in range(self.depth):
            first = (1 << level) - 1
            local = at - first
            count = 1 << level
            best = np.full(count, 1e-6)
            for f in range(b.shape[1]):
                cell = local * width + b[:, f]
                g = np.bincount(cell, gradient, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(cell, hessian, count * width).reshape(count, width).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (gt - g) ** 2 / (ht - h + 1) - gt**2 / (ht + 1)
                gain[(h < self.least) | (ht - h < self.least)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(count), k]
                better = top > best
                best[better], feature[first:][:count][better] = top[better], f
                split[first:][:count][better] = k[better]
            at = 2 * at + 1 + (b[np.arange(len(b)), feature[at]] > split[at])
        leaf = at - nodes
        g = np.bincount(leaf, gradient, 1 << self.depth)
        h = np.bincount(leaf, hessian, 1 << self.depth)
        value = self.rate * g / (h + 1)
        self.trees.append((feature, split, value))
        return value[leaf]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, split, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, feature[at]] > split[at])
            z += value[at - len(feature)]
        return z


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of the label's share over the margin, pooling neighbours that fall; each step is smoothed a little."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first margin, last margin
    for value, label in zip(z[order], y[order]):
        blocks.append([label, 1, value, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = hi
    middle = np.array([(lo + hi) / 2 for _, _, lo, hi in blocks])
    level = np.array([(s + 0.05) / (n + 0.1) for s, n, _, _ in blocks])
    return middle, np.maximum.accumulate(level)


class Model:
    """Lexicon, trees and calibration; ``constant`` where there is nothing to tell classes apart."""

    def __init__(self, lexicon, trees=None, curve=None, constant=None):
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self.trees.margin(x)
        calibrated = np.interp(z, *self.curve)
        # Within a step the margin still orders rows, without leaving the step's side of one half.
        tilt = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return np.where(calibrated >= 0.5, np.maximum(0.5, 0.98 * calibrated + 0.02 * tilt),
                        np.minimum(0.4999, 0.98 * calibrated + 0.02 * tilt))


def _with_features(texts: DataFrame, keep: list[str], lexicon: dict[bytes, float]) -> DataFrame:
    schema = texts.select(*keep).schema.add("features", "binary")

    def run(batches):
        for batch, data, at in text_slices(batches):
            x = features(data, at, lexicon)
            columns = [batch.column(c) for c in keep] + [pa.array([row.tobytes() for row in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "features"])

    return texts.select(*keep, "text").mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    known = training_labels(labels, "toxic", MOD, HELD_OUT)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = written(known.orderBy(*by_hash).limit(rows), "toxic-sample")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lexicon = learn_lexicon(texts.join(sample, "doc_id"))
    narrow = written(_with_features(texts, ["doc_id"], lexicon), "toxic-features")
    # Repeated ids repeat features, so the sample is held to its bound once more.
    fitted = narrow.join(sample, "doc_id").orderBy(*by_hash, "features").limit(rows).collect()
    x = np.frombuffer(b"".join(r["features"] for r in fitted)).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in fitted], float)
    if len(set(y.tolist())) < 2:
        model = Model(lexicon, constant=float(y.mean()) if len(y) else 0.5)
    else:
        rest = np.array([zlib.crc32(str(r["doc_id"]).encode()) // MOD % 4 == 0 for r in fitted])
        if len(set(y[rest].tolist())) < 2 or len(set(y[~rest].tolist())) < 2:
            rest[:] = False
        trees = Trees().fit(x[~rest], y[~rest])
        on = rest if rest.any() else ~rest
        model = Model(lexicon, trees, isotonic(trees.margin(x[on]), y[on]))

    def run(batches):
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("features").to_pylist())).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(values), pa.float64())], names=["doc_id", "score"])

    return narrow.mapInArrow(run, narrow.select("doc_id").schema.add("score", "double"))


@query("op5_boosted_toxicity")
def op5(spark, sf_dir):
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", in_remainder("doc_id", MOD, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
