"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are embedded, and learned filters slide over every byte of the whole text. Each filter's response is
max-pooled within overlapping chunks (a chunk starts every half chunk); a hidden layer reads each chunk, is max-pooled
over all chunks and combined into one probability. Embedding and filter meet in one table per pair of filter positions,
so a response is three table rows added up, and memory is bounded by a tile of positions.

The network is trained on the driver on a bounded sample of labelled rows (``SAMPLE_ROWS``, ``SAMPLE_BYTES``); scoring is
one pass over all texts in the tasks.

Defined results: a null or empty text is one chunk of padding and gets that chunk's score. Without labelled rows of both
classes the score is the share of label 1, or 0.5 without any. Rows are scored one by one, so repeated rows and missing
ids keep a row each (a missing id is not held out). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.samples import labelled_sample
from filedrop.llm.text import in_remainder, table, text_slices

#: Most labelled rows, and most bytes of their texts, that the network is trained on.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 16 << 20

HALF = 128  # bytes; a chunk is two halves and starts at every half
WIDTH = 6  # bytes a filter sees
EMBEDDED, FILTERS, HIDDEN = 8, 16, 16
TILE = 1 << 15  # positions handled at once
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.01, 7
MOD, HELD_OUT, ACCEPT = 4, 2, 0.7


def pad(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts padded with zero bytes to whole halves of their own; and bounds in halves."""
    n = np.diff(at)
    halves = np.maximum(1, -(-(n + WIDTH - 1) // HALF))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(halves, out=bounds[1:])
    out = np.zeros(bounds[-1] * HALF + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(bounds[:-1] * HALF - at[:-1], n)] = data
    return out, bounds


class Network:
    """``embed`` bytes, ``filters`` over WIDTH of them, ``hidden`` over a chunk's peaks, ``out`` over the text's peaks."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBEDDED)),
            "filters": rng.normal(0, 0.25, (WIDTH, EMBEDDED, FILTERS)),
            "bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, 0.3, (FILTERS, HIDDEN)),
            "hidden_bias": np.full(HIDDEN, 0.1),
            "out": rng.normal(0, 0.3, HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.constant: float | None = None
        self.tables = None

    def prepare(self) -> Network:
        """Tables of the response to every pair of neighbouring bytes, by position in the filter."""
        single = np.einsum("be,kef->kbf", self.p["embed"], self.p["filters"]).astype(np.float32)
        single[0] += self.p["bias"].astype(np.float32)
        self.tables = [
            (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)
        ]
        return self

    def half_peaks(self, padded: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Largest response of each filter within each half.

        The last positions of a text are padding only and would see the next text; they do not count.
        """
        n = len(padded) - WIDTH
        last = np.zeros(n // HALF, bool)
        last[bounds[1:] - 1] = True
        pairs = (padded[:-1].astype(np.int32) << 8) | padded[1:]
        peaks = np.empty((n // HALF, FILTERS), np.float32)
        for i in range(0, n, TILE):
            j = min(n, i + TILE)
            response = self.tables[0][pairs[i:j]]
            for k in range(1, WIDTH // 2):
                response += self.tables[k][pairs[i + 2 * k : j + 2 * k]]
            by_half = response.reshape(-1, HALF, FILTERS)
            by_half[last[i // HALF : j // HALF], 1 - WIDTH :] = -np.inf
            by_half.max(axis=1, out=peaks[i // HALF : j // HALF])
        return peaks

    def chunk_peaks(self, padded: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Peaks of the chunk that starts at each half, never across texts; the last chunk of a text is one half."""
        peaks = self.half_peaks(padded, bounds)
        chunks = peaks.copy()
        follows = np.ones(len(peaks), bool)
        follows[bounds[1:] - 1] = False
        at = np.flatnonzero(follows)
        chunks[at] = np.maximum(peaks[at], peaks[at + 1])
        return np.maximum(chunks, 0)

    def hidden(self, chunks: np.ndarray) -> np.ndarray:
        return np.maximum(chunks @ self.p["hidden"].astype(np.float32) + self.p["hidden_bias"].astype(np.float32), 0)

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(at) - 1, self.constant)
        padded, bounds = pad(data, at)
        hidden = self.hidden(self.chunk_peaks(padded, bounds))
        top = np.maximum.reduceat(hidden, bounds[:-1], axis=0) if len(at) > 1 else np.zeros((0, HIDDEN))
        z = top.astype(np.float64) @ self.p["out"] + self.p["out_bias"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted logistic loss; only the chunks that won a maximum are run backwards."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = np.cumsum([0, *map(len, texts)])
        padded, bounds = pad(data, at)
        self.prepare()
        chunks = self.chunk_peaks(padded, bounds)
        hidden = self.hidden(chunks)
        n = len(texts)
        winner = np.stack([hidden[i:j].argmax(axis=0) + i for i, j in zip(bounds, bounds[1:])])
        top = hidden[winner, np.arange(HIDDEN)].astype(np.float64)
        z = top @ self.p["out"] + self.p["out_bias"]
        error = weights * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        g = {"out": error @ top, "out_bias": error.sum(keepdims=True)}
        back = error[:, None] * self.p["out"] * (top > 0)
        used, place = np.unique(winner, return_inverse=True)
        at_hidden = np.zeros((len(used), HIDDEN))
        np.add.at(at_hidden, (place.reshape(winner.shape), np.arange(HIDDEN)), back)
        seen = chunks[used].astype(np.float64)
        g["hidden"], g["hidden_bias"] = seen.T @ at_hidden, at_hidden.sum(axis=0)
        at_peak = (at_hidden @ self.p["hidden"].T) * (seen > 0)
        # The chunk's bytes again, to find where each filter peaked.
        last = bounds[1:] - 1
        window = np.where(np.isin(used, last), HALF, 2 * HALF)
        window[np.isin(used, last) | np.isin(used + 1, last)] -= WIDTH - 1
        grid = used[:, None] * HALF + np.minimum(np.arange(2 * HALF), window[:, None] - 1)
        pairs = (padded[:-1].astype(np.int32) << 8) | padded[1:]
        response = self.tables[0][pairs[grid]]
        for k in range(1, WIDTH // 2):
            response += self.tables[k][pairs[grid + 2 * k]]
        peak = np.take_along_axis(grid, response.argmax(axis=1), axis=1)
        g["bias"] = at_peak.sum(axis=0)
        at_table = np.zeros((WIDTH, 256, FILTERS))
        for k in range(WIDTH):
            np.add.at(at_table[k], (padded[peak + k], np.arange(FILTERS)), at_peak)
        g["filters"] = np.einsum("be,kbf->kef", self.p["embed"], at_table)
        g["embed"] = np.einsum("kbf,kef->be", at_table, self.p["filters"])
        return g


def train(sample: list[tuple[str, int]], seed: int = SEED, epochs: int = EPOCHS) -> Network:
    """Adam over shuffled batches; both classes weigh the same in total, softened by a root."""
    net = Network(seed)
    labels = np.array([y for _, y in sample], float)
    if len(set(labels.tolist())) < 2:
        net.constant = float(labels.mean()) if len(labels) else 0.5
        return net
    texts = [x.encode() for x, _ in sample]
    share = labels.mean()
    weights = np.where(labels > 0, np.sqrt(0.5 / share), np.sqrt(0.5 / (1 - share)))
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    # A small sample gets more rounds, so that the number of steps does not depend on it much.
    epochs = max(epochs, -(-epochs * 1000 // len(texts)))
    step, steps = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            pick = order[i : i + BATCH]
            g = net.gradients([texts[k] for k in pick], labels[pick], weights[pick])
            step += 1
            rate = RATE * min(1, step / 50) * (1 - 0.95 * step / steps)
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                net.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    net.tables = None
    return net


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Network:
    """A network for ``labels.quality``, from rows outside the held-out remainder."""
    return train(labelled_sample(docs, labels, "quality", MOD, HELD_OUT, rows, max_bytes))


def with_score(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of its ``text``, which replaces a column of that name."""
    keep = [c for c in docs.columns if c != name]
    schema = docs.select(*keep).schema.add(name, "double")

    def run(batches):
        net.prepare()
        for batch, data, at in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(net.scores(data, at), pa.float64())], names=[*keep, name]
            )

    return docs.select(*keep).mapInArrow(run, schema)


@query("op10_byte_cnn_quality")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs, net)
    return scored.select(
        "doc_id",
        in_remainder("doc_id", MOD, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
