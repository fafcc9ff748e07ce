"""LM scoring: the probability of a text over all its segmentations into pieces of an existing unigram vocabulary.

A text is a sequence of words and an end. A word, with the mark of its beginning, is a lattice whose edges are vocabulary
pieces; a sign that no piece covers has one edge, the bytes of its fallback. The forward recursion in log space adds up
all paths, so no segmentation is chosen. No piece crosses a word's beginning, so a text's probability is the product over
its words, and each distinct word of the corpus is run through its lattice once.

The vocabulary's scores start the model: where they are ranks of merges, a piece of rank ``r`` starts at ``1 / (r + 2.7)``.
They are then re-estimated on the training words by rounds of expected counts (forward and backward), the start serving as
the prior. What is gathered from the corpus is a table of all its words with counts and probabilities, which grows with it
and is never held whole: documents are dealt to parts of bounded bytes, each part receives the rows of the words that occur
in it, and scores its documents from those. Only the vocabulary's piece counts reach the driver.

Defined results: null and empty texts are the end alone. A word never seen in training has a count of 0. Very long words
are whole lattices like others. Without training texts the start is the model and every count 0. Rows with a missing id
are training rows; repeated rows are scored and counted each.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import in_remainder, table, text_slices, written

#: A sentencepiece model with byte fallback; only the driver reads it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MOD, HELD_OUT = 7, 2
#: Bytes of text in a part, which bounds what a task holds: the part's words, one slice of texts.
PART_BYTES = 24 << 20
ROUNDS, PRIOR = 2, 1000.0
BEGIN = "▁"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LN10 = math.log(10)


class Pieces:
    """Log probabilities of pieces, of single bytes and of the end; natural logarithms."""

    def __init__(self, log_p: dict[str, float], log_byte: list[float], log_end: float):
        self.log_p, self.log_byte, self.log_end = log_p, log_byte, log_end
        self.longest = max(map(len, log_p), default=1)

    def sign(self, c: str) -> float:
        """The one edge of a sign that is no piece."""
        return sum(self.log_byte[b] for b in c.encode("utf-8", "surrogatepass"))

    def edges(self, text: str):
        """For each end position: the begin positions and log probabilities of the edges that reach it."""
        get, longest = self.log_p.get, self.longest
        for j in range(1, len(text) + 1):
            found = [(i, p) for i in range(max(0, j - longest), j) if (p := get(text[i:j])) is not None]
            if not found or found[-1][0] != j - 1:
                found.append((j - 1, self.sign(text[j - 1])))
            yield found

    def forward(self, text: str) -> list[float]:
        """Log probability of all paths to each position."""
        exp, log = math.exp, math.log
        reach = [0.0]
        for found in self.edges(text):
            terms = [reach[i] + p for i, p in found]
            top = max(terms)
            reach.append(top if len(terms) == 1 else top + log(sum([exp(t - top) for t in terms])))
        return reach

    def expected(self, text: str, weight: float, counts: dict, byte_counts: np.ndarray) -> None:
        """Adds ``weight`` times the expected number of uses of each piece in ``text``."""
        exp, log = math.exp, math.log
        edges = list(self.edges(text))
        reach = self.forward(text)
        n = len(text)
        whole = reach[n]
        back = [0.0] * (n + 1)
        out: list[list] = [[] for _ in range(n)]
        for j, found in enumerate(edges, 1):
            for i, p in found:
                out[i].append((j, p))
        for i in range(n - 1, -1, -1):
            terms = [back[j] + p for j, p in out[i]]
            top = max(terms, default=-math.inf)
            back[i] = top if len(terms) < 2 else top + log(sum([exp(t - top) for t in terms]))
        for i in range(n):
            for j, p in out[i]:
                share = weight * exp(min(0.0, reach[i] + p + back[j] - whole))
                piece = text[i:j]
                if piece in self.log_p:
                    counts[piece] = counts.get(piece, 0.0) + share
                else:
                    for b in piece.encode("utf-8", "surrogatepass"):
                        byte_counts[b] += share


class Lattices:
    """The lattices of many words at once: words of one length are rows of a matrix, edges are columns.

    Words are bytes, with a blank for the mark of a beginning; pieces are found by a hash of their bytes. A sign that no
    piece covers has an edge per byte, which multiplies to its one edge. Words over ``LONG`` bytes are run one by one.
    """

    LONG, ROWS = 64, 4096
    _P = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.names = sorted(pieces.log_p)
        spelled = [p.replace(BEGIN, " ").encode() for p in self.names]
        hashes = np.array([self._hash(p) for p in spelled], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.log_p = np.array([pieces.log_p[self.names[k]] for k in order])
        self.log_byte = np.array(pieces.log_byte)
        self.longest = max(map(len, spelled), default=1)

    @classmethod
    def _hash(cls, data: bytes) -> int:
        h = 0
        for b in data:
            h = (h * int(cls._P) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _edges(self, m: np.ndarray):
        """``(i, j): (log probability or -inf, place of the piece or -1)``, and which bytes have an edge of their own."""
        n = m.shape[1]
        edges = {}
        covered = np.zeros(m.shape, bool)
        lead = np.ones((len(m), n + 1), bool)
        lead[:, :n] = (m & 0xC0) != 0x80
        for i in range(n):
            h = np.zeros(len(m), np.uint64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                with np.errstate(over="ignore"):
                    h = h * self._P + m[:, j - 1].astype(np.uint64) + np.uint64(1)
                place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                hit = self.hashes[place] == h
                if hit.any():
                    edges[i, j] = np.where(hit, self.log_p[place], -np.inf), np.where(hit, place, -1)
                    # A piece of exactly one sign covers that sign's bytes.
                    if j - i <= 4:
                        one = hit & lead[:, i] & lead[:, j] & ~lead[:, i + 1 : j].any(axis=1)
                        covered[one, i:j] = True
        return edges, ~covered

    def _forward(self, m, edges, single):
        n = m.shape[1]
        into = [[] for _ in range(n + 1)]
        for i, j in edges:
            into[j].append(i)
        reach = np.full((n + 1, len(m)), -np.inf)
        reach[0] = 0
        for j in range(1, n + 1):
            total = np.where(single[:, j - 1], reach[j - 1] + self.log_byte[m[:, j - 1]], -np.inf)
            for i in into[j]:
                total = np.logaddexp(total, reach[i] + edges[i, j][0])
            reach[j] = total
        return reach

    def _groups(self, words: list[bytes]):
        """Places of words and their matrix, by length."""
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        for n, places in by_length.items():
            for at in range(0, len(places), self.ROWS):
                part = places[at : at + self.ROWS]
                if n > self.LONG:
                    yield part, None
                    continue
                rows = np.frombuffer(b"".join(b" " + words[k] for k in part), np.uint8)
                yield part, rows.reshape(len(part), n + 1)

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        out = np.zeros(len(words))
        for part, m in self._groups(words):
            if m is None:
                out[part] = [self.pieces.forward(BEGIN + words[k].decode("utf-8", "replace"))[-1] for k in part]
            else:
                out[part] = self._forward(m, *self._edges(m))[-1]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected uses of the pieces in ``names``, and of bytes, by words that occur ``weights`` times."""
        counts, by_byte = np.zeros(len(self.names)), np.zeros(256)
        for part, m in self._groups(words):
            weight = weights[part].astype(float)
            if m is None:
                found: dict[str, float] = {}
                for k, w in zip(part, weight):
                    self.pieces.expected(BEGIN + words[k].decode("utf-8", "replace"), w, found, by_byte)
                for k, name in enumerate(self.names if found else []):
                    counts[k] += found.get(name, 0.0)
                continue
            edges, single = self._edges(m)
            reach = self._forward(m, edges, single)
            n = m.shape[1]
            out_of = [[] for _ in range(n + 1)]
            for i, j in edges:
                out_of[i].append(j)
            back = np.full((n + 1, len(m)), -np.inf)
            back[n] = 0
            for i in range(n - 1, -1, -1):
                byte = np.where(single[:, i], self.log_byte[m[:, i]], -np.inf)
                total = byte + back[i + 1]
                share = weight * np.exp(reach[i] + byte + back[i + 1] - reach[n])
                by_byte += np.bincount(m[:, i], share, 256)
                for j in out_of[i]:
                    log_p, place = edges[i, j]
                    step = log_p + back[j]
                    total = np.logaddexp(total, step)
                    hit = place >= 0
                    share = weight[hit] * np.exp((reach[i] + step - reach[n])[hit])
                    counts += np.bincount(self.numbers[place[hit]], share, len(counts))
                back[i] = total
        return counts, by_byte


def load_vocabulary(path: str) -> Pieces:
    """Pieces of a sentencepiece model. Scores that are log probabilities stay; ranks become ``1 / (rank + 2.7)``."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, scores = {}, []
    for i in range(model.vocab_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = model.get_score(i)
            scores.append(model.get_score(i))
    if all(s == int(s) for s in scores):
        pieces = {k: -math.log(-s + 2.7) for k, s in pieces.items()}
    least = min(pieces.values())
    return _normalised({k: math.exp(v) for k, v in pieces.items()}, np.full(256, math.exp(least)), math.exp(max(pieces.values())))


def _normalised(piece: dict[str, float], byte: np.ndarray, end: float) -> Pieces:
    total = math.log(sum(piece.values()) + float(byte.sum()) + end)
    return Pieces({k: math.log(v) - total for k, v in piece.items()}, [math.log(b) - total for b in byte],
                  math.log(end) - total)


def _count_words(batches):
    """``part, word, n, seen``: occurrences in training texts, and in all. A part comes to one task, piece by piece."""
    seen: dict[int, tuple[Counter, Counter]] = {}

    def flush():
        for part, (train, other) in seen.items():
            words = list(train.keys() | other.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(words), pa.int32()), pa.array(words, pa.binary()),
                 pa.array([train[w] for w in words], pa.int64())], names=["part", "word", "n"])
        seen.clear()

    for batch, data, at in text_slices(batches):
        raw = data.tobytes().translate(_LOWER)
        for i, j, part, held in zip(at, at[1:], batch.column("part").to_pylist(), batch.column("held_out").to_pylist()):
            if part not in seen:
                if len(seen) > 3:
                    yield from flush()
                seen[part] = (Counter(), Counter())
            seen[part][held].update(raw[i:j].split())
    yield from flush()


#: Words that are run together; with fewer, the matrices of the rarer lengths would be mostly overhead.
WORDS_AT_ONCE = 1 << 17


def _gathered(batches, rows: int = WORDS_AT_ONCE):
    """Record batches joined to about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _expected_counts(pieces: Pieces):
    def run(batches):
        lattices = Lattices(pieces)
        counts, by_byte = np.zeros(len(lattices.names)), np.zeros(256)
        for batch in _gathered(batches):
            more, bytes_ = lattices.expected(batch.column("word").to_pylist(), np.asarray(batch.column("n")))
            counts += more
            by_byte += bytes_
        used = np.flatnonzero(counts)
        names = [lattices.names[k] for k in used] + [f"<{b}>" for b in range(256)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([0] * len(used) + [1] * 256, pa.int32()),
             pa.array(np.concatenate([counts[used], by_byte]), pa.float64())], names=["piece", "is_byte", "expected"])

    return run


def reestimate(words: DataFrame, start: Pieces, ends: int, rounds: int = ROUNDS, prior: float = PRIOR) -> Pieces:
    """Pieces after rounds of expected counts over ``word, n``; at most a row per piece and byte reaches the driver."""
    pieces = start
    for _ in range(rounds):
        counted = words.filter("n > 0").select("word", "n").mapInArrow(
            _expected_counts(pieces), "piece string, is_byte int, expected double")
        found = counted.groupBy("piece", "is_byte").agg(F.sum("expected").alias("expected")).collect()
        got = {(r["piece"], r["is_byte"]): r["expected"] for r in found}
        piece = {k: got.get((k, 0), 0.0) + prior * math.exp(p) for k, p in start.log_p.items()}
        byte = np.array([got.get((f"<{b}>", 1), 0.0) + prior * math.exp(p) for b, p in enumerate(start.log_byte)])
        pieces = _normalised(piece, byte, ends + prior * math.exp(start.log_end))
    return pieces


def _word_scores(pieces: Pieces):
    def run(batches):
        lattices = Lattices(pieces)
        for batch in _gathered(batches):
            scores = lattices.scores(batch.column("word").to_pylist()) / _LN10
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(scores, pa.float64())], names=["word", "n", "score"])

    return run


def _score_parts(total: int, distinct: int, ends: int, end_score: float, keep: list[str]):
    """Rows come by part: its words first, then its documents."""
    below = math.log10(total + distinct + 1)

    def run(batches):
        part, place = None, {}
        ns: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        bases = known = tables = None
        for batch, data, at in text_slices(batches):
            parts = np.asarray(batch.column("part"))
            kinds = np.asarray(batch.column("kind"))
            edges = np.flatnonzero(np.diff(parts) | np.diff(kinds)) + 1
            raw = data.tobytes().translate(_LOWER)
            for i, j in zip([0, *edges], [*edges, len(parts)]):
                if i == j:
                    continue
                if parts[i] != part:
                    part, place, ns, scores, tables = parts[i], {}, [], [], None
                if kinds[i] == 0:
                    rows = batch.slice(i, j - i)
                    for word in rows.column("word").to_pylist():
                        place[word] = len(place)
                    ns.append(np.asarray(rows.column("n")))
                    scores.append(np.asarray(rows.column("score")))
                    continue
                if tables is None:
                    n = np.concatenate([*ns, [ends]])
                    bases = np.log10(n + 1.0) - below
                    known = (n > 0).astype(np.float64)
                    tables = np.stack([bases, known, np.concatenate([*scores, [end_score]])], axis=1)
                    place[b""] = len(n) - 1  # no word is empty: the end
                out = np.zeros((j - i, 4))
                for k in range(i, j):
                    words = raw[at[k] : at[k + 1]].split()
                    words.append(b"")
                    ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    out[k - i, :3] = tables[ids].sum(axis=0)
                    out[k - i, 3] = len(words)
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in keep]
                    + [pa.array(out[:, 3].astype(np.int64)), pa.array(np.rint(out[:, 1]).astype(np.int64)),
                       pa.array(np.full(j - i, total, np.int64)), pa.array(out[:, 0]), pa.array(out[:, 2])],
                    names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", in_remainder("doc_id", MOD, HELD_OUT).alias("held_out"), text.alias("text"))
    size = rows.agg(
        F.sum(F.octet_length("text").cast("bigint")), F.count_if(~F.col("held_out")), F.count(F.lit(1))
    ).first()
    ends, parts = size[1], max(1, -(-(size[0] or 0) // part_bytes))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part")
    dealt = rows.select(part, "held_out", "text")
    in_parts = written(
        dealt.repartitionById(parts, F.col("part")).mapInArrow(_count_words, "part int, word binary, n bigint")
        .groupBy("part", "word").agg(F.sum("n").alias("n")), "part-words",
    )
    counts = written(in_parts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    totals = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    total, distinct = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    start = load_vocabulary(vocabulary)
    pieces = reestimate(counts, start, ends) if ends else start
    scored = written(counts.mapInArrow(_word_scores(pieces), "word binary, n bigint, score double"), "word-scores")

    needed = in_parts.select("part", "word").join(scored, "word").select(
        "part", F.lit(0).alias("kind"), "word", "n", "score",
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"),
        F.lit("").alias("text"),
    )
    texts = rows.select(
        part, F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("word"), F.lit(None).cast("bigint").alias("n"),
        F.lit(None).cast("double").alias("score"), "doc_id", "held_out", "text",
    )
    together = needed.unionByName(texts).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")
    return together.mapInArrow(
        _score_parts(total, distinct, ends, pieces.log_end / _LN10, ["doc_id", "held_out"]),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
        "score double",
    )


@query("op6_lattice_lm")
def op6(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"))
