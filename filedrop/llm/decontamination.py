"""Benchmark decontamination: a BM25 index of test items, asked by every passage of every document with block-max WAND.

Terms are pairs of neighbouring words, which passages of other texts hardly share. A term's weight in an item is its BM25
impact, divided by the item's score against itself, so scores lie between 0 and 1
and one threshold fits items of all lengths. Passages are windows of twice the longest item, each starting one such
length after the last, so an item that a document holds lies whole in one of them. All items above the threshold are
retrieved, none is capped: passages whose terms cannot reach it in any group of items are set aside by running sums over
whole slices of documents; the rest run WAND, which moves to the first item that the terms' maxima could lift over the
threshold and scores it only if the maxima of its blocks could, too.

A retrieved item is verified in the passage: at least ``OVERLAP`` of the three-word windows of its question, and of its
answer, must occur there.

The index of a shard of items is bounded by ``SHARD_BYTES`` and goes to all tasks; a larger benchmark takes one pass over
the documents per shard. Documents are never shuffled. Items of very different lengths have passages of their own.

Defined results: null and empty texts have no passage and match nothing; items of one word or none are never matched, as
they have no pair. Words are runs of letters, digits and signs beyond ASCII, in lower case. An item of one sentence is split after two thirds of its
words. Repeated documents give repeated rows, repeated items a row each; missing ids are given back as they are.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import table, utf8, written

#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.5
#: Share of the question's and of the answer's windows of ``SHINGLE`` words that must occur in the passage.
OVERLAP, SHINGLE = 0.5, 3
K1, B = 1.2, 0.75
#: Items per block of the index, groups of blocks in the running sums, bytes of items per shard.
BLOCK, GROUPS, SHARD_BYTES = 16, 8, 8 << 20
SLICE_BYTES = 4 << 20

_ASCII_WORDS = bytes(b if b > 127 or chr(b).isalnum() else 0x20 for b in range(256))


def folded(texts: pa.Array) -> pa.Array:
    """Texts in the letters that words are compared in; items and passages take the same way.

    Every letter by itself, so a capital sigma is the same letter at the end of a word as within it.
    """
    return pc.replace_substring(pc.utf8_lower(texts), "\u03c2", "\u03c3")


def words_of(lowered: bytes) -> list[bytes]:
    return lowered.translate(_ASCII_WORDS).split()


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer; an item of one sentence is split after two thirds of its words."""
    marks = [i + 1 for i, c in enumerate(text) if c in ".!?\n" and text[i + 1 :].strip()]
    if marks and text[: marks[-1]].strip(" .!?\n"):
        return text[: marks[-1]], text[marks[-1] :]
    words = text.split(" ")
    cut = max(1, 2 * len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Item:
    def __init__(self, item_id, question: str, answer: str):
        self.item_id = item_id
        self.question, self.answer = (words_of(x.as_py().encode()) for x in folded(pa.array([question, answer], pa.string())))
        self.words = self.question + self.answer

    def pairs(self) -> set[bytes]:
        return {a + b" " + b for a, b in zip(self.words, self.words[1:])}

    def overlap(self, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the question's and the answer's windows that occur in the passage; an empty part is all there."""
        out = []
        for part in (self.question, self.answer):
            mine = _shingles(part)
            n = min(SHINGLE, len(part))
            there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)} if n else set()
            out.append(len(mine & there) / len(mine) if mine else 1.0)
        return out[0], out[1]


class Counts:
    """Items, their mean length in words, and the items that hold each pair of words: of the whole benchmark."""

    def __init__(self, items: int, mean: float, holding: dict[bytes, int]):
        self.items, self.mean, self.holding = items, mean, holding

    @classmethod
    def of(cls, items: list[Item]) -> "Counts":
        holding: dict[bytes, int] = defaultdict(int)
        for item in items:
            for pair in item.pairs():
                holding[pair] += 1
        return cls(len(items), sum(len(i.words) for i in items) / max(1, len(items)), holding)

    def weight(self, pair: bytes) -> float:
        n = self.holding[pair]
        return math.log(1 + (self.items - n + 0.5) / (n + 0.5))


class Index:
    """Postings of items of similar length, with maxima of terms, of their blocks and of groups of blocks.

    ``pairs`` gives the number of a pair of word numbers, ``weights`` the weight of a pair by its number. Weights and mean
    length are those of the whole benchmark, so a score does not depend on the items that share an index.
    """

    def __init__(
        self, items: list[Item], pairs: dict[tuple[int, int], int], vocabulary: dict[bytes, int], weights: np.ndarray, mean: float
    ):
        self.items = items
        self.span = max(len(i.words) for i in items)
        found = defaultdict(list)
        for d, item in enumerate(items):
            counts: dict[int, int] = defaultdict(int)
            numbers = [vocabulary[w] for w in item.words]
            for pair in zip(numbers, numbers[1:]):
                counts[pairs[pair]] += 1
            for t, tf in counts.items():
                norm = K1 * (1 - B + B * len(item.words) / mean)
                found[t].append((d, tf * (K1 + 1) / (tf + norm)))
        own = np.zeros(len(items))
        postings = {}
        for t, posts in found.items():
            postings[t] = [(d, weights[t] * x) for d, x in posts]
            for d, x in postings[t]:
                own[d] += x
        self.postings = {t: [(d, x / own[d]) for d, x in p] for t, p in postings.items()}
        self.top = {t: max(x for _, x in p) for t, p in self.postings.items()}
        self.blocks: dict[int, dict[int, float]] = {}
        per_group = max(BLOCK, -(-len(items) // (GROUPS * BLOCK)) * BLOCK)
        groups = -(-len(items) // per_group)
        # The last row stands for pairs that no item has.
        self.group_top = np.zeros((len(pairs) + 1, groups), np.float32)
        for t, p in self.postings.items():
            block: dict[int, float] = {}
            for d, x in p:
                block[d // BLOCK] = max(block.get(d // BLOCK, 0.0), x)
                g = d // per_group
                self.group_top[t, g] = max(self.group_top[t, g], x)
            self.blocks[t] = block

    def windows(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end word of each passage, and its text."""
        n = np.diff(bounds)
        count = np.where(n > 0, np.maximum(1, -(-n // self.span) - 1), 0)
        text = np.repeat(np.arange(len(n)), count)
        number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        begin = bounds[:-1][text] + number * self.span
        return begin, np.minimum(begin + 2 * self.span, bounds[1:][text]), text

    def promising(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, threshold: float) -> np.ndarray:
        """Passages whose terms, repeats included, could reach the threshold in some group of items."""
        most = np.zeros(len(begin), np.float32)
        for g in range(self.group_top.shape[1]):
            total = np.zeros(len(ids) + 1, np.float64)
            np.cumsum(self.group_top[:, g][ids], out=total[1:])
            np.maximum(most, total[end] - total[begin], out=most, casting="same_kind")
        return np.flatnonzero(most >= threshold - 1e-4)

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items with a score of at least the threshold, by block-max WAND."""
        postings, top, blocks = self.postings, self.top, self.blocks
        at = [[postings[t][0][0], 0, t] for t in terms if t in postings]
        out = []
        while at:
            at.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(at):
                bound += top[t]
                if bound >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = at[pivot][0]
            while pivot + 1 < len(at) and at[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            in_block = sum(blocks[t].get(block, 0.0) for _, _, t in at[: pivot + 1])
            if in_block >= threshold - 1e-9:
                if at[0][0] == item:
                    score = sum(postings[t][k][1] for d, k, t in at[: pivot + 1] if d == item)
                    if score >= threshold - 1e-9:
                        out.append((item, score))
                    goal = item + 1
                else:
                    goal = item
            else:
                # Nothing up to the block's end, or up to the next term's item, can reach the threshold.
                goal = (block + 1) * BLOCK
                if pivot + 1 < len(at):
                    goal = min(goal, at[pivot + 1][0])
                goal = max(goal, item + 1)
            for cursor in at[: pivot + 1]:
                posts = postings[cursor[2]]
                k = cursor[1]
                while k < len(posts) and posts[k][0] < goal:
                    k += 1
                cursor[1] = k
                cursor[0] = posts[k][0] if k < len(posts) else -1
            at = [c for c in at if c[0] >= 0]
        return out


class Shard:
    """The items of one pass, in classes of length with an index each."""

    def __init__(self, items: list[Item], counts: Counts | None = None):
        counts = counts or Counts.of(items)
        self.vocabulary: dict[bytes, int] = {}
        found = set()
        classes = defaultdict(list)
        for item in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in item.words]
            found.update(zip(numbers, numbers[1:]))
            if len(item.words) > 1:
                classes[(len(item.words) - 1).bit_length() // 2].append(item)
        pairs = {pair: t for t, pair in enumerate(sorted(found))}
        # Sorted, so that the number of a pair is its place.
        self.keys = np.array([self._key(a, b) for a, b in pairs], np.int64)
        words = list(self.vocabulary)
        weights = np.array([counts.weight(words[a] + b" " + words[b]) for a, b in pairs])
        self.indexes = [
            Index(members, pairs, self.vocabulary, weights, counts.mean) for _, members in sorted(classes.items())
        ]

    def _key(self, a, b):
        return a * (len(self.vocabulary) + 1) + b

    def terms(self, words: list[bytes], bounds: np.ndarray) -> np.ndarray:
        """The pair that begins at each word, ``len(keys)`` where no item has it; the last word of a text has none."""
        none = len(self.vocabulary)
        get = self.vocabulary.get
        ids = np.fromiter((get(w, none) for w in words), np.int64, len(words))
        out = np.full(len(ids), len(self.keys), np.int64)
        if len(ids) < 2 or not len(self.keys):
            return out
        known = (ids[:-1] < none) & (ids[1:] < none)
        ends = bounds[1:-1]
        known[ends[(ends > 0) & (ends < len(ids))] - 1] = False
        at = np.flatnonzero(known)
        key = self._key(ids[at], ids[at + 1])
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[place] == key
        out[at[hit]] = place[hit]
        return out

    def matches(self, column: pa.Array, threshold: float, overlap: float) -> list[tuple[int, object, float, float, float]]:
        """``(text, item_id, score, question, answer)``: verified items per text, at their best passage."""
        data, at = utf8(folded(column))
        raw = data.tobytes()
        words, bounds = [], [0]
        for i, j in zip(at, at[1:]):
            words += words_of(raw[i:j])
            bounds.append(len(words))
        bounds = np.array(bounds)
        ids = self.terms(words, bounds)
        best: dict[tuple[int, int, int], tuple] = {}
        for c, index in enumerate(self.indexes):
            begin, end, text = index.windows(bounds)
            for k in index.promising(ids, begin, end, threshold):
                i, j = int(begin[k]), int(end[k])
                terms = np.unique(ids[i : j - 1])  # the last word's pair leaves the passage
                for d, score in index.retrieve(terms[terms < len(self.keys)].tolist(), threshold):
                    question, answer = index.items[d].overlap(words[i:j])
                    if question >= overlap and answer >= overlap:
                        key, found = (int(text[k]), c, d), (score, question, answer)
                        best[key] = max(best.get(key, found), found)
        return [(t, self.indexes[c].items[d].item_id, *found) for (t, c, d), found in sorted(best.items())]


def item_shards(items: DataFrame, shard_bytes: int = SHARD_BYTES):
    """``Shard`` after ``Shard`` of ``item_id, text`` (or ``question, answer``); the driver holds one at a time."""
    split = "question" in items.columns
    columns = ["question", "answer"] if split else ["text"]
    cleaned = items.select("item_id", *(F.coalesce(c, F.lit("")).alias(c) for c in columns))
    size = sum((F.octet_length(c) for c in columns), F.lit(64)).cast("bigint")
    total = cleaned.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    place = F.pmod(F.xxhash64("item_id", *columns), F.lit(shards))
    counted = _counted(cleaned.select(*columns)) if shards > 1 else None
    for k in range(shards):
        rows = cleaned.filter(place == k).orderBy("item_id", *columns).collect()
        made = [_item(r, split) for r in rows]
        if any(len(i.words) > 1 for i in made):
            yield Shard(made, _counts_for(made, counted) if counted is not None else None)


def _item(row, split: bool) -> Item:
    parts = (row["question"], row["answer"]) if split else question_and_answer(row["text"])
    return Item(row["item_id"] if "item_id" in row else None, *parts)


def _counted(texts: DataFrame) -> DataFrame:
    """``pair, items, words`` over the whole benchmark; the row without a pair counts all items and their words."""
    split = "question" in texts.columns

    def pairs(batches):
        for batch in batches:
            found = [_item(r, split) for r in batch.to_pylist()]
            out = [(None, len(i.words)) for i in found] + [(p, 0) for i in found for p in i.pairs()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.binary()), pa.array([n for _, n in out], pa.int64())], names=["pair", "words"]
            )

    each = texts.mapInArrow(pairs, "pair binary, words bigint")
    return written(each.groupBy("pair").agg(F.count(F.lit(1)).alias("items"), F.sum("words").alias("words")), "pair-counts")


def _counts_for(items: list[Item], counted: DataFrame) -> Counts:
    """The counts of a shard's own pairs."""
    own = counted.sparkSession.createDataFrame([(p,) for p in set().union(*(i.pairs() for i in items))], "pair binary")
    holding = {bytes(r["pair"]): r["items"] for r in counted.join(own, "pair").collect()}
    (all_,) = counted.filter("pair is null").collect()
    return Counts(all_["items"], all_["words"] / all_["items"], holding)


def _cut(batches):
    for batch in batches:
        _, at = utf8(batch.column("text"))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: a row per document and item that it holds."""
    schema = docs.select("doc_id").schema
    schema = schema.add(items.schema["item_id"]).add("score", "double")
    schema = schema.add("question_overlap", "double").add("answer_overlap", "double")
    item_type = {"bigint": pa.int64(), "int": pa.int32()}.get(items.schema["item_id"].dataType.simpleString(), pa.string())
    out = docs.sparkSession.createDataFrame([], schema)

    def finder(shard):
        def run(batches):
            for batch in _cut(batches):
                found = shard.matches(batch.column("text"), threshold, overlap)
                rows = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                rest = [pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array([f[1] for f in found], item_type), *rest], names=schema.names)

        return run

    for n, shard in enumerate(item_shards(items)):
        found = docs.select("doc_id", "text").mapInArrow(finder(shard), schema)
        out = out.unionByName(found) if n else found
    return out


def remove_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    def keeper(shard):
        def run(batches):
            for batch in _cut(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in shard.matches(batch.column("text"), threshold, overlap)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for shard in item_shards(items):
        docs = docs.mapInArrow(keeper(shard), docs.schema)
    return docs


@query("op1_block_max_wand_decontamination")
def op1(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
