"""Hard negatives of anchors, their scores bounded along a spanning tree of the anchors.

A stated set of anchors meets all rows, in blocks. The anchors of a block lie in trees: minimum spanning trees, by Euclidean
distance, of anchors of one label. For a candidate ``x`` only the root is scored at once. A child's score differs from its
parent's by at most the length of the edge times the norm of ``x``, so the parent's score, or the bounds it has itself, gives
bounds for the child. A child is scored anew only if its bounds overlap its window: for positives the scores from the
fifth best so far upwards; for negatives from the lowest to the highest score that some positive still admits.

Each block takes two passes over all rows: the best rows of the anchor's own label (positives), and the best rows of other
labels within each positive's window. Tasks give out a few rows for each anchor, which are merged by anchor, so a hot label
or id is never in one task. A block has ``BLOCK`` anchors at most; nothing else reaches the driver or is broadcast.

Scores are exact: components are whole numbers, so single or double precision is used where the largest possible score
fits it, and long arithmetic beyond; scores that do not fit 64 bits are held at the ends of their range.

Defined results: rows without id, label or vector, or with a component that is null, not finite, or not finite once scaled,
take no part. Vectors of another length than the anchor's do not meet it; neither do other rows of its own id. Rows repeat
as often as they stand there; equal anchors count once. Other columns are not read. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import table, written

POSITIVES, NEGATIVES = 5, 3
#: A negative scores from 50 to 95 hundredths of the positive.
LOW, HIGH, OF = 50, 95, 100
#: A component counts as the whole number below this many times itself.
SCALE = 256
#: Anchors that a pass handles, and those of one tree; their vectors are all that is broadcast.
BLOCK, TREE = 16_384, 256
#: Candidates that meet a tree at once.
CHUNK = 4096
#: Where more than this share of the bounds overlaps the window, a level of a tree is scored in one product.
DENSE = 1 / 8

_MOST = np.int64(2**63 - 1)


def _largest(a: np.ndarray, x: np.ndarray) -> float:
    """No score of a row of ``a`` with a row of ``x``, nor a part of its sum, is larger."""
    return a.shape[1] * np.abs(a).max(initial=0) * np.abs(x).max(initial=0)


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``x``, exact; both hold whole numbers as doubles."""
    bound = _largest(a, x)
    if bound < 2**24:
        return (a.astype(np.float32) @ x.T.astype(np.float32)).astype(np.int64)
    if bound < 2**53:
        return (a @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in x]
    out = [[sum(int(v) * w for v, w in zip(row, other)) for other in whole] for row in a]
    return np.array([[min(max(s, -int(_MOST) - 1), int(_MOST)) for s in row] for row in out], np.int64).reshape(len(a), len(x))


class Tree:
    """Anchors of one label and length, and their minimum spanning tree by levels: nodes, their parents, lengths of edges."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, label: int, vectors: np.ndarray):
        self.number, self.ids, self.label, self.vectors = number, ids, label, vectors
        n = len(vectors)
        square = (vectors * vectors).sum(axis=1)
        parent, depth = np.zeros(n, np.int64), np.zeros(n, np.int64)
        nearest, away = np.zeros(n, np.int64), np.full(n, np.inf)
        edge, out, at = np.zeros(n), np.ones(n, bool), 0
        for _ in range(n - 1):
            out[at] = False
            d = np.maximum(square + square[at] - 2 * vectors @ vectors[at], 0)
            closer = d < away
            nearest[closer], away[closer] = at, d[closer]
            at = int(np.flatnonzero(out)[np.argmin(away[out])])
            parent[at], depth[at] = nearest[at], depth[nearest[at]] + 1
            edge[at] = np.linalg.norm(vectors[at] - vectors[nearest[at]])
        self.levels = [
            (nodes := np.flatnonzero(depth == k), parent[nodes], edge[nodes]) for k in range(int(depth.max(initial=0)) + 1)
        ]

    def within(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, candidate and score of all pairs whose score lies from the anchor's ``low`` to its ``high``."""
        norm = np.sqrt((x * x).sum(axis=1))
        # Bounds are doubles; scores that doubles cannot tell apart are computed anyway.
        rounded = _largest(self.vectors, x) >= 2**53
        least, most = np.empty((2, len(self.vectors), len(x)))
        found = []
        for nodes, parents, edge in self.levels:
            reach = edge[:, None] * norm * (1 + 1e-9) + 1
            bottom, top = least[parents] - reach, most[parents] + reach
            near = (top >= low[nodes, None]) & (bottom <= high[nodes, None])
            if parents is self.levels[0][1] or rounded or near.mean() > DENSE:
                exact = scores(self.vectors[nodes], x)
                least[nodes], most[nodes] = exact, exact
                r, c = np.nonzero((exact >= low[nodes, None]) & (exact <= high[nodes, None]))
                found.append((nodes[r], c, exact[r, c]))
                continue
            least[nodes], most[nodes] = bottom, top
            r, c = np.nonzero(near)
            exact = np.einsum("ij,ij->i", self.vectors[nodes[r]], x[c]).astype(np.int64)
            least[nodes[r], c], most[nodes[r], c] = exact, exact
            fits = (exact >= low[nodes[r]]) & (exact <= high[nodes[r]])
            found.append((nodes[r][fits], c[fits], exact[fits]))
        return tuple(np.concatenate(part) for part in zip(*found))


def trees(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> list[Tree]:
    """Trees of anchors of one label and length, neighbours along their widest direction together."""
    out, lengths = [], np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        for label in np.unique(labels[lengths == length]):
            mine = np.flatnonzero((lengths == length) & (labels == label))
            points = np.stack([vectors[k] for k in mine])
            if length:
                centred = points - points.mean(axis=0)
                line = centred @ centred[np.argmax((centred * centred).sum(axis=1))]
                mine, points = mine[np.argsort(line, kind="stable")], points[np.argsort(line, kind="stable")]
            for k in range(0, len(mine), TREE):
                out.append(Tree(mine[k : k + TREE], ids[mine[k : k + TREE]], label, points[k : k + TREE]))
    return out


def _matrix(batch: pa.RecordBatch, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and scaled vectors of a batch's rows that take part, by length of vector, in the order of ids."""
    vectors = batch.column("vector")
    there = np.ones(batch.num_rows, bool)
    for c in ("id", "label", "vector"):
        there &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(there, vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), -1)
    out = {}
    for length in np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(lengths == length)
        flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * flat.reshape(len(rows), length))
        good = np.isfinite(x).all(axis=1)
        ids = batch.column("id").take(pa.array(rows[good])).to_numpy()
        order = np.argsort(ids, kind="stable")
        labels = batch.column("label").take(pa.array(rows[good])).to_numpy()
        out[length] = ids[order], labels[order], x[good][order]
    return out


class Best:
    """The ``n`` best scores and ids for each group: higher scores first, ties by smaller id."""

    def __init__(self, n: int):
        self.n = n
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        group, score, ids = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        # -1 - s keeps the smallest of 64 bits in range.
        order = np.lexsort([ids, -1 - score, group])
        group, score, ids = group[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        keep = rank < self.n
        self.group, self.score, self.id = group[keep], score[keep], ids[keep]

    def least(self, groups: int) -> np.ndarray:
        """The score that a new row of each group must reach: its last one, if it has ``n``."""
        out = np.full(groups, -_MOST - 1)
        full = np.bincount(self.group, minlength=groups) == self.n
        if len(self.group):
            last = np.flatnonzero(np.append(self.group[1:] != self.group[:-1], True))
            out[self.group[last]] = self.score[last]
        return np.where(full, out, -_MOST - 1)


def _candidates(batches, scale):
    for batch in batches:
        for length, (ids, labels, x) in _matrix(batch, scale).items():
            for k in range(0, len(ids), CHUNK):
                yield length, ids[k : k + CHUNK], labels[k : k + CHUNK], x[k : k + CHUNK]


def _find_positives(block, n_anchors, positives, scale):
    """The best rows of each anchor's own label among a task's rows."""

    def run(batches):
        best = Best(positives)
        for length, ids, labels, x in _candidates(batches, scale):
            least = best.least(n_anchors)
            for tree in block.value:
                own = labels == tree.label
                if tree.vectors.shape[1] != length or not own.any():
                    continue
                a, c, s = tree.within(x[own], least[tree.number], np.full(len(tree.ids), _MOST))
                other = ids[own][c] != tree.ids[a]
                best.add(tree.number[a][other], s[other], ids[own][c][other])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.group), pa.array(best.score), pa.array(best.id)], names=["anchor", "score", "id"]
        )

    return run


def _find_negatives(block, windows, negatives, scale):
    """The best rows of other labels within the windows of each anchor's positives, among a task's rows."""

    def run(batches):
        low, high = windows.value
        best = Best(negatives)
        n, k = low.shape
        for length, ids, labels, x in _candidates(batches, scale):
            least = np.maximum(low, best.least(n * k).reshape(n, k))
            for tree in block.value:
                other = labels != tree.label
                if tree.vectors.shape[1] != length or not other.any() or not k:
                    continue
                bottom, top = least[tree.number], high[tree.number]
                open_ = bottom <= top
                from_ = np.where(open_, bottom, _MOST).min(axis=1)
                to = np.where(open_, top, -_MOST - 1).max(axis=1)
                a, c, s = tree.within(x[other], from_, to)
                for j in range(k):
                    fits = (s >= bottom[a, j]) & (s <= top[a, j])
                    best.add(tree.number[a[fits]] * k + j, s[fits], ids[other][c[fits]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.group // max(k, 1)), pa.array(best.group % max(k, 1)), pa.array(best.score), pa.array(best.id)],
            names=["anchor", "nth", "score", "id"],
        )

    return run


def _merged(partial: DataFrame, by: tuple[str, ...], n: int) -> DataFrame:
    """The ``n`` best of each group, as an array by rank; a task has given ``n`` at most for each."""
    # The smallest of 64 bits has no negative; ~s orders as -s does.
    entry = F.struct(F.bitwise_not("score").alias("less"), "id", "score")
    return partial.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("best"))


def _windows(found, n, k, low, high, of):
    """Lowest and highest score that each positive admits; where there is no positive, none."""
    bottom, top = np.full((n, k), _MOST), np.full((n, k), -_MOST - 1)
    for row in found:
        for j, (_, _, s) in enumerate(row["best"]):
            bottom[row["anchor"], j], top[row["anchor"], j] = -(-low * s // of), high * s // of
    return bottom, top


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int, int] = (LOW, HIGH, OF),
    scale: float = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` names.

    An anchor's positives are its ``positives`` best other rows of its label. Each gets the ``negatives`` best rows of
    other labels whose score is from ``low`` to ``high`` parts in ``of`` of the positive's; the window holds nothing if the
    positive's score is negative. ``rank`` counts from 1.
    """
    spark = vectors.sparkSession
    low, high, of = window
    rows = vectors.select(
        F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("_anchor"),
    ).filter("id is not null and label is not null and vector is not null")
    chosen = written(rows.filter("_anchor").drop("_anchor").distinct(), "anchors")
    n_blocks = -(-2 * chosen.count() // BLOCK)
    everything = rows.select("id", "label", "vector")
    result = []
    for b in range(n_blocks):
        # Half a block is expected; the rest of BLOCK is for what chance adds.
        mine = chosen.filter(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n_blocks)) == b).toArrow()
        ids, labels, points = [], [], []
        for batch in mine.to_batches():
            for i, c, x in _matrix(batch, scale).values():
                ids.append(i), labels.append(c), points.extend(x)
        if not points:
            continue
        ids, labels = np.concatenate(ids), np.concatenate(labels)
        n = len(ids)
        block = spark.sparkContext.broadcast(trees(ids, labels, points))
        best = everything.mapInArrow(
            _find_positives(block, n, positives, scale), "anchor bigint, score bigint, id bigint"
        )
        best = _merged(best, ("anchor",), positives).collect()
        windows = spark.sparkContext.broadcast(_windows(best, n, positives, low, high, of))
        known = spark.createDataFrame(
            [(r["anchor"], j, int(ids[r["anchor"]]), p["id"], p["score"]) for r in best for j, p in enumerate(r["best"])],
            "anchor bigint, nth bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        partial = everything.mapInArrow(
            _find_negatives(block, windows, negatives, scale), "anchor bigint, nth bigint, score bigint, id bigint"
        )
        ranked = _merged(partial, ("anchor", "nth"), negatives).select(
            "anchor", "nth", F.posexplode("best").alias("place", "row")
        )
        result.append(written(ranked.join(known, ["anchor", "nth"]).select(
            "anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("row.id").alias("negative_id"),
            "positive_score", F.col("row.score").alias("negative_score"),
        ), "hard-negatives"))
        block.destroy()
        windows.destroy()
    if not result:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    out = result[0]
    for more in result[1:]:
        out = out.unionByName(more)
    return out


#: All anchors with all rows.
OP11_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), scored as (
  select a.vec_id as anchor, v.vec_id as id, a.label = v.label as same, cast(list_dot_product(a.e, v.e) as bigint) as score
  from rows a join rows v on a.vec_id % 50 = 0 and a.vec_id <> v.vec_id and len(a.e) = len(v.e)
), positives as (
  select anchor, id, score from scored where same
  qualify row_number() over (partition by anchor order by score desc, id) <= 5
), ranked as (
  select p.anchor as anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score,
    n.score as negative_score, cast(row_number() over (partition by p.anchor, p.id order by n.score desc, n.id) as integer)
      as rank
  from positives p join scored n on p.anchor = n.anchor and not n.same
  where 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select * from ranked where rank <= 3
"""


@query("op11_spanning_tree_hard_negatives", OP11_SQL)
def op11(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
