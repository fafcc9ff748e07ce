"""MinHash near-duplicates by weighted signatures (BagMinHash), bands, and verified multiset overlap.

A text is the multiset of its windows of five words. A shingle of weight ``w`` owns Poisson processes over the weights
it covers, cut into the levels (0, 1], (1, 2], (2, 4], (4, 8], ...: a level's process has the rate of its width, and a
point of it has a time, a register and a weight, all hashed from shingle, level and number. A register keeps the first
point whose weight the text's shingle reaches. Two texts share a register's point with the probability of their weighted
Jaccard similarity, whatever the weights. As the points of a level come in order of time, only those before the time by
which all registers are filled are made: about ``K ln K`` per text instead of ``K`` per shingle.

Texts that share a band of registers are candidates. Copies of one text are one class from the start. Each bucket of a
band links its members to its smallest member; those links are verified on the multisets, and verified links are joined
into components. Only buckets that still hold several components are looked at again, every member outside the largest
component against all members of other components, in blocks. So no link between two texts of a bucket is lost, and no
group emits its pairs: a task gives out a link only if it joins two components.

Defined results: null and empty texts have no shingles and form one class of copies. A text of one to four words is one
shingle. Repeated rows and repeated ids with other texts keep a row each; ``group_id`` is the smallest id of the group,
missing ids being the largest, and null if no member has an id. Equal ids are ordered by the digest of their text. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.graph import components
from filedrop.llm.registry import query
from filedrop.llm.text import _STEP, _U, forget, mix, shingle_hashes, table, text_slices, word_hashes, word_spans, written

WIDTH = 5
SIMILARITY = 0.8
#: Registers of a signature, and the largest probability that a pair at the similarity shares no band of them.
REGISTERS, MISSED = 120, 1e-4
#: Standard deviations below the similarity at which two members of a bucket are not compared any more.
DEVIATIONS = 5
#: Members of a bucket that meet its first member in one group of rows; more are dealt to more groups.
BLOCK = 32
#: Members outside the largest component that are held at once.
HELD = 256


def banding(similarity: float) -> tuple[int, int]:
    """Bands and registers of a band: as long as they may be while a pair at the similarity is missed with ``MISSED``.

    24 bands of 5 at 0.8, which miss a pair with a probability of 7e-5; 60 of 2 at 0.5, 17 of 7 at 0.9.
    """
    rows = 1
    while rows < REGISTERS and (1 - similarity ** (rows + 1)) ** (REGISTERS // (rows + 1)) <= MISSED:
        rows += 1
    return REGISTERS // rows, rows


def least_shared(similarity: float) -> int:
    """Registers that a pair in a bucket must share before its multisets are compared."""
    return max(0, int(REGISTERS * (similarity - DEVIATIONS * np.sqrt(similarity * (1 - similarity) / REGISTERS))))


def multisets(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(shingle, text)`` and their counts."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = mix(shingles ^ mix(text.astype(np.uint64) + _U(1)))
    order = np.argsort(key)
    new = np.ones(len(order), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    at = np.flatnonzero(new)
    return shingles[order[at]], text[order[at]], np.diff(np.append(at, len(order)))


def _levels(shingle, text, weight):
    """One row for each shingle and level that its weight reaches: seed, text, weight, lower end and width of the level."""
    n = np.ones(len(weight), np.int64)
    more = weight > 1
    n[more] = 1 + np.ceil(np.log2(weight[more])).astype(np.int64)
    row = np.repeat(np.arange(len(weight)), n)
    level = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    low = np.where(level > 0, np.int64(1) << np.maximum(level - 1, 0), 0)
    seed = mix(shingle[row] + mix(level.astype(np.uint64) + _U(0x51ED)))
    return seed, text[row], weight[row], low, np.maximum(low, 1)


def _first_points(seed, text, weight, low, width, until, n_texts):
    """Per text and register: the time of the first point up to the text's time ``until``, and the point's hash."""
    flats, times, points = [], [], []
    x = np.zeros(len(seed))
    number = 0
    while len(seed):
        number += 1
        with np.errstate(over="ignore"):
            r = mix(seed + _U(number) * _STEP)
            x = x - np.log(((r >> _U(11)) + _U(1)).astype(np.float64) * 2.0**-53) / width
            alive = x <= until[text]
            if not alive.all():
                seed, text, weight, low, width, x, r = (
                    a[alive] for a in (seed, text, weight, low, width, x, r)
                )
            s = mix(r ^ _U(0xA5A5A5A55A5A5A5A))
            register = ((s & _U(0xFFFFFFFF)) * _U(REGISTERS)) >> _U(32)
            level_point = low + 1 + ((s >> _U(32)).astype(np.float64) * 2.0**-32 * width).astype(np.int64)
        reached = level_point <= weight
        flats.append((text * REGISTERS + register.astype(np.int64))[reached])
        times.append(x[reached])
        points.append(r[reached])
    first = np.full(n_texts * REGISTERS, np.inf)
    point = np.zeros(n_texts * REGISTERS, np.uint64)
    if flats:
        flat, time, r = np.concatenate(flats), np.concatenate(times), np.concatenate(points)
        np.minimum.at(first, flat, time)
        won = time == first[flat]
        point[flat[won]] = r[won]
    return first.reshape(n_texts, REGISTERS), point.reshape(n_texts, REGISTERS)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``(texts, REGISTERS)`` of 64-bit points; the rows of texts without shingles are zero."""
    n_texts = len(bounds) - 1
    total = np.diff(bounds)
    out = np.zeros((n_texts, REGISTERS), np.uint64)
    if not len(shingles):
        return out
    rows = _levels(*multisets(shingles, bounds))
    until = REGISTERS * (np.log(REGISTERS) + 3) / np.maximum(total, 1)
    left = np.flatnonzero(total)
    while len(left):
        number = np.full(n_texts, -1)
        number[left] = np.arange(len(left))
        mine = number[rows[1]] >= 0
        seed, text, weight, low, width = (a[mine] for a in rows)
        first, point = _first_points(seed, number[text], weight, low, width, until[left], len(left))
        full = np.isfinite(first).all(axis=1)
        out[left[full]] = point[full]
        left = left[~full]
        until = until * 2
    return out


def _bands(points: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + _U(77)), (len(points), bands)).copy()
    by_band = points[:, : bands * rows].reshape(-1, bands, rows)
    with np.errstate(over="ignore"):
        for k in range(rows):
            h = mix(h * _STEP + by_band[:, :, k])
    return h.view(np.int64)


def _shingled(data, at):
    starts, ends, bounds = word_spans(data, at)
    return shingle_hashes(word_hashes(data, starts, ends), bounds, WIDTH)


def _sign(bands: int, rows: int):
    def run(batches):
        for batch, data, at in text_slices(batches):
            shingles, bounds = _shingled(data, at)
            points = signatures(shingles, bounds)
            has = np.diff(bounds) > 0
            keys = _bands(points, bands, rows)[has].reshape(-1)
            offsets = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
            sketch = points.astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                 pa.array([row.tobytes() for row in sketch], pa.binary())],
                names=["digest", "bands", "sketch"],
            )

    return run


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two multisets given as sorted distinct values and counts."""
    x, y = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    place = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    same = y[0][place] == x[0]
    common = np.minimum(x[1][same], y[1][place[same]]).sum()
    return common / (a[1].sum() + b[1].sum() - common)


def _verify(similarity: float, least_shared: int):
    """Rows come by group and side. Side 0 is held, 1 is compared with what is held, 2 is compared and then held."""

    def find(parent, c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    def run(batches):
        group, held, sketches, parent = None, [], [], {}
        for batch, data, at in text_slices(batches):
            shingles, bounds = _shingled(data, at)
            links = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("group", "side", "node", "comp", "sketch")))
            for k, (g, side, node, comp, sketch) in enumerate(rows):
                if g != group:
                    group, held, sketches, parent = g, [], [], {}
                mine = np.unique(shingles[bounds[k] : bounds[k + 1]], return_counts=True)
                sketch = np.frombuffer(sketch, np.uint16)
                if side and held:
                    shared = (np.stack(sketches) == sketch).sum(axis=1) if least_shared else np.zeros(len(held))
                    for i in np.flatnonzero(shared >= least_shared):
                        other, other_comp, other_set = held[i]
                        x, y = find(parent, comp), find(parent, other_comp)
                        if x != y and weighted_jaccard(mine, other_set) >= similarity:
                            links.append((min(node, other), max(node, other)))
                            parent[max(x, y)] = min(x, y)
                if side != 1:
                    held.append((node, comp, mine))
                    sketches.append(sketch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _verified(rows: DataFrame, texts: DataFrame, similarity: float, least_shared: int) -> DataFrame:
    """Links among ``rows`` (group, side, node, comp); texts and sketches come to the rows by node."""
    with_text = rows.join(texts, "node").select("group", "side", "node", "comp", "sketch", "text")
    dealt = with_text.repartition("group").sortWithinPartitions("group", "side", "node")
    return written(dealt.mapInArrow(_verify(similarity, least_shared), "a bigint, b bigint"), "verified")


def _blocked(n, size):
    """The number of blocks of ``size`` that ``n`` rows need."""
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def _star_rows(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's first member; members of a hot centre are dealt to blocks."""
    edges = written(members.filter("node <> centre").select("centre", "node").distinct(), "candidates")
    hot = written(
        edges.groupBy("centre").count().filter(F.col("count") > BLOCK)
        .select("centre", _blocked(F.col("count"), BLOCK).alias("blocks")), "hot-centres",
    )
    block = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1)))
    dealt = edges.join(hot, "centre", "left").select(
        F.concat_ws("#", F.col("centre").cast("string"), block.cast("string")).alias("group"), "centre", "node"
    )
    streamed = dealt.select("group", F.lit(1).alias("side"), "node", F.col("node").alias("comp"))
    firsts = dealt.select("group", F.col("centre").alias("node")).distinct()
    return streamed.unionByName(firsts.select("group", F.lit(0).alias("side"), "node", F.col("node").alias("comp")))


def _remaining_rows(members: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Blocks of members that still have to meet: those outside a bucket's largest component, with all others."""
    placed = written(
        members.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("comp")), "placed"
    )
    sizes = placed.groupBy("band", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("h")
    )
    buckets = sizes.groupBy("band").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps"),
        F.bit_xor("h").alias("h"),
    ).filter("comps > 1")
    # Bands that hold the same members need one look.
    once = written(
        buckets.groupBy("n", "h").agg(F.min(F.struct("band", "top")).alias("b"))
        .select("b.band", F.col("b.top.comp").alias("largest"), (F.col("n") - F.col("b.top.n")).alias("outside"), "n"),
        "open-buckets",
    )
    if once.isEmpty():
        return None
    there = placed.join(once, "band").select(
        "band", "node", "comp", "n", "outside", (F.col("comp") != F.col("largest")).alias("out"),
        F.pmod(F.xxhash64("node"), _blocked(F.col("outside"), HELD)).cast("int").alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), _blocked(F.col("n"), HELD)).cast("int").alias("part"),
    )
    blocks, parts = _blocked(F.col("outside"), HELD), _blocked(F.col("n"), HELD)
    name = lambda i, j: F.concat_ws("#", F.col("band").cast("string"), i.cast("string"), j.cast("string"))
    own = there.filter("out").select(
        name(F.col("block"), F.lit("own")).alias("group"), F.lit(2).alias("side"), "node", "comp"
    )
    held = there.filter("out").withColumn("j", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        name(F.col("block"), F.col("j")).alias("group"), F.lit(0).alias("side"), "node", "comp"
    )
    met = there.withColumn("i", F.explode(F.sequence(F.lit(0), blocks - 1))).filter("not out or block > i").select(
        name(F.col("i"), F.col("part")).alias("group"), F.lit(1).alias("side"), "node", "comp"
    )
    return own.unionByName(held).unionByName(met)


def _classes(rows: DataFrame) -> DataFrame:
    """``digest, first_id, node``: classes of exact copies, numbered by their smallest id (missing last), then digest."""
    found = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    ordered = found.orderBy(F.col("first_id").asc_nulls_last(), "digest")
    return written(ordered.withColumn("node", F.monotonically_increasing_id()), "classes")


def _texts_of(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, sketch, text`` of the wanted classes, from the row with the class's smallest id.

    Both sides are sorted by id and digest at any size, so the copies of a hot text do not meet in one task; a plan that
    turns to a broadcast for small inputs would say nothing about large ones.
    """
    firsts = wanted.select(F.col("digest").alias("_digest"), "first_id", "node", "sketch").hint("merge")
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    found = own.join(firsts, same).dropDuplicates(["digest", "doc_id"])
    return written(found.select("node", "sketch", "text"), "candidate-texts")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, least: int | None = None) -> DataFrame:
    """``doc_id, digest, group_id, is_first``: the group of every row of ``docs``.

    ``digest`` names the class of exact copies (MD5 of the text). ``is_first`` marks the rows of the group's first text
    and id; repeated rows of it are all marked. ``similarity``, above 0 and up to 1, sets the bands. Members of a bucket
    are compared if they share ``least`` registers, :func:`least_shared` of the similarity if not given; with 0 all are.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity is above 0 and up to 1")
    least = least_shared(similarity) if least is None else least
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.md5(text.cast("binary")).alias("digest"), text.alias("text"))
    rows = written(own.select("doc_id", "digest"), "rows")
    classes = _classes(rows)
    each = written(
        own.select("digest", "text").mapInArrow(_sign(*banding(similarity)), "digest string, bands array<bigint>, sketch binary"),
        "signatures",
    )
    signed = written(each.dropDuplicates(["digest"]).join(classes, "digest"), "signed-classes")
    forget(each)

    bands = signed.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.filter("n > 1").select("band", "centre"), "buckets")
    members = written(bands.join(shared, "band"), "members")

    wanted = members.select("node").distinct()
    wanted = written(signed.select("digest", "first_id", "node", "sketch").join(wanted, "node"), "wanted")
    forget(signed, shared)
    texts = _texts_of(own, wanted)
    links = _verified(written(_star_rows(members), "star"), texts, similarity, 0)
    roots = components(links)
    remaining = _remaining_rows(members.select("band", "node"), roots)
    if remaining is not None:
        more = _verified(remaining, texts, similarity, least)
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    forget(texts, wanted)

    placed = written(
        classes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root")), "class-roots"
    )
    firsts = classes.select(F.col("node").alias("root"), "first_id", F.col("digest").alias("first_digest"))
    placed = written(placed.join(firsts, "root"), "class-groups")
    forget(members, classes)
    first = (F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return rows.join(placed.select("digest", "first_id", "first_digest"), "digest").select(
        "doc_id", "digest", F.col("first_id").alias("group_id"), first.alias("is_first")
    )


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group: its first text and id, and of repeated rows of that only one.

    Groups are written first: the rows of a hot text are split where they meet their class, and merged map-side after
    that. Whole rows move once, at any size.
    """
    found = written(near_duplicates(docs, similarity), "groups")
    rest = written(
        found.filter(~F.col("is_first")).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_other")).distinct(),
        "duplicates",
    )
    repeated = found.filter("is_first").groupBy("doc_id", "digest").count().filter("count > 1")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_own"), digest.alias("_digest"))
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_other"))
    kept = whole.join(rest.hint("merge"), same, "left_anti")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["_own", "_digest"])
    return kept.select("_row.*")


#: All pairs that share a shingle, and the closure of those that are alike.
OP9_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w, md5(coalesce(text, '')) as digest
  from documents
), cut as (
  select doc_id, array_to_string(w[i + 1 : i + 5], ' ') as shingle
  from (select *, unnest(range(0, greatest(len(w) - 4, least(len(w), 1)))) as i from words)
), sets as (
  select doc_id, shingle, count(*) as n from cut group by all
), sizes as (
  select doc_id, sum(n) as total from sets group by all
), shared as (
  select a.doc_id as x, b.doc_id as y, sum(least(a.n, b.n)) as n
  from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), links as (
  select x, y from shared join sizes s on s.doc_id = x join sizes t on t.doc_id = y
  where n >= 0.8 * (s.total + t.total - n)
  union select a.doc_id, b.doc_id from words a join words b on a.digest = b.digest and a.doc_id <> b.doc_id
), reached as (
  select doc_id as x, doc_id as y from words
  union select r.x, l.y from reached r join links l on r.y = l.x
)
select x as doc_id, min(y) as group_id, any_value(digest) as class_id, x = min(y) as is_first
from reached join words on x = doc_id group by x
"""


@query("op9_bagminhash_near_duplicates", OP9_SQL)
def op9(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "group_id", F.col("digest").alias("class_id"), "is_first")
