"""Exact Jaccard join on sets of word shingles, filtered under several global orders of the tokens.

A text is the set of its windows of five words (tokens, by a 64-bit hash). Two sets of ``n`` tokens or so are alike only
if they share at least ``need = ceil(0.8 n)``, so under any order of all tokens that both obey they share a token among
their first ``n - need + 1`` (the prefix filter). The filter is used several times, each time under another order:

1. *A hash order, over all documents.* Tokens are counted among slightly longer prefixes, of which alike sets share not
   one token but a twelfth of their size. A set stays if that many of its prefix tokens stand in another set's prefix.
   Only a third of all tokens is exchanged, and a slice of texts sends a token once, however many of its texts hold it:
   what is shared within the slice is known there.
2. *Orders by rarity, over the sets that stay.* Tokens are counted over whole sets; rare ones come first and each order
   breaks ties by a hash of its own, so texts meet in small groups, and boilerplate that a third of all documents share is
   left behind in every order. Candidates share a prefix token in the first order. Before two sets are compared they
   must have one in common in each other order too, and sizes, with the number of tokens that occur elsewhere at all, that
   allow enough overlap. Only such tokens are carried: no others can be common.

Equal sets are one class from the start. Each group links its members to its smallest member; those links are verified
on the sets and joined into components. Groups that still hold several components are looked at again, every member
outside the largest component against all members of other components, in blocks. So no link between different sets is
lost, and no group emits its pairs: a task gives out a link only if it joins two components.

Defined results: null texts and texts without words have an empty set, are linked with nothing and keep their own id. A
text of one to four words is one shingle. Repeated rows and repeated ids with other texts keep a row each; missing ids are
never the smallest, and ``component_id`` is null if no member has an id. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from filedrop.llm.graph import components
from filedrop.llm.registry import query
from filedrop.llm.text import _U, forget, mix, shingle_hashes, table, text_slices, word_hashes, word_spans, written

WIDTH = 5
PERCENT = 80
#: Orders by rarity that candidates must share a prefix token in.
ORDERS = 3
#: Tokens that longer prefixes of the first filter have in common, per hundred of the smaller set.
SHARED = 10
#: Members of a group that meet its first member in one group of rows, and members that are held at once.
BLOCK, HELD = 64, 256


def needed(n, percent: int):
    """Tokens that a set of ``n`` must share with any set alike."""
    return -(-percent * n // 100)


def shared_least(n, percent: int):
    """Tokens that a set of ``n`` shares with any set alike among the first of both, whatever size that one has."""
    return SHARED * needed(n, percent) // 100 + 1


def first_tokens(n, percent: int):
    """Length of the prefixes that hold them."""
    return np.minimum(n, n - needed(n, percent) + SHARED * n // 100 + 1)


def token_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each text, ascending, and bounds by text; A-Z are lower-cased."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, bounds = word_spans(low, at)
    tokens, bounds = shingle_hashes(word_hashes(low, starts, ends), bounds, WIDTH)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort([tokens, text])
    tokens, text = tokens[order], text[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (text[1:] != text[:-1])
    return tokens[new], np.searchsorted(text[new], np.arange(len(bounds)))


def _digests(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    out = []
    for seed in (0x5A17, 0xC0DE):
        total = np.zeros(len(tokens) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(tokens ^ _U(seed)), out=total[1:])
            out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _name_sets(batches):
    for batch, data, at in text_slices(batches):
        tokens, bounds = token_sets(data, at)
        one, two = _digests(tokens, bounds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(bounds)), pa.array(one), pa.array(two)],
            names=["doc_id", "text_hash", "n", "d1", "d2"],
        )


#: Rows of the first filter: a token of a set's prefix; a token known to be shared (no set); a set with its size and the
#: number of its tokens that are known to be shared.
FIRST = "token bigint, set bigint, slice bigint, n bigint, shared bigint"


def _first_prefixes(percent):
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for _, data, at in text_slices(batches):
            number += 1
            tokens, bounds = token_sets(data, at)
            sets = _digests(tokens, bounds)[0]
            n = np.diff(bounds)
            once = np.zeros(len(n), bool)
            once[np.unique(sets, return_index=True)[1]] = True
            once &= n > 0
            rank = np.arange(len(tokens)) - np.repeat(bounds[:-1], n)
            first = np.repeat(once, n) & (rank < np.repeat(first_tokens(n, percent), n))
            text = np.repeat(np.arange(len(n)), n)[first]
            tokens = tokens[first]
            order = np.argsort(tokens, kind="stable")
            tokens, text = tokens[order], text[order]
            begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
            times = np.diff(np.append(begin, len(tokens)))
            shared = np.bincount(text[np.repeat(times > 1, times)], minlength=len(n))
            lone, many, own = begin[times == 1], begin[times > 1], np.flatnonzero(once)
            sizes = len(lone), len(many), len(own)
            none = lambda k: pa.nulls(k, pa.int64())
            ints = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
            columns = [
                # Sets go where their digest sends them, as if it were a token.
                [ints(tokens[lone]), ints(tokens[many]), ints(sets[own])],
                [ints(sets[text[lone]]), none(sizes[1]), ints(sets[own])],
                [pa.array(np.full(k, number)) for k in sizes],
                [none(sizes[0]), none(sizes[1]), ints(n[own])],
                [none(sizes[0]), none(sizes[1]), ints(shared[own])],
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(c) for c in columns], names=["token", "set", "slice", "n", "shared"]
            )

    return run


def _shared_tokens(batches):
    """From rows ordered by token: for each set, and slice that named it, the tokens that another set has too."""
    kept = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        is_set = batch.column("n").is_valid().to_numpy(zero_copy_only=False)
        sizes = batch.filter(pa.array(is_set))
        if sizes.num_rows:
            yield sizes.select(["set", "slice", "n", "shared"])
        rows = batch.filter(pa.array(~is_set))
        token, slice_ = rows.column("token").to_numpy(), rows.column("slice").to_numpy()
        # A token that a slice knows to be shared belongs to no set: slice -1.
        known = rows.column("set").is_null().to_numpy(zero_copy_only=False)
        set_ = rows.column("set").fill_null(0).to_numpy()
        token, set_, slice_ = (
            np.concatenate(x) for x in zip(kept, (token, set_, np.where(known, -1, slice_)))
        )
        if not len(token):
            continue
        begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        times = np.diff(np.append(begin, len(token)))
        flagged = np.maximum.reduceat(slice_ < 0, begin)
        several = np.maximum.reduceat(set_, begin) != np.minimum.reduceat(set_, begin)
        live = flagged | several
        # The last token may go on in the next batch; once it is known to be shared one row of it is enough.
        out = np.repeat(live, times) & (slice_ >= 0)
        last = slice(begin[-1], None)
        kept = [token[last], set_[last], slice_[last]]
        if live[-1]:
            kept = [kept[0][:1], np.zeros(1, np.int64), np.full(1, -1)]
        pair, count = np.unique(np.stack([set_[out], slice_[out]]), axis=1, return_counts=True) if out.any() else ((), ())
        if len(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[0]), pa.array(pair[1]), pa.nulls(len(count), pa.int64()), pa.array(count)],
                names=["set", "slice", "n", "shared"],
            )


def _possible(own: DataFrame, percent: int) -> DataFrame:
    """``d1`` of the sets that share enough of their first tokens with other sets."""
    dealt = own.select("text").mapInArrow(_first_prefixes(percent), FIRST).repartition("token")
    counted = dealt.sortWithinPartitions("token").mapInArrow(
        _shared_tokens, "set bigint, slice bigint, n bigint, shared bigint"
    )
    # Copies of a set in several slices are counted apart.
    per_set = counted.groupBy("set", "slice").agg(F.max("n").alias("n"), F.sum("shared").alias("shared"))
    need = F.expr(f"{SHARED} * (({percent} * n + 99) div 100) div 100 + 1")
    return written(per_set.filter(F.col("shared") >= need).select(F.col("set").alias("d1")).distinct(), "possible")


def _once_a_batch(batches):
    """Without the rows of a batch that repeat an id and text: equal rows are few before they are exchanged."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        seen = dict(zip(zip(ids, batch.column("text_hash").to_pylist()), range(batch.num_rows)))
        yield batch if len(seen) == batch.num_rows else batch.take(pa.array(sorted(seen.values())))


def _whole_sets(batches):
    for batch, data, at in text_slices(batches):
        tokens, bounds = token_sets(data, at)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens.view(np.int64)))],
            names=["node", "tokens"],
        )


def _sets_of(own: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, tokens`` of the classes in ``nodes``, from the text of their first row.

    Both sides are sorted by the key at any size: a plan that turns to a broadcast for small inputs says nothing about
    large ones.
    """
    firsts = nodes.select("node", "first_id", "first_hash").hint("merge")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    rows = own.mapInArrow(_once_a_batch, own.schema).join(firsts, same)
    texts = rows.dropDuplicates(["doc_id", "text_hash"]).select("node", "text")
    return written(texts.mapInArrow(_whole_sets, "node bigint, tokens array<bigint>"), "sets")


def prefixes(tokens: np.ndarray, rarity: np.ndarray, length: int) -> list[np.ndarray]:
    """The first tokens of a set under each order: rarer ones first, ties by the order's own hash."""
    out, tokens = [], tokens.view(np.uint64)
    for k in range(ORDERS):
        order = np.lexsort([mix(tokens ^ _U(0x1F0D + k)), rarity])
        out.append(np.sort(tokens[order[:length]]).view(np.int64))
    return out


def _prefixed(percent):
    """Shared tokens of each node, and its prefix under each order: as tokens, and as bits that mark them."""

    def run(batches):
        for batch in batches:
            tokens_out, out, marks = [], [[] for _ in range(ORDERS)], [[] for _ in range(ORDERS)]
            n = batch.column("n").to_numpy()
            entries = batch.column("shared")
            inner = entries.flatten()
            rarity, tokens = inner.field("rarity").to_numpy(), inner.field("token").to_numpy()
            at = np.concatenate([[0], np.cumsum(entries.value_lengths().to_numpy())])
            # Tokens that no other node has come first in every order, and lead to nobody.
            left = n - needed(n, percent) + 1 - (n - np.diff(at))
            for i, (a, b) in enumerate(zip(at, at[1:])):
                order = np.argsort(tokens[a:b].view(np.uint64))
                own, rare = tokens[a:b][order], rarity[a:b][order]
                tokens_out.append(own)
                for k, found in enumerate(prefixes(own, rare, max(int(left[i]), 0))):
                    out[k].append(found)
                    marks[k].append(np.packbits(np.isin(own, found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(tokens_out, pa.list_(pa.int64()))]
                + [pa.array(part, pa.list_(pa.int64())) for part in out] + [pa.array(part, pa.binary()) for part in marks],
                names=["node", "n", "tokens", *(f"p{k}" for k in range(ORDERS)), *(f"m{k}" for k in range(ORDERS))],
            )

    return run


def _with_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Nodes with sizes, the tokens that other nodes have too, and prefixes of these, where they are not empty."""
    tokens = sets.select("node", F.size("tokens").cast("bigint").alias("n"), F.explode("tokens").alias("token"))
    # Powers of two: tokens of like rarity are ordered by the hash of each order.
    rarity = F.floor(F.log2("df")).cast("int").alias("rarity")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("token", rarity)
    shared = tokens.join(common, "token").groupBy("node", "n").agg(F.collect_list(F.struct("rarity", "token")).alias("shared"))
    kinds = "node bigint, n bigint, tokens array<bigint>, " + ", ".join(
        [f"p{k} array<bigint>" for k in range(ORDERS)] + [f"m{k} binary" for k in range(ORDERS)]
    )
    return written(shared.mapInArrow(_prefixed(percent), kinds).filter("size(p0) > 0"), "prefixes")


def _in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which values of the shorter of two ascending arrays are in the other."""
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _verify(percent: int):
    """Rows come by group and side. Side 0 is held, 1 is compared with what is held, 2 is compared and then held."""

    def find(parent, c):
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    def run(batches):
        group, held, limits, parent = None, [], None, {}
        for batch in batches:
            links = []
            lists = batch.column("tokens")
            values = lists.flatten().to_numpy().view(np.uint64)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            names = ("group", "side", "node", "comp", "n", *(f"m{k}" for k in range(ORDERS)))
            rows = zip(*(batch.column(c).to_pylist() for c in names))
            for k, (g, side, node, comp, n, *marks) in enumerate(rows):
                if g != group:
                    group, held, limits, parent = g, [], None, {}
                own = values[bounds[k] : bounds[k + 1]]
                first = [own[np.unpackbits(np.frombuffer(m, np.uint8), count=len(own)).astype(bool)] for m in marks]
                if side and held:
                    if limits is None or len(limits) != len(held):
                        limits = np.array([(h[2], len(h[3])) for h in held])
                    # What alike sets of these sizes have in common; tokens that nobody else has cannot be part of it.
                    least = -(-percent * (limits[:, 0] + n) // (100 + percent))
                    for i in np.flatnonzero(least <= np.minimum(limits[:, 1], len(own))):
                        other, other_comp, _, other_own, other_first = held[i]
                        x, y = find(parent, comp), find(parent, other_comp)
                        if x != y and all(_in(p, q).any() for p, q in zip(first, other_first)):
                            if _in(own, other_own).sum() >= least[i]:
                                links.append((min(node, other), max(node, other)))
                                parent[max(x, y)] = min(x, y)
                if side != 1:
                    held.append((node, comp, n, own, first))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _verified(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``rows`` (group, side, node, comp); sets come to the rows by node."""
    whole = sets.select("node", "n", "tokens", *(f"m{k}" for k in range(ORDERS)))
    dealt = rows.join(whole, "node").repartition("group").sortWithinPartitions("group", "side", "node")
    return written(dealt.mapInArrow(_verify(percent), "a bigint, b bigint"), "verified")


def _blocked(n, size):
    """The number of blocks of ``size`` that ``n`` rows need."""
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def _named(*parts):
    return F.concat_ws("#", *(p.cast("string") for p in parts))


def _groups(sets: DataFrame) -> DataFrame:
    """``centre, node``: members of the first order's groups, without nodes that meet nobody in some order.

    Groups with the same smallest member are one: copies with a few changed words share many tokens, and most of their
    groups have that member.
    """
    index = None
    for k in range(ORDERS):
        rows = sets.select(F.lit(k).alias("order"), F.explode(f"p{k}").alias("token"), "node")
        index = rows if index is None else index.unionByName(rows)
    index = written(index, "index")
    met = index.groupBy("order", "token").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(index.join(met.drop("n"), ["order", "token"]), "members")
    everywhere = members.groupBy("node").agg(F.bit_or(F.expr("shiftleft(1, order)")).alias("orders"))
    everywhere = everywhere.filter(F.col("orders") == (1 << ORDERS) - 1).select("node")
    groups = written(members.filter("order = 0").select("centre", "node").distinct().join(everywhere, "node"), "groups")
    forget(index, members)
    return groups


def _stars(groups: DataFrame) -> DataFrame:
    """Each member of a group with the group's first member; members of a hot centre are dealt to blocks."""
    edges = groups.filter("node <> centre")
    hot = edges.groupBy("centre").count().filter(F.col("count") > BLOCK)
    hot = written(hot.select("centre", _blocked(F.col("count"), BLOCK).alias("blocks")), "hot-centres")
    dealt = edges.join(hot, "centre", "left").select(
        _named(F.col("centre"), F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1)))).alias("group"), "centre", "node"
    )
    members = dealt.select("group", F.lit(1).alias("side"), "node", F.col("node").alias("comp"))
    firsts = dealt.select("group", F.col("centre").alias("node")).distinct()
    return members.unionByName(firsts.select("group", F.lit(0).alias("side"), "node", F.col("node").alias("comp")))


def _open_rows(groups: DataFrame, roots: DataFrame) -> DataFrame | None:
    """Blocks of members that still have to meet: those outside a group's largest component, with all others."""
    placed = written(
        groups.join(roots, "node", "left").select("centre", "node", F.coalesce("root", "node").alias("comp")), "placed"
    )
    sizes = placed.groupBy("centre", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("h")
    )
    several = sizes.groupBy("centre").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps"),
        F.bit_xor("h").alias("h"),
    ).filter("comps > 1")
    # Groups of the same members need one look.
    once = written(
        several.groupBy("n", "h").agg(F.min(F.struct("centre", "top")).alias("g"))
        .select("g.centre", F.col("g.top.comp").alias("largest"), (F.col("n") - F.col("g.top.n")).alias("outside"), "n"),
        "open-groups",
    )
    if once.isEmpty():
        return None
    blocks, parts = _blocked(F.col("outside"), HELD), _blocked(F.col("n"), HELD)
    there = placed.join(once, "centre").select(
        "centre", "node", "comp", (F.col("comp") != F.col("largest")).alias("out"), blocks.alias("blocks"), parts.alias("parts"),
        F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), parts).cast("int").alias("part"),
    )
    here = lambda rows, i, j, side: rows.select(
        _named(F.col("centre"), i, j).alias("group"), F.lit(side).alias("side"), "node", "comp"
    )
    out = there.filter("out")
    held = out.withColumn("j", F.explode(F.expr("sequence(0, parts - 1)")))
    met = there.withColumn("i", F.explode(F.expr("sequence(0, blocks - 1)"))).filter("not out or block > i")
    return written(
        here(out, F.col("block"), F.lit("own"), 2).unionByName(here(held, F.col("block"), F.col("j"), 0))
        .unionByName(here(met, F.col("i"), F.col("part"), 1)), "open-rows",
    )


def _linked(sets: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of all nodes with a link."""
    groups = _groups(sets)
    links = _verified(_stars(groups), sets, percent)
    roots = components(links)
    rows = _open_rows(groups, roots)
    if rows is not None:
        more = _verified(rows, sets, percent)
        if not more.isEmpty():
            roots = components(links.unionByName(more))
    return roots


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, d1, d2`` for every row of ``docs``.

    Rows are linked if ``100 * intersection >= percent * union`` for their sets of shingles; ``component_id`` is the
    smallest id in reach. ``d1, d2`` name the class of equal sets. ``percent`` is from 1 to 100.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    named = written(
        own.mapInArrow(_name_sets, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint, n bigint, "
                                   "d1 bigint, d2 bigint"), "named-sets",
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = written(
        named.filter("n > 0").groupBy("d1", "d2").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("rows")).select(
            "d1", "d2", "rows", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"),
        ), "classes",
    )
    nodes = written(
        classes.join(_possible(own, percent), "d1", "left_semi").withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    whole = _sets_of(own, nodes)
    sets = _with_prefixes(whole, percent)
    forget(whole)
    roots = _linked(sets, percent)
    forget(sets)
    placed = written(nodes.join(roots, "node").select("d1", "d2", "first_id", "root"), "placed")
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = placed.join(smallest, "root").select("d1", "d2", F.struct("component_id").alias("found"))
    # Only rows with a copy or a link need to look up their component.
    several = classes.join(linked, ["d1", "d2"], "left").filter("rows > 1 or found is not null")
    several = written(
        several.select("d1", "d2", F.coalesce("found", F.struct(F.col("first_id").alias("component_id"))).alias("found")),
        "components",
    )
    return named.join(several, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("found").isNull() | (F.col("n") == 0), F.col("doc_id")).otherwise(F.col("found.component_id"))
        .alias("component_id"), "d1", "d2",
    )


#: All pairs that share a shingle, and the closure of those that are alike.
OP13_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w
  from documents
), cut as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as shingle
  from (select *, unnest(range(0, greatest(len(w) - 4, least(len(w), 1)))) as i from words)
), sizes as (
  select doc_id, count(*) as n from cut group by doc_id
), shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n
  from cut a join cut b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), links as (
  select x, y from shared join sizes s on s.doc_id = x join sizes t on t.doc_id = y
  where 100 * shared.n >= 80 * (s.n + t.n - shared.n)
), reached as (
  select doc_id as x, doc_id as y from words
  union select r.x, l.y from reached r join links l on r.y = l.x
)
select x as doc_id, coalesce(any_value(n), 0) as n_shingles, min(y) as component_id
from reached left join sizes on x = doc_id group by x
"""


@query("op13_multi_order_jaccard_join", OP13_SQL)
def op13(spark, sf_dir):
    found = jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")
