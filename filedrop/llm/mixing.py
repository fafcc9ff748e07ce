"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Targets share a budget by weight, no source above a multiple of its size. The budget is cut into blocks of equal words;
the sources get whole numbers of blocks by their highest quotients ``target / (2k + 1)``, and each source's blocks go to
its shards in the same way by shard size. A shard is a stream of its documents in seeded order, cut into blocks; it gives
whole passes first, then the blocks that come first in a seeded order, the last one cut to the exact word.

The quotients are never listed in full. Rounding ``weight / divisor`` gives all seats but a few; a unit of weight ``w``
among ``n`` units of total ``W`` that lack ``d`` seats gains at most ``w (d + n) / W + 1`` of them, so only that many
quotients are ranked. Shards are about ``20 sqrt(words)`` long, so their number and their length both grow with the
square root of the corpus; a hot source has more shards, not longer ones.

Defined results: null text has size 0, a null source is a source of its own, after all others. Documents of size 0 and
empty tables take nothing. Repeated rows and missing ids are documents of their own. Equal quotients go to the unit that
sorts first. Documents with equal seeded keys are ordered by id and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import WORD, table, written

#: Words taken in all, as a multiple of all words; most that is taken of a source, as a multiple of its words.
SHARE, MOST = 1.5, 2
#: Weights of the sources in sorted order, repeating.
WEIGHTS = (3, 1, 2)
#: Shortest shard and block, in words. A shard has at most ``BLOCKS`` whole blocks.
SHARD_WORDS, BLOCK_WORDS, BLOCKS = 100_000, 16, 16_384
SEED = "mix-1"


def apportion(units: DataFrame, by: list[str], weight: str, seats: str, order: list[str], out: str) -> DataFrame:
    """Adds ``out``: each unit's share of the group's ``seats`` by the highest quotients ``weight / (2k + 1)``.

    Groups are the values of ``by``; ``order`` identifies a unit within its group and breaks ties.
    """
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    total = F.col("_total")
    near = units.withColumns({
        "_total": F.sum(F.col(weight).cast("double")).over(group), "_n": F.count(F.lit(1)).over(group)
    })
    share = F.when(total > 0, F.col(weight) * F.col(seats) / total).otherwise(F.lit(0.0))
    near = near.withColumn("_near", F.floor(share + 0.5).cast("bigint"))
    near = near.withColumn("_lack", F.when(total > 0, F.col(seats) - F.sum("_near").over(group)).otherwise(F.lit(0)))
    bound = F.floor(F.col(weight) * (F.abs("_lack") + F.col("_n")) / total).cast("int") + 1
    more = F.col("_lack") > 0
    last = F.when(more, bound).otherwise(F.least(bound, F.col("_near").cast("int") - 1))
    steps = F.when((F.col("_lack") != 0) & (last >= 0), F.sequence(F.lit(0), last))
    tie = [F.col(c).asc_nulls_last() for c in order]
    near = near.withColumn("_unit", F.row_number().over(group.orderBy(*tie)))
    tried = near.filter("_lack <> 0").select("*", F.explode(steps).alias("_k"))
    seat = F.when(more, 2 * (F.col("_near") + F.col("_k")) + 1).otherwise(2 * (F.col("_near") - F.col("_k")) - 1)
    tried = tried.withColumn("_quotient", F.col(weight) / seat)
    # Seats are given to the highest quotients, the first unit's first, and taken in the opposite order.
    sign = F.when(more, F.lit(-1)).otherwise(F.lit(1))
    place = F.row_number().over(group.orderBy(sign * F.col("_quotient"), -sign * F.col("_unit"), F.col("_k")))
    moved = tried.withColumn("_place", place).filter(F.col("_place") <= F.abs("_lack"))
    keys = [*by, *order]
    moved = moved.groupBy(*keys).agg(F.sum(-sign).alias("_moved"))
    moved = moved.select(*[F.col(c).alias(f"_{c}_key") for c in keys], "_moved")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_key"))
    joined = near.join(moved, same, "left")
    result = F.col("_near") + F.coalesce("_moved", F.lit(0))
    return joined.select(*units.columns, result.cast("bigint").alias(out))


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """Adds ``weight, target`` to ``source, source_size``: shares by weight, stopped at ``most`` times the source's size.

    With the sources ordered by limit over weight, those that stop come first, so the level of the others follows from
    running sums. One row per source: the only step over all sources in one place.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))).cast("int") + 1))
    weighed = weighed.withColumns({"_limit": most * F.col("source_size"), "_rank": rank})
    weighed = weighed.withColumn("_ratio", F.col("_limit") / F.col("weight"))
    before = everything.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    budget = share * F.sum("source_size").over(everything)
    left = budget - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    weighed = weighed.withColumn("_level", level)
    free = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(everything)
    target = F.least(F.col("_limit").cast("double"), F.coalesce(free["_level"] * F.col("weight"), F.col("_limit").cast("double")))
    return weighed.withColumn("target", target).select("source", "source_size", "weight", "target")


def _digest(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *[p.cast("string") for p in parts]).cast("binary"))


def mix(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", source: str = "source", spans: bool = False
) -> DataFrame:
    """The ``keep`` columns with ``size, source_size, target, taken``, one row per row of ``docs``.

    Kept columns travel through one shuffle by shard; one that is named like a result gives way to it. ``spans`` adds what
    is taken: ``passes`` over the whole text, and ``spans`` of words taken once more, ``array<struct<start,end>>``.
    """
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = written(
        docs.select(F.struct(*keep).alias("_row"), F.col(source).alias("_source"), size.alias("_size"),
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("~")).alias("_id")), "sized",
    )
    sizes = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").cast("bigint").alias("source_size"))
    all_ = Window.partitionBy(F.lit(0))
    shard_words = F.greatest(F.lit(float(SHARD_WORDS)), 20 * F.sqrt(F.sum("source_size").over(all_)))
    planned = targets(sizes).withColumns({
        "block": F.greatest(F.lit(BLOCK_WORDS), F.ceil(shard_words / BLOCKS)).cast("bigint"),
        "shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint"),
    })
    blocks = F.floor(F.sum("target").over(all_) / F.col("block") + 0.5).cast("bigint")
    planned = planned.withColumn("all_blocks", blocks)
    planned = written(apportion(planned, [], "target", "all_blocks", ["source"], "blocks"), "sources")

    own = F.col("_source").eqNullSafe(F.col("source"))
    shard = F.pmod(F.conv(F.substring(_digest(F.col("_id"), F.lit("shard")), 1, 8), 16, 10).cast("bigint"), F.col("shards"))
    dealt = sized.join(planned, own).withColumn("_shard", shard)
    cells = dealt.groupBy("source", "_shard").agg(
        F.sum("_size").alias("cell"), F.first("blocks").alias("blocks"), F.first("block").alias("block")
    )
    cells = _selected(apportion(cells, ["source"], "cell", "blocks", ["_shard"], "quota"))
    cells = written(cells.withColumnsRenamed({"source": "c_source", "_shard": "c_shard"}), "cells")

    stream = Window.partitionBy("source", "_shard").orderBy(_digest(F.col("_id")), "_id", "_size")
    first = F.coalesce(F.sum("_size").over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.drop("blocks", "block").withColumn("_first", first).join(
        cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("_shard") == F.col("c_shard"))
    )
    results = [F.col("_size").alias("size"), F.col("source_size"), F.col("target"), _taken().alias("taken")]
    if spans:
        results += [F.when(F.col("_size") > 0, F.col("passes")).otherwise(F.lit(0)).cast("bigint").alias("passes"), _spans().alias("spans")]
    named = {"size", "source_size", "target", "taken"} | ({"passes", "spans"} if spans else set())
    return placed.select(*(F.col("_row")[c].alias(c) for c in keep if c not in named), *results)


def _block_key(j: Column, source: str, shard: str) -> Column:
    """A block's place in the seeded order; a short last block comes last."""
    key = _digest(F.coalesce(source, F.lit("~null")), F.col(shard), j)
    return F.when((j + 1) * F.col("block") > F.col("cell"), F.lit("z")).otherwise(key)


def _selected(cells: DataFrame) -> DataFrame:
    """Adds whole ``passes``, the key up to which blocks are taken, and the key and words of the block that is cut."""
    words = F.least(F.col("quota") * F.col("block"), MOST * F.col("cell"))
    passes = F.when(F.col("cell") > 0, F.floor(words / F.col("cell"))).otherwise(F.lit(0)).cast("bigint")
    cells = cells.withColumn("passes", passes).withColumn("_rest", words - F.col("passes") * F.col("cell"))
    count = F.ceil(F.col("cell") / F.col("block")).cast("int")
    keys = F.transform(F.sequence(F.lit(0), count - 1), lambda j: _block_key(j, "source", "_shard"))
    cells = cells.withColumn("_keys", F.when(F.col("_rest") > 0, F.array_sort(keys)))
    whole = F.floor(F.col("_rest") / F.col("block")).cast("int")
    cut = F.col("_rest") % F.col("block")
    return cells.withColumns({
        "upto": F.when(whole > 0, F.get("_keys", whole - 1)),
        "cut_key": F.when(cut > 0, F.get("_keys", whole)),
        "cut_words": cut,
    }).drop("_keys", "_rest")


def _blocks() -> Column:
    """Numbers of the blocks that share words with a document of at least one word."""
    begin, end = F.col("_first"), F.col("_first") + F.col("_size")
    return F.sequence(F.floor(begin / F.col("block")), F.floor((end - 1) / F.col("block")))


def _given(j: Column) -> Column:
    """Words taken of the beginning of block ``j``, besides whole passes."""
    key = _block_key(j, "source", "_shard")
    length = F.when(key <= F.coalesce("upto", F.lit("")), F.col("block"))
    return length.when(key == F.col("cut_key"), F.col("cut_words")).otherwise(F.lit(0))


def _some() -> Column:
    return (F.col("_size") > 0) & (F.col("upto").isNotNull() | F.col("cut_key").isNotNull())


def _taken() -> Column:
    """Words of a document that are taken: whole passes, and what selected blocks share with it."""
    begin, end = F.col("_first"), F.col("_first") + F.col("_size")
    whole = F.col("passes") * F.col("_size")

    def share(total, j):
        at = j * F.col("block")
        return total + F.greatest(F.lit(0), F.least(end, at + _given(j)) - F.greatest(begin, at))

    partly = F.aggregate(_blocks(), F.lit(0).cast("bigint"), lambda total, j: share(total, j).cast("bigint"))
    return (whole + F.when(_some(), partly).otherwise(F.lit(0))).cast("bigint")


def _spans() -> Column:
    """Words of a document that selected blocks share with it, counted from its first word, in order."""
    begin, end = F.col("_first"), F.col("_first") + F.col("_size")

    def shared(j):
        at = j * F.col("block")
        first, last = F.greatest(begin, at) - begin, F.least(end, at + _given(j)) - begin
        return F.struct(first.cast("bigint").alias("start"), last.cast("bigint").alias("end"))

    found = F.filter(F.transform(_blocks(), shared), lambda s: s["end"] > s["start"])
    return F.when(_some(), found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def taken_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``mix(..., spans=True)`` as the texts that are taken: a row for each pass, and one for the words of spans.

    ``taken`` becomes the words of the row's text. Words keep what separates them; a line break stands where words
    between two spans are left out. Texts of which nothing is taken have no row.
    """
    # The column is read within a lambda, where it would be split anew for each span if it were not bound.
    words = F.regexp_extract_all(text, F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))

    def joined(w):
        def step(state, span):
            part = F.array_join(F.slice(w, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")), "")
            gap = F.when((state["at"] == span["start"]) | (state["at"] < 0), F.lit("")).otherwise(F.lit("\n"))
            left = F.when(gap == "", state["out"]).otherwise(F.regexp_replace(state["out"], r"[\x20\x09-\x0D]+\z", ""))
            return F.struct(span["end"].alias("at"), F.concat(left, gap, part).alias("out"))

        zero = F.struct(F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("out"))
        return F.aggregate("spans", zero, step, lambda state: F.regexp_replace(state["out"], r"[\x20\x09-\x0D]+\z", ""))

    some = F.element_at(F.transform(F.array(words), joined), 1)
    partly = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    piece = lambda t, n: F.struct(t.alias("text"), n.cast("bigint").alias("taken"))
    whole = F.array_repeat(piece(F.col(text), F.col("size")), F.col("passes").cast("int"))
    none = F.array().cast("array<struct<text:string,taken:bigint>>")
    pieces = F.concat(whole, F.when(F.size("spans") > 0, F.array(piece(some, partly))).otherwise(none))
    rows = mixed.withColumn("_piece", F.explode(pieces))
    return rows.withColumns({text: F.col("_piece")["text"], "taken": F.col("_piece")["taken"]}).drop("_piece", "passes", "spans")


#: The same by listing all quotients and all blocks.
OP4_SQL = f"""
with docs as (
  select doc_id, coalesce(cast(doc_id as varchar), '~') as id, source,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as place
  from docs group by source
), weighed as (
  select *, [3, 1, 2][place % 3 + 1] as weight, 2 * source_size as most,
    2 * source_size / [3, 1, 2][place % 3 + 1] as ratio, cast(sum(source_size) over () as double) as total
  from sources
), levels as (
  select *, (1.5 * total - coalesce(sum(most) over before, 0))
    / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from weighed
  window before as (order by ratio, place rows between unbounded preceding and 1 preceding)
), targets as (
  select *, cast(least(most, coalesce((select level from levels where level <= ratio order by ratio, place limit 1)
    * weight, most)) as double) as target,
    cast(greatest({BLOCK_WORDS}, ceil(greatest({SHARD_WORDS}, 20 * sqrt(total)) / {BLOCKS})) as bigint) as block,
    cast(greatest(1, ceil(source_size / greatest({SHARD_WORDS}, 20 * sqrt(total)))) as bigint) as shards
  from levels
), wanted as (
  select *, cast(floor(sum(target) over () / block + 0.5) as bigint) as all_blocks, sum(target) over () as all_targets
  from targets
), quotients as (
  select place, all_blocks, row_number() over (order by target / (2 * k + 1) desc, place, k) as n
  from (select *, unnest(range(0, cast(target * all_blocks / greatest(all_targets, 1) as bigint) + 40)) as k from wanted)
  where target > 0
), planned as (
  select w.*, coalesce(b.blocks, 0) as blocks
  from wanted w left join (select place, count(*) as blocks from quotients where n <= all_blocks group by place) b
    on w.place = b.place
), dealt as (
  select d.*, p.place, p.source_size, p.target, p.block, p.blocks,
    cast('0x' || substr(md5(concat_ws('|', '{SEED}', d.id, 'shard')), 1, 8) as bigint) % p.shards as shard
  from docs d join planned p on d.source is not distinct from p.source
), cells as (
  select place, any_value(source) as source, shard, cast(sum(size) as bigint) as cell, any_value(blocks) as blocks,
    any_value(block) as block, any_value(source_size) as source_size
  from dealt group by place, shard
), shares as (
  select place, shard, blocks, row_number() over (partition by place order by cell / (2 * k + 1) desc, shard, k) as n
  from (select *, unnest(range(0, cast(cell * blocks / source_size as bigint) + 40)) as k from cells where source_size > 0)
  where cell > 0
), quotas as (
  select c.*, least(coalesce(q.quota, 0) * c.block, 2 * c.cell) as words
  from cells c left join (select place, shard, count(*) as quota from shares where n <= blocks group by place, shard) q
    on c.place = q.place and c.shard = q.shard
), passed as (
  select *, case when cell > 0 then words // cell else 0 end as passes,
    case when cell > 0 then words % cell else 0 end as rest
  from quotas
), pieces as (
  select *, row_number() over (partition by place, shard order by key) as n
  from (select *, case when (j + 1) * block > cell then 'z' else
      md5(concat_ws('|', '{SEED}', coalesce(source, '~null'), cast(shard as varchar), cast(j as varchar))) end as key
    from (select *, unnest(range(0, cast(ceil(cell / block) as bigint))) as j from passed))
), given as (
  select place, shard, j, block, case when n <= rest // block then block when n = rest // block + 1 then rest % block
    else 0 end as length
  from pieces
), placed as (
  select *, cast(coalesce(sum(size) over (partition by place, shard order by md5(concat_ws('|', '{SEED}', id)), id, size
    rows between unbounded preceding and 1 preceding), 0) as bigint) as first, row_number() over () as rid
  from dealt
), partly as (
  select p.rid, sum(greatest(0, least(p.first + p.size, g.j * g.block + g.length) - greatest(p.first, g.j * g.block))) as words
  from placed p join given g on p.place = g.place and p.shard = g.shard
    and g.j between p.first // p.block and (p.first + p.size - 1) // p.block
  where p.size > 0 group by p.rid
)
select p.doc_id, p.size, p.source_size, p.target, cast(c.passes * p.size + coalesce(x.words, 0) as bigint) as taken
from placed p join passed c on p.place = c.place and p.shard = c.shard left join partly x on p.rid = x.rid
"""


@query("op4_sainte_lague_mixing", OP4_SQL)
def op4(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
