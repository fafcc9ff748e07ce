"""Periodic runs: stretches of a text in which words a fixed distance apart are identical, by a sparse diagonal DP.

A *diagonal* of lag ``q`` pairs every word with the word ``q`` before it. Going through the text, each word's earlier
occurrences continue the diagonal of their lag or open it; a diagonal that ends after enough matches is a run. Plain words
would open a diagonal for every pair of equal words, so the DP is sparse: an earlier occurrence counts when the ``m`` words
from there agree too, with ``m`` = 4 for lags 1 to 7, 8 for lags 8 to 15, 16 for 16 to 31, and so on. A run of lag ``q``
matches for ``q`` words at least, so none is missed.

Within a long repetition every word has many such occurrences. Their diagonals start or end where the repetition does, or
have its own period; hence an occurrence counts only if one of the two places is not deep inside a repetition of a quarter
of ``m`` or less (the same ``m`` words stand close before it and close after it). That leaves a number of occurrences in
proportion to the text for each ``m``, whatever the text is. Where a diagonal begins and ends is found by bisection over
hashes of word ranges (two primes), so the skipped places cost nothing. A stretch that several lags match is a run of the
smallest of them: all others are its multiples and begin and end with it.

All texts of a slice are handled together; memory is in proportion to the slice, or to one text longer than that.

Defined results: null and empty texts have no words and no runs; their collapsed text is empty. Rows are judged one by one,
so repeated rows and missing ids get a row each. Only the text and the columns named in ``keep`` are read; other columns,
whatever their names, are not.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from filedrop.llm.registry import query
from filedrop.llm.text import _U, mix, table, text_slices, word_hashes, word_spans

#: Shortest run in words; a run is also at least this many times its period long.
LEAST_WORDS = 12
LEAST_COPIES = 2
#: Words that must agree for lags below twice as many.
FIRST_GRAM = 4

# Two primes below 2^31, so that products fit 63 bits.
_PRIMES = (2147483647, 2147483629)
_BASES = (1103515245, 1566083941)

RESULT = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


class _Ranges:
    """Equality of word ranges of one array, by prefix sums of hashes modulo two primes."""

    def __init__(self, words: np.ndarray):
        self.sums, self.powers = [], []
        for p, base in zip(_PRIMES, _BASES):
            power = np.ones(len(words) + 1, np.int64)
            done = 1
            while done < len(power):
                more = min(done, len(power) - done)
                power[done : done + more] = power[:more] * pow(base, done, p) % p
                done += more
            total = np.zeros(len(words) + 1, np.int64)
            np.cumsum((words % _U(p)).astype(np.int64) * power[:-1] % p, out=total[1:])
            self.sums.append(total)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``a`` and from ``b >= a`` are the same."""
        out = np.ones(len(a), bool)
        for p, total, power in zip(_PRIMES, self.sums, self.powers):
            left = (total[a + n] - total[a]) % p * power[b - a] % p
            out &= left == (total[b + n] - total[b]) % p
        return out

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from ``a`` and ``b`` on, or just before them; at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            shift = mid if back else 0
            fits = self.same(a - shift, b - shift, mid)
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and all integers from ``first`` up to, not including, ``last``."""
    n = np.maximum(last - first, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]


def _occurrences(at: np.ndarray, key: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places with their earlier occurrences at the lags of ``m``, and the places whose ``m`` words occur again anywhere."""
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    again = key[1:] == key[:-1]
    gap = np.where(again, at[1:] - at[:-1], np.iinfo(np.int64).max)
    edge = np.array([np.iinfo(np.int64).max])
    before, after = np.concatenate([edge, gap]), np.concatenate([gap, edge])
    open_ = np.concatenate([[False], again]) | np.concatenate([again, [False]])
    least = 1 if m == FIRST_GRAM else m
    near = np.minimum(before, after) < 2 * m
    shallow = np.flatnonzero(near & ((before > m // 4) | (after > m // 4)))
    group = np.cumsum(np.concatenate([[0], ~again])) if len(at) else np.zeros(0, np.int64)
    # Places of one group lie close together in this order, by their position.
    width = int(at.max()) + 4 * m + 1 if len(at) else 1
    line = group * width + at + 2 * m
    later_row, later = _spread(
        np.searchsorted(line, line[shallow] + least), np.searchsorted(line, line[shallow] + 2 * m)
    )
    earlier_row, earlier = _spread(
        np.searchsorted(line, line[shallow] - 2 * m + 1), np.searchsorted(line, line[shallow] - least + 1)
    )
    i = np.concatenate([at[later], at[shallow[earlier_row]]])
    j = np.concatenate([at[shallow[later_row]], at[earlier]])
    return i, j, np.sort(at[open_])


def find_runs(
    words: np.ndarray, bounds: np.ndarray, least: int = LEAST_WORDS, copies: int = LEAST_COPIES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``words``), length and smallest period of all runs, by start, then period. ``copies`` is 2 or more."""
    if copies < 2 or least < 2 * FIRST_GRAM:
        raise ValueError("runs have two copies and eight words at least")
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first, end = np.repeat(bounds[:-1], np.diff(bounds)), np.repeat(bounds[1:], np.diff(bounds))
    ranges, found = None, []
    grams, m = mix(words ^ mix(text.astype(np.uint64) + _U(1))), 1
    del text
    at = np.arange(len(words))
    while len(at):
        if m >= FIRST_GRAM:
            i, j, at = _occurrences(at, grams[at], m)
            if len(i):
                # Neighbours on a diagonal match together; the first of them stands for all.
                line = np.unique((i - j) * (len(words) + 1) + i)
                line = line[np.concatenate([[True], line[1:] != line[:-1] + 1])]
                lag, i = np.divmod(line, len(words) + 1)
                ranges = ranges or _Ranges(words)
                back = ranges.reach(i - lag, i, i - lag - first[i], True)
                on = ranges.reach(i - lag, i, end[i] - i, False)
                matched = back + on
                enough = (matched >= (copies - 1) * lag) & (matched + lag >= least)
                found.append(np.stack([(i - lag - back)[enough], (matched + lag)[enough], lag[enough]]))
        at = at[at + 2 * m <= end[at]] if len(at) else at
        with np.errstate(over="ignore"):
            wide = grams.copy()
            wide[at] = mix(grams[at] * _U(0x9E3779B97F4A7C15) + mix(grams[np.minimum(at + m, len(grams) - 1)] + _U(m)))
        grams, m = wide, 2 * m
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort([period, length, start])
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def _dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words that stand in a run after its first period."""
    step = np.bincount(start + period, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(step)[:n] > 0


def _judge(batches, keep, least, copies, before):
    if before is not None:
        batches = map(before, batches)
    for batch, data, at in text_slices(batches, "__text"):
        starts, ends, bounds = word_spans(data, at)
        start, length, period = find_runs(word_hashes(data, starts, ends), bounds, least, copies)
        dropped = _dropped(len(starts), start, length, period)
        text = np.searchsorted(bounds, start, "right") - 1
        per_text = np.searchsorted(text, np.arange(len(bounds)))
        any_dropped = np.add.reduceat(np.append(dropped, False), bounds[:-1]) * (np.diff(bounds) > 0) if len(bounds) > 1 else []
        raw, collapsed = data.tobytes(), []
        for t, (i, j) in enumerate(zip(at, at[1:])):
            found = raw[i:j].split()
            if any_dropped[t]:
                kept = ~dropped[bounds[t] : bounds[t + 1]]
                found = [w for w, k in zip(found, kept) if k]
            collapsed.append(b" ".join(found))
        runs = pa.StructArray.from_arrays(
            [pa.array(start - bounds[text]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
        )
        columns = [batch.column(k) for k in range(len(keep))] + [
            pa.array(np.diff(bounds)),
            pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    least: int = LEAST_WORDS,
    copies: int = LEAST_COPIES,
    before: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
) -> DataFrame:
    """``n_words``, the maximal ``runs`` of every text (word numbers from 0) and the text without their repetitions.

    A run is a stretch of ``least`` words and ``copies`` times its smallest period, or more, that no neighbouring word
    extends; ``collapsed`` holds the words that no run contains after its first period, joined by a blank. ``before`` may
    change the record batches (columns ``keep`` and ``__text``) first. One pass over the texts, no shuffle.
    """
    schema = T.StructType([docs.schema[c] for c in keep] + T.StructType.fromDDL(RESULT).fields)

    def judge(batches):
        return _judge(batches, keep, least, copies, before)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(judge, schema)


def repeated_tails(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts of one id in ten (by CRC-32), their words repeating from some word on with some period."""
    ids, place, changed = batch.column("doc_id").to_pylist(), [], []
    for k, i in enumerate(ids):
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10:
            continue
        words = (batch.column("__text")[k].as_py() or "").encode().split()
        n, g = len(words), h // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            whole, rest = divmod(n - a, p)
            words = words[:a] + words[a : a + p] * whole + words[a : a + rest]
            place.append(k)
            changed.append(b" ".join(words).decode())
    if not place:
        return batch
    mask = np.zeros(batch.num_rows, bool)
    mask[place] = True
    at = batch.schema.get_field_index("__text")
    text = pc.replace_with_mask(batch.column(at), pa.array(mask), pa.array(changed, batch.column(at).type))
    return batch.set_column(at, batch.schema.field(at), text)


#: Runs of equal neighbours on the lags of equal six-word windows; a run matches for six words at least.
OP12_SQL = """
with bytes as (
  select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint)) as b
  from documents
), hashed as (
  select rid, doc_id, w, len(w) as n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x:
    list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda k: cast(0 as bigint))), lambda d, k:
      xor(d // 2, case when d % 2 = 1 then 3988292384 else 0 end))), 4294967295) as h
  from bytes
), placed as (
  select *, case when h % 10 = 0 and n > 0 then (h // 10) % n end as a, 3 + (h // 10) % 8 as parts from hashed
), texts as (
  select rid, doc_id, n, case when a is null then w else
    list_transform(range(n), lambda i: w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // parts) end]) end as w
  from placed
), each as (
  select rid, unnest(w) as word, unnest(range(n)) as i from texts
), twos as (
  select *, word || ' ' || lead(word) over t as pair from each window t as (partition by rid order by i)
), sixes as (
  select rid, i, pair || ' ' || lead(pair, 2) over t || ' ' || lead(pair, 4) over t as six from twos
  window t as (partition by rid order by i)
), matched as (
  select rid, b.i - a.i as q, a.i as i, a.i - row_number() over (partition by rid, b.i - a.i order by a.i) as island
  from sixes a join sixes b using (rid, six) where a.i < b.i and six is not null
), diagonals as (
  select rid, q, min(i) as start, count(*) + 5 + q as length from matched group by rid, q, island
), runs as (
  select rid, start, length, min(q) as period from diagonals where length >= greatest(12, 2 * q) group by rid, start, length
), covered as (
  select distinct rid, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select rid, string_agg(word, ' ' order by i) as words from each anti join covered using (rid, i) group by rid
), listed as (
  select rid, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)
      as runs, arg_min({s: start, l: length, p: period}, [-length, start, period]) as top
  from runs group by rid
)
select doc_id, coalesce(n_runs, 0) as n_runs, top.s as start, top.l as length, top.p as period,
  1000 * top.l // top.p as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256,
  sha256(coalesce(words, '')) as collapsed_sha256
from texts left join listed using (rid) left join kept using (rid)
"""


@query("op12_periodic_runs", OP12_SQL)
def op12(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), before=repeated_tails)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), top.alias("top"), "collapsed",
                        F.array_join(lines, "").alias("lines"))
    return rows.select(
        "doc_id", "n_runs", F.col("top.start").alias("start"), (-F.col("top.less")).alias("length"),
        F.col("top.period").alias("period"), F.expr("1000 * -top.less div top.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
