"""Quality rules: repeated substrings of a text from its suffix array.

The suffixes of a text, taken at its words, are sorted by prefix doubling; the longest common prefixes (LCP) of
neighbours give the LCP intervals, whose prefixes are the maximal repeated substrings. A word's deepest interval says how
far the longest repeated substring from there reaches, so the union of those reaches is the union of the spans of all
maximal repeats. A text is kept if that union covers a limited share of its words and no repeat is longer than a limit.

All texts of a slice are sorted together: a rank starts from the pair of text and word, so suffixes of different texts
never compare equal, and the work is a few array operations per slice however many texts it holds.

Defined results: a null or empty text has no words, fails the base rules and is not kept. Rows are judged one by one, so
repeated rows and missing ids get a row each. Other columns of the input are not read, except those named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from filedrop.llm.registry import query
from filedrop.llm.text import sums, table, text_slices, word_hashes, word_spans, mix, _SPACE

#: Shortest substring, in words, that counts as a repeat; shorter ones are idiom.
MIN_REPEAT_WORDS = 8
#: Largest share of a text's words within repeats. Words in repeats of eight are in repeated windows of three too, so a
#: limit that decides anything lies well below the base rule's half. Of the given texts that pass the base rules, 99.9 percent
#: are below a quarter.
MAX_COVERED = 0.25
#: Longest repeat, in words.
MAX_REPEAT_WORDS = 200

MIN_WORDS = 50
#: Base rule: largest percentage of words in repeated windows of three.
MAX_REPEAT_PERCENT = 50
WINDOW = 3

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, kept boolean, covered_words bigint, longest_repeat bigint")


def suffix_ranks(words: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words; in the last, every rank is unique.

    Equal ranks at level ``j`` mean the same text and the same ``2^j`` words.
    """
    n = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    key = mix(words ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    starts = np.flatnonzero(new)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, k = [rank], 1
    open_ = order[np.repeat(np.diff(np.append(starts, n)) > 1, np.diff(np.append(starts, n)))]
    while len(open_):
        rank = levels[-1]
        after = open_ + k
        beyond = after >= end[open_]
        following = np.where(beyond, 0, rank[np.minimum(after, n - 1)] + 1)
        sort_key = rank[open_] * (n + 1) + following
        by = np.argsort(sort_key, kind="stable")
        open_, sort_key = open_[by], sort_key[by]
        old = rank[open_]
        at = np.arange(len(open_))
        group = np.ones(len(open_), bool)
        group[1:] = old[1:] != old[:-1]
        part = np.ones(len(open_), bool)
        part[1:] = sort_key[1:] != sort_key[:-1]
        group_at = np.maximum.accumulate(np.where(group, at, 0))
        part_at = np.maximum.accumulate(np.where(part, at, 0))
        rank = rank.copy()
        rank[open_] = old + part_at - group_at
        levels.append(rank)
        sizes = np.diff(np.append(np.flatnonzero(part), len(open_)))
        open_ = open_[np.repeat(sizes > 1, sizes)]
        k *= 2
    return levels


def repeat_lengths(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every word: length in words of the longest substring from there that occurs elsewhere in its text too."""
    n = len(words)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    levels = suffix_ranks(words, bounds)
    end = np.repeat(bounds[1:], np.diff(bounds))
    suffix_array = np.empty(n, np.int64)
    suffix_array[levels[-1]] = np.arange(n)
    pairs = np.flatnonzero(levels[0][suffix_array[:-1]] == levels[0][suffix_array[1:]])
    a, b = suffix_array[pairs], suffix_array[pairs + 1]
    lcp = np.zeros(len(pairs), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < end[a]) & (y < end[b])
        same = inside & (levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)])
        lcp += same.astype(np.int64) << j
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def covered(best: np.ndarray, least: int, reach: int | None = None) -> np.ndarray:
    """Words inside the union of repeats of at least ``least`` words; with ``reach``, of their first words only."""
    n = len(best)
    at = np.flatnonzero(best >= least)
    step = np.bincount(at, minlength=n + 1) - np.bincount(at + (reach or best[at]), minlength=n + 1)
    return np.cumsum(step)[:n] > 0


def _duplicate_lines(data: bytes) -> int:
    if b"\n" not in data:
        return 0
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def measure(data: np.ndarray, at: np.ndarray, least: int, share: float, longest: int) -> dict[str, np.ndarray]:
    """The measures of each text of a slice, and what its spans are made from."""
    starts, ends, bounds = word_spans(data, at)
    n_words = np.diff(bounds)
    raw = data.tobytes()
    best = repeat_lengths(word_hashes(data, starts, ends), bounds)
    in_repeat = covered(best, least)
    n_repeat = sums(covered(best, WINDOW, WINDOW), bounds)
    n_covered = sums(in_repeat, bounds)
    peak = np.zeros(len(n_words), np.int64)
    full = np.flatnonzero(n_words)
    if len(full):
        peak[full] = np.maximum.reduceat(best, bounds[:-1][full])
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    first_byte = (data & 0xC0) != 0x80
    return {
        "n_words": n_words,
        "word_chars": sums(first_byte & ~_SPACE[data], at),
        "n_symbols": sums(_SYMBOL[data], at),
        "n_dup_lines": np.array([_duplicate_lines(raw[i:j]) for i, j in zip(at, at[1:])], np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": ~failed & (n_covered <= share * n_words) & ((peak <= longest) | (peak < least)),
        "covered_words": n_covered,
        "longest_repeat": peak,
        "_words": (starts, ends, bounds, in_repeat, first_byte),
    }


def _spans(words, at: np.ndarray) -> pa.Array:
    """Start and end, in code points of the text, of each run of words inside repeats."""
    starts, ends, bounds, inside, first_byte = words
    chars = np.zeros(len(first_byte) + 1, np.int64)
    np.cumsum(first_byte, out=chars[1:])
    out = []
    for t, (i, j) in enumerate(zip(bounds, bounds[1:])):
        flags = np.concatenate([[False], inside[i:j], [False]])
        edges = np.flatnonzero(flags[1:] != flags[:-1])
        first, last = starts[i:j][edges[::2]], ends[i:j][edges[1::2] - 1]
        zero = chars[at[t]]
        out.append([{"start": int(a), "end": int(b)} for a, b in zip(chars[first] - zero, chars[last] - zero)])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def repetition_rules(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    min_repeat_words: int = MIN_REPEAT_WORDS,
    max_covered: float = MAX_COVERED,
    max_repeat_words: int = MAX_REPEAT_WORDS,
    spans: bool = False,
) -> DataFrame:
    """Measures and verdict of every text; ``spans`` adds the repeated spans as ``array<struct<start,end>>``.

    One pass over the texts, no shuffle.
    """
    kept = [docs.schema[c] for c in keep]
    schema = T.StructType(kept + T.StructType.fromDDL(MEASURES).fields)
    if spans:
        schema = schema.add("spans", T.ArrayType(T.StructType.fromDDL("start bigint, end bigint")))
    names = [f.name for f in T.StructType.fromDDL(MEASURES).fields]

    def judge(batches):
        for batch, data, at in text_slices(batches, "__text"):
            found = measure(data, at, min_repeat_words, max_covered, max_repeat_words)
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(found[c]) for c in names]
            if spans:
                columns.append(_spans(found["_words"], at))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names] + ["spans"] * spans)

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(judge, schema)


#: Repeated windows, and for the longest repeat the longest run of equal pairs of words at one distance.
OP2_SQL = f"""
with words as (
  select doc_id, coalesce(text, '') as text, row_number() over () as rid,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), each as (
  select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as i, len(w) as n from words
), twos as (
  select rid, i, word, word || ' ' || lead(word) over t as pair, lead(word, 2) over t as third from each
  window t as (partition by rid order by i)
), fours as (
  select *, pair || ' ' || lead(pair, 2) over (partition by rid order by i) as four from twos
), grams as (
  select rid, i, pair, pair || ' ' || third as three,
    four || ' ' || lead(four, 4) over (partition by rid order by i) as eight
  from fours
), windows as (
  select rid, i, 3 as width, count(*) over (partition by rid, three) as times from grams where three is not null
  union all
  select rid, i, 8, count(*) over (partition by rid, eight) from grams where eight is not null
), inside as (
  select rid, count(distinct pos) filter (width = 3) as short, count(distinct pos) filter (width = 8) as long
  from (select rid, width, unnest(range(i, i + width)) as pos from windows where times > 1) group by rid
), runs as (
  select rid, gap, i - row_number() over (partition by rid, gap order by i) as run
  from (select a.rid, a.i, b.i - a.i as gap from grams a join grams b on a.rid = b.rid and a.pair = b.pair and a.i < b.i)
), longest as (
  select rid, max(n) as n from (
    select rid, count(*) + 1 as n from runs group by rid, gap, run
    union all select rid, 1 from each group by rid, word having count(*) > 1) group by rid
), lines as (
  select rid, count(*) - count(distinct line) as n
  from (select rid, unnest(string_split(text, chr(10))) as line from words)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid
), all_ as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint)
      as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, coalesce(l.n, 0) as n_dup_lines,
    coalesce(short, 0) as n_repeat_words, coalesce(long, 0) as covered_words, coalesce(g.n, 0) as longest_repeat
  from words t left join lines l on l.rid = t.rid left join inside i on i.rid = t.rid left join longest g on g.rid = t.rid
)
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
    and covered_words <= {MAX_COVERED} * n_words
    and (longest_repeat <= {MAX_REPEAT_WORDS} or longest_repeat < {MIN_REPEAT_WORDS}) as kept
from all_
"""


@query("op2_suffix_array_repetition", OP2_SQL)
def op2(spark, sf_dir):
    return repetition_rules(table(spark, sf_dir, "documents"))
