"""What the operators share: words, hashes of words, Arrow text buffers, splits and written steps.

A word is ``[^\\x20\\x09-\\x0D]+`` everywhere. The kernels work on the UTF-8 bytes of many texts at once: the separators
are ASCII, so a byte search finds the same words as a search by characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filedrop.session import new_scratch
from filedrop.sinks.tables import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Texts handled at once in a task, in bytes; one longer text is handled alone.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting by which the shuffle files of a query go when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Written once to the shared folder and read from there: later steps survive lost executors and repeat nothing.

    What was shuffled for it is not needed again and goes from the executors' disks at once.
    """
    spark = df.sparkSession
    before, path = spark.conf.get(SHUFFLE_CLEANUP, "false"), new_scratch(spark, tag)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        out = materialise(df, path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out._scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more; what was made from them must have been written too."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_remainder(key: str, mod: int, rest: int) -> Column:
    """``crc32(key as text) mod mod = rest``; a missing key is never in it."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % mod == rest, F.lit(False))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and ``n + 1`` offsets; missing texts are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = pc.fill_null(array, "")
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """``(batch, bytes, offsets)`` of record batches, cut so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        data, at = utf8(batch.column(column))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[at[i] : at[j]], at[i : j + 1] - at[i]
            i = j


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first word (``n + 1`` bounds)."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]]
    first[begins] = inside[begins]
    last[ends - 1] = inside[ends - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64; the table grows with the longest slice seen."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            full = np.full(n, base, np.uint64)
            full[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[i] = np.multiply.accumulate(full)
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, alike on every machine."""
    power, inverse = _powers(max(len(data), SLICE_BYTES) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + _U(1)) * power[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * inverse[starts])


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words, and bounds by text. A shorter text with a word is one window."""
    n = np.diff(bounds)
    end = np.repeat(bounds[1:], n)
    at = np.arange(len(words))
    whole = at + width <= end
    short = np.zeros(len(words), bool)
    tiny = np.flatnonzero((n > 0) & (n < width))
    short[bounds[tiny]] = True
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    h = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            part = padded[k : k + len(words)]
            part = np.where(at + k < end, part, _U(0)) if len(tiny) else part
            h = (h * _STEP) ^ mix(part + _U(k + 1))
            h = h * _U(0xC2B2AE3D27D4EB4F) + _U(k)
    keep = whole | short
    per_text = np.zeros(len(n) + 1, np.int64)
    per_text[1:] = np.cumsum(np.maximum(n - width + 1, (n > 0).astype(np.int64)))
    return mix(h[keep]), per_text


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]

