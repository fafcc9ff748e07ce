"""Where the members of a large gzip file begin, so that several tasks can inflate one file.

A gzip file is a chain of members, each of which can be inflated without the others. Nothing in the file says where they
begin. Ranges of the file are searched side by side: a range's task inflates from whatever looks like a member's header,
and takes it for a member if the data ends with the right checksum and length. Members that lie inside another one, such as
a gzip file stored in a gzip file, go. Only a file whose members follow each other without a gap from its first byte to its
last has an index; all others, damaged ones among them, have none and are left to be read from the start.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from filedrop.operators import packing
from filedrop.session import new_scratch
from filedrop.sources import storage

#: Bytes of a file that are searched by one row of work.
RANGE_BYTES = 32 << 20
#: More ranges than this share tasks.
MAX_TASKS = 10_000
#: Neighbouring members are put together up to this decoded size.
CHUNK_BYTES = 64 << 20
# Bytes fetched from the store, handed to the inflater and taken from it at a time.
SLAB, STEP, OUT = 4 << 20, 64 << 10, 1 << 20

# Fixed values of the format: magic number and the only method.
HEADER = b"\x1f\x8b\x08"


class Slabs:
    """A file by position; what was fetched last is at hand."""

    def __init__(self, file, size: int):
        self.file = file
        self.size = size
        self.base, self.slab = 0, memoryview(b"")

    def at(self, pos: int, n: int) -> memoryview:
        """Up to ``n`` bytes from ``pos``; fewer only at the end of the file."""
        n = max(min(n, self.size - pos), 0)
        if not self.base <= pos or pos + n > self.base + len(self.slab):
            self.file.seek(pos)
            self.base, self.slab = pos, memoryview(self.file.read(max(n, min(SLAB, self.size - pos))))
        return self.slab[pos - self.base:pos - self.base + n]


def inflate(slabs: Slabs, pos: int):
    """Yields the decoded bytes of the member that begins at ``pos``, and returns where it ends."""
    inflater, data = zlib.decompressobj(31), b""
    while not inflater.eof:
        if not len(data):
            data = slabs.at(pos, STEP)
            pos += len(data)
        # All input may be taken while decoded bytes still wait.
        last = not len(data)
        piece = inflater.decompress(data, OUT)
        data = inflater.unconsumed_tail
        if piece:
            yield piece
        elif last and not inflater.eof:
            raise EOFError("the file ends inside a member")
    return pos - len(inflater.unused_data)


def _measure(slabs: Slabs, pos: int) -> tuple[int, int]:
    decoded, member = 0, inflate(slabs, pos)
    while True:
        try:
            decoded += len(next(member))
        except StopIteration as done:
            return done.value, decoded


def find(slabs: Slabs, start: int, end: int):
    """Yields ``(start, end, decoded)`` of what can be inflated from a header in a range, one after the other."""
    pos = start
    while pos < end:
        piece = bytes(slabs.at(pos, min(STEP, end - pos) + len(HEADER)))
        found = piece.find(HEADER)
        if found < 0:
            pos += max(len(piece) - len(HEADER) + 1, 1)
            continue
        pos += found
        if pos >= end:
            return
        # Three of the flags have no meaning and must not be set.
        if len(flags := slabs.at(pos + 3, 1)) and flags[0] & 0xE0 == 0:
            try:
                after, decoded = _measure(slabs, pos)
            except (zlib.error, EOFError):
                pass
            else:
                yield pos, after, decoded
                pos = after
                continue
        pos += 1


def _search(batches):
    for batch in batches:
        for path, length, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start", "end"))):
            try:
                modified = storage.modified(path)
                if storage.size_of(path) != length:
                    continue
                with storage.open_binary(path) as file:
                    found = list(find(Slabs(file, length), start, end))
            except FileNotFoundError:
                continue
            starts, ends, sizes = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()), pa.array([length] * len(found), pa.int64()),
                 pa.array([modified] * len(found), pa.float64()), *(pa.array(c, pa.int64()) for c in (starts, ends, sizes))],
                names=["path", "length", "modified", "start", "end", "decoded"])


def index(files: DataFrame) -> DataFrame:
    """``path, modified, start, end, first, decoded, total`` for files (``path, length``) that are whole chains of members.

    A row is a stretch of neighbouring members: bytes ``start`` to ``end`` of the file give ``decoded`` of its ``total`` decoded
    bytes, from the ``first`` on. Every path is listed once. The result is written to the shared folder, as files are
    inflated for it.
    """
    spark = files.sparkSession
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(RANGE_BYTES))).alias("start"))
    ranges = ranges.select("*", F.least(F.col("start") + RANGE_BYTES, "length").alias("end"),
                           F.concat_ws("#", F.lpad(F.col("start").cast("string"), 20, "0"), "path").alias("at"))
    counts = packing.weigh(ranges, "at", n=F.lit(1))["n"]
    spread = packing.packed(ranges, "at", F.lit(1), counts, min(max(sum(counts), 1), MAX_TASKS))
    found = spread.mapInArrow(_search, "path string, length bigint, modified double, start bigint, end bigint, decoded bigint")
    every = Window.partitionBy("path")
    before = every.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # Of members inside each other the first to begin holds the rest.
    chain = found.withColumn("_reached", F.coalesce(F.max("end").over(before), F.lit(0))).filter("start >= _reached")
    one_version = F.min("modified").over(every).eqNullSafe(F.max("modified").over(every))
    gapless = F.min(F.col("start") == F.col("_reached")).over(every) & (F.max("end").over(every) == F.col("length"))
    laid = chain.select(
        "*", (gapless & one_version).alias("_whole"), F.coalesce(F.sum("decoded").over(before), F.lit(0)).alias("first"),
        F.sum("decoded").over(every).alias("total"),
    ).filter("_whole")
    stretches = laid.groupBy("path", "modified", "total", F.floor(F.col("first") / CHUNK_BYTES).alias("_chunk")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first"),
        F.sum("decoded").alias("decoded"))
    at = new_scratch(spark, "members")
    stretches.select("path", "modified", "start", "end", "first", "decoded", "total").write.parquet(at)
    return spark.read.parquet(at)
