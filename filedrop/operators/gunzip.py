"""Gunzip and cut into records: the one step that needs Python, done in Arrow batches.

Large files of several members are decoded by several tasks. A file counts all or nothing: if any part of it cannot be decoded it gives no record. Each file also gives one
outcome row, so records and outcomes come from a single decoding pass.
"""

from __future__ import annotations

import gzip
import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop import constants as C
from filedrop.operators import members, packing
from filedrop.sources import storage

ROWS_PER_BATCH = 8192
# Pieces joined to one batch: those of files with a row or two would cost more memory than their rows.
PIECES_PER_BATCH = 512
# Decoded bytes of one file kept in memory. Longer files are decoded twice, first only to check them.
MEMORY_BYTES = 128 << 20
# Compressed bytes per task when files are opened inside the tasks. Less input is still cut into two tasks per
# core, as files and their compression differ.
TASK_BYTES = 128 << 20
TASKS_PER_CORE = 2
# What a file weighs besides its bytes: the calls that open it.
FILE_BYTES = 64 << 10
# Files above this size are searched for members, which other tasks can decode.
INDEX_BYTES = 16 << 20
# Records of one member that decodes to more than this are dealt out to other tasks afterwards.
DEAL_BYTES = 512 << 20

_TYPES = {
    "drop_kind": ("string", pa.string()),
    "drop_file": ("string", pa.string()),
    "ord": ("bigint", pa.int64()),
    "rec": ("binary", pa.binary()),
    "drop_status": ("string", pa.string()),
    "drop_records": ("bigint", pa.int64()),
}
RECORD = ("drop_file", "ord", "rec")
OUTCOME = ("drop_file", "drop_status", "drop_records")
BOTH = tuple(_TYPES)


def decode_files(
    files: DataFrame,
    record_bytes: int = C.RECORD_BYTES,
    on_error: str = "skip",
    columns: tuple[str, ...] = BOTH,
) -> DataFrame:
    """Record rows (``drop_kind`` is ``record``) and one outcome row (``outcome``) per file.

    ``files`` has ``path`` and either ``content``, or paths that the tasks open themselves. Outcomes are ``ok``,
    ``empty``, ``corrupt``, ``raw`` (only with ``on_error="raw"``: bytes that are no gzip are taken as they are)
    and ``missing``. Read errors fail the task, so that Spark repeats it; they are never taken for a bad file.

    Only ``columns`` leave Python. Without ``rec`` there are no record rows, without ``drop_status`` no outcome rows.
    """
    if on_error not in ("skip", "raw"):
        raise ValueError(f"on_error must be 'skip' or 'raw', not {on_error!r}")
    unknown = set(columns) - set(_TYPES)
    if unknown or not {"rec", "drop_status"} & set(columns):
        raise ValueError(f"columns must be of {list(_TYPES)}, with rec or drop_status among them")
    inline = "content" in files.columns

    def decode(batches):
        pending, rows = [], 0
        for batch in batches:
            paths = batch.column("path")
            contents = batch.column("content") if inline else None
            for i in range(batch.num_rows):
                path = paths[i].as_py()
                if inline:
                    buffer = contents[i].as_buffer()
                    source = (lambda b: lambda: pa.BufferReader(b if b is not None else b""))(buffer)
                    version = None
                else:
                    source = (lambda p: lambda: storage.open_binary(p))(path)
                    version = (lambda p: lambda: (storage.size_of(p), storage.modified(p)))(path)
                for out in _decode_one(path, source, record_bytes, on_error, columns, version):
                    pending.append(out)
                    rows += out.num_rows
                    if rows >= ROWS_PER_BATCH or len(pending) >= PIECES_PER_BATCH:
                        yield pending[0] if len(pending) == 1 else pa.concat_batches(pending)
                        pending, rows = [], 0
                    del out
            # Nothing of a batch is held while the next one is read.
            batch = paths = contents = buffer = source = None
        if pending:
            yield pa.concat_batches(pending)

    read = files.select("path", "content") if inline else files.select("path")
    return read.mapInArrow(decode, ", ".join(f"{c} {_TYPES[c][0]}" for c in columns))


def gunzip_records(files: DataFrame, record_bytes: int = C.RECORD_BYTES, on_error: str = "skip") -> DataFrame:
    """``path, ord, rec``: the records of all decodable files, numbered from 0 in each file."""
    return decode_files(files, record_bytes, on_error, RECORD).withColumnRenamed("drop_file", "path")


def file_outcomes(files: DataFrame, record_bytes: int = C.RECORD_BYTES, on_error: str = "skip") -> DataFrame:
    """``path, status, n_records``: one row per file, whatever happened to it."""
    return decode_files(files, record_bytes, on_error, OUTCOME).toDF("path", "status", "n_records")


def decode_listed(
    files: DataFrame,
    record_bytes: int = C.RECORD_BYTES,
    on_error: str = "skip",
    columns: tuple[str, ...] = BOTH,
    index_bytes: int | None = None,
) -> DataFrame:
    """:func:`decode_files` for listed files (``path, length``), with the work spread by their sizes.

    Paths are packed into tasks of about ``TASK_BYTES`` of input: no task has more than its share and one file. Files above
    ``index_bytes`` (``INDEX_BYTES`` by default) are searched for their members (:mod:`members`), and stretches of members are packed into tasks by what
    they decode to. A single member needs one task to decode, but if it decodes to more than ``DEAL_BYTES`` its records are
    exchanged in blocks, so that what follows is shared. Large files that are no whole chain of members are read from the
    start by one task, which tells what is wrong with them. Paths are listed once.
    """
    length = F.greatest(F.coalesce("length", F.lit(0)), F.lit(0))
    is_large = length > (INDEX_BYTES if index_bytes is None else index_bytes)
    files = files.select("path", "length")
    normal, large = files.filter(~is_large), files.filter(is_large)
    sizes = packing.weigh(files, "path", n=F.when(~is_large, 1), bytes=F.when(~is_large, length), large=F.when(is_large, 1))
    decoded = decode_files(_by_bytes(normal, sizes, length), record_bytes, on_error, columns)
    if not sum(sizes["large"]):
        return decoded
    found = members.index(large)
    others = large.join(found.select("path").distinct(), "path", "left_anti")
    sizes = packing.weigh(others, "path", n=F.lit(1), bytes=length)
    if sum(sizes["n"]):
        decoded = decoded.unionByName(decode_files(_by_bytes(others, sizes, length), record_bytes, on_error, columns))
    if "drop_status" in columns:
        whole = found.groupBy("path").agg(F.first("total").alias("total"))
        values = {
            "drop_kind": F.lit("outcome"), "drop_file": F.col("path"),
            "drop_status": F.when(F.col("total") > 0, "ok").otherwise("empty"),
            "drop_records": F.ceil(F.col("total") / record_bytes),
        }
        none = F.lit(None)
        decoded = decoded.unionByName(whole.select(*(values.get(c, none).cast(_TYPES[c][0]).alias(c) for c in columns)))
    if "rec" not in columns:
        return decoded
    is_long = F.col("decoded") > DEAL_BYTES
    some = _decode_stretches(found.filter(~is_long), record_bytes, columns)
    if some is not None:
        decoded = decoded.unionByName(some)
    numbered = tuple(columns) + tuple(c for c in ("drop_file", "ord") if c not in columns)
    long = _decode_stretches(found.filter(is_long), record_bytes, numbered)
    if long is not None:
        n_bytes = found.filter(is_long).agg(F.sum("decoded")).first()[0]
        block = F.floor(F.col("ord") / ROWS_PER_BATCH)
        decoded = decoded.unionByName(long.repartition(_tasks(n_bytes, n_bytes, files), "drop_file", block).select(*columns))
    return decoded


def _tasks(n_bytes: int, most: int, rows: DataFrame) -> int:
    """Tasks for so much input: at least some per core, at most ``most``."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(-(-n_bytes // TASK_BYTES), min(cores * TASKS_PER_CORE, most), 1)


def _by_bytes(files: DataFrame, sizes: dict[str, list[int]], length) -> DataFrame:
    # Rows of paths are tiny: without a fixed number of partitions Spark would merge them into one task.
    tasks = _tasks(sum(sizes["bytes"]), sum(sizes["n"]), files)
    weights = [b + n * FILE_BYTES for b, n in zip(sizes["bytes"], sizes["n"])]
    return packing.packed(files, "path", length + FILE_BYTES, weights, tasks)


def _decode_stretches(found: DataFrame, record_bytes: int, columns: tuple[str, ...]) -> DataFrame | None:
    """Record rows of stretches of members; None if there are no stretches.

    A record belongs to the stretch in which it begins; the next member is read on to its end.
    """
    named = found.select("*", F.concat_ws("#", F.lpad(F.col("start").cast("string"), 20, "0"), "path").alias("at"))
    weight = F.col("decoded") + FILE_BYTES
    sizes = packing.weigh(named, "at", n=F.lit(1), weight=weight)
    n = sum(sizes["n"])
    if not n:
        return None
    spread = packing.packed(named, "at", weight, sizes["weight"], _tasks(sum(sizes["weight"]), n, found))

    def decode(batches):
        for batch in batches:
            for row in batch.select(["path", "modified", "start", "end", "first", "decoded", "total"]).to_pylist():
                yield from _stretch(row, record_bytes, columns)

    return spread.mapInArrow(decode, ", ".join(f"{c} {_TYPES[c][0]}" for c in columns))


def _stretch(row, record_bytes, columns):
    path, last = row["path"], row["first"] + row["decoded"]
    done, until = -(-row["first"] // record_bytes), -(-last // record_bytes)
    skip, wanted = done * record_bytes - row["first"], min(until * record_bytes, row["total"]) - done * record_bytes
    if wanted <= 0:
        return
    size, held = record_bytes * ROWS_PER_BATCH, bytearray()
    # Members are at the places found only in the version that was searched.
    if storage.modified(path) != row["modified"]:
        raise OSError(f"{path} was replaced while it was read")
    with storage.open_binary(path) as file:
        slabs = members.Slabs(file, storage.size_of(path))
        try:
            for piece in _members_from(slabs, row["start"]):
                held += piece[skip:skip + wanted - len(held)]
                skip = max(skip - len(piece), 0)
                while held and (len(held) >= size or len(held) == wanted):
                    out = _records(path, bytes(held[:size]), done, record_bytes, columns)
                    wanted -= min(len(held), size)
                    del held[:size]
                    done += out.num_rows
                    yield out
                if not wanted:
                    return
        except (EOFError, zlib.error) as e:
            raise OSError(f"{path} was replaced while it was read") from e
    raise OSError(f"{path} was replaced while it was read")


def _members_from(slabs, pos):
    """Decoded bytes of all members from ``pos`` on."""
    while pos < slabs.size:
        pos = yield from members.inflate(slabs, pos)


def _decode_one(path, source, record_bytes, on_error, columns, version=None):
    keep = "rec" in columns
    status, total, data = "ok", 0, None
    # A file that is read twice must be the same both times; if not, the task fails and is repeated.
    before = version() if version else None
    try:
        total, data = _check(source, keep)
    except FileNotFoundError:
        status = "missing"
    except gzip.BadGzipFile:
        if on_error == "raw":
            status, source = "raw", _Raw(source)
            total, data = _check(source, keep)
        else:
            status = "corrupt"
    except (EOFError, zlib.error):
        status = "corrupt"
    if status in ("ok", "raw") and total == 0:
        status = "empty"
    if keep and total:
        done = 0
        for piece in _pieces(source, data, record_bytes * ROWS_PER_BATCH):
            out = _records(path, piece, done, record_bytes, columns)
            done += out.num_rows
            yield out
        if data is None and version and version() != before:
            raise OSError(f"{path} was replaced while it was read")
    if "drop_status" in columns:
        values = {"drop_kind": "outcome", "drop_file": path, "drop_status": status,
                  "drop_records": -(-total // record_bytes)}
        yield pa.RecordBatch.from_arrays(
            [pa.array([values.get(c)], _TYPES[c][1]) for c in columns], names=list(columns)
        )


class _Raw:
    """Marks a source whose bytes are taken as they are."""

    def __init__(self, source):
        self.source = source

    def __call__(self):
        return self.source()


def _open(source):
    raw = source()
    return raw if isinstance(source, _Raw) else gzip.GzipFile(fileobj=raw)


def _check(source, keep):
    """Decode to the end: total length, and the bytes unless they are not wanted or too many to keep."""
    kept, total = io.BytesIO() if keep else None, 0
    with _open(source) as stream:
        while chunk := stream.read(1 << 20):
            total += len(chunk)
            if kept is not None:
                kept.write(chunk)
                if total > MEMORY_BYTES:
                    kept = None
    return total, kept.getbuffer() if kept is not None else None


def _pieces(source, data, size):
    """Whole records of the decoded bytes, ``size`` bytes at a time."""
    if data is not None:
        for at in range(0, len(data), size):
            yield data[at:at + size]
        return
    with _open(source) as stream:
        while chunk := stream.read(size):
            yield chunk


def _records(path, piece, first, record_bytes, columns):
    """Record rows that point into ``piece`` without copying it."""
    n = -(-len(piece) // record_bytes)
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(record_bytes)
    offsets[-1] = len(piece)
    make = {
        "drop_kind": lambda: pa.repeat(pa.scalar("record"), n),
        "drop_file": lambda: pa.repeat(pa.scalar(path), n),
        "ord": lambda: pa.array(np.arange(first, first + n, dtype=np.int64)),
        "rec": lambda: pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(piece)]),
    }
    arrays = [make[c]() if c in make else pa.nulls(n, _TYPES[c][1]) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
