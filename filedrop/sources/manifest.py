"""Manifest of delivered files: path, modification time and size.

Spark's own file sources skip zero-byte files, and end markers are usually empty, so the listing is a Python data
source. Nothing of it is held whole. While the query is planned, the folders of ``depth`` levels are looked at, up to
``FIRST_ENTRIES`` entries of each, and dealt to at most ``MAX_LISTING_TASKS`` tasks. A folder that goes on after that is
not read further by the driver: ``FLAT_TASKS`` tasks share it by a hash of the names in it. Each of them reads the names,
which are cheap, and looks up times and sizes of its own share only, which are not. Stores that give times and sizes with
the names are streamed by one task per folder. What is wanted (:class:`Wanted`) is told to the listing: a path prefix decides
which folders are read at all, and a file is looked up only if its name fits. It is told by options and not by Spark's own
filter pushdown for Python sources: there the filters of one query stay with the relation, and another query on the same
DataFrame would get its rows.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import os
import time
import zlib
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from filedrop import constants as C
from filedrop.functions.formats import to_utc
from filedrop.functions.names import _col, is_drop_file
from filedrop.sources import storage

SCHEMA = "path string, modificationTime timestamp, length bigint"
ROWS_PER_BATCH = 10_000
#: More folders than this share tasks; none is left out.
MAX_LISTING_TASKS = 10_000
#: Entries of a folder that the driver looks at to plan.
FIRST_ENTRIES = 10_000
#: Tasks that share a folder with more entries.
FLAT_TASKS = 32
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
#: Folder levels that a listing is split by unless told otherwise.
DEPTH = 1


@dataclass(frozen=True)
class Wanted:
    """Which files to list: a path prefix, any of some suffixes, and bounds of time (microseconds) and size, both inclusive."""

    starts: str = ""
    ends: tuple[str, ...] = ()
    since: int | None = None
    until: int | None = None
    least: int | None = None
    most: int | None = None

    def path(self, path: str) -> bool:
        return path.startswith(self.starts) and (not self.ends or path.endswith(self.ends))

    def known(self, micros: int, size: int) -> bool:
        bounds = (self.since, micros, self.until), (self.least, size, self.most)
        return all((low is None or low <= x) and (high is None or x <= high) for low, x, high in bounds)

    def options(self) -> dict[str, str]:
        return {"wanted": json.dumps(asdict(self))}

    @classmethod
    def of(cls, options) -> Wanted:
        given = json.loads(options.get("wanted", "{}"))
        return cls(**{**given, "ends": tuple(given.get("ends", ()))})


class Folders(InputPartition):
    """Folders to list: each with or without what lies below it, and which share of the names in it.

    Times in seconds bound a streaming batch.
    """

    def __init__(
        self, folders: list[tuple[str, bool, tuple[int, int]]], after: float | None = None, until: float | None = None,
        wanted: Wanted = Wanted(),
    ):
        self.folders = folders
        self.after = after
        self.until = until
        self.wanted = wanted


def _leads_to(folder: str, starts: str) -> bool:
    """Whether files below a folder can begin with ``starts``."""
    inside = folder.rstrip("/") + "/"
    return inside.startswith(starts) or starts.startswith(inside)


def _name_starts(folder: str, starts: str) -> str:
    """What the names in a folder must begin with."""
    inside = folder.rstrip("/") + "/"
    return starts[len(inside):].split("/")[0] if starts.startswith(inside) else ""


def _folders(root: str, depth: int, after: float | None = None, until: float | None = None, wanted: Wanted = Wanted()) -> list[Folders]:
    """Split by folder, ``depth`` levels down; a folder split further is also listed for its own files."""
    starts, root = wanted.starts, storage.normalise(root)
    if storage.is_local(root) and not os.path.isdir(root):
        raise FileNotFoundError(f"there is no folder {root}")
    level, found = [root] if _leads_to(root, starts) else [], []
    for _ in range(depth):
        below = []
        for folder in level:
            first = list(itertools.islice(storage.entries(folder, _name_starts(folder, starts)), FIRST_ENTRIES + 1))
            if len(first) > FIRST_ENTRIES:
                tasks = FLAT_TASKS if storage.is_local(folder) else 1
                found.extend((folder, True, (i, tasks)) for i in range(tasks))
                continue
            if any(not e.is_folder for e in first):
                found.append((folder, False, (0, 1)))
            children = sorted(storage.join(folder, e.name) for e in first if e.is_folder)
            below.extend(c for c in children if _leads_to(c, starts))
        level = below
    found += [(folder, True, (0, 1)) for folder in level]
    # Without any partition Spark would call read(None).
    tasks = min(max(len(found), 1), MAX_LISTING_TASKS)
    return [Folders(found[i::tasks], after, until, wanted) for i in range(tasks)]


def _files(part: Folders):
    """``(path, microseconds, size)`` of the wanted files of some folders, one by one."""
    wanted, starts = part.wanted, part.wanted.starts
    for top, recursive, (share, shares) in part.folders:
        pending = [top]
        while pending:
            folder = pending.pop()
            for name, is_folder, stat in storage.entries(folder, _name_starts(folder, starts)):
                if folder == top and shares > 1 and zlib.crc32(os.fsencode(name)) % shares != share:
                    continue
                path = storage.join(folder, name)
                if is_folder:
                    if recursive and _leads_to(path, starts):
                        pending.append(path)
                    continue
                known = stat() if wanted.path(path) else None
                if known is None or part.until is not None and not part.after < known[0] <= part.until:
                    continue
                micros = int(known[0] * 1_000_000)
                if wanted.known(micros, known[1]):
                    yield path, micros, known[1]


def _list(part: Folders):
    """Arrow batches of the files of some folders."""
    files = _files(part)
    while batch := list(itertools.islice(files, ROWS_PER_BATCH)):
        yield _to_batch(batch)


class ManifestReader(DataSourceReader):
    def __init__(self, root: str, depth: int, wanted: Wanted):
        self.root = root
        self.depth = depth
        self.wanted = wanted

    def partitions(self):
        return _folders(self.root, self.depth, wanted=self.wanted)

    def read(self, partition):
        return _list(partition)


class ManifestStreamReader(DataSourceStreamReader):
    """Files by modification time: each batch lists what changed since the last one, and ``overlap`` seconds before.

    The clock is read ``settle`` seconds late, so that files written in the same instant are all visible. A file that
    becomes visible late, with an older time, is found as long as it is not older than the overlap; what lies in the
    overlap is given again, and :func:`stream_manifest` drops what has been seen.
    """

    def __init__(self, root: str, depth: int, settle: float, overlap: float):
        self.root = root
        self.depth = depth
        self.settle = settle
        self.overlap = overlap

    def initialOffset(self):
        return {"until": 0.0}

    def latestOffset(self):
        return {"until": time.time() - self.settle}

    def partitions(self, start, end):
        return _folders(self.root, self.depth, start["until"] - self.overlap, end["until"])

    def read(self, partition):
        return _list(partition)


class ManifestSource(DataSource):
    """``spark.read.format("file_manifest").load(root)``, also as ``readStream``.

    Options: ``depth``, the folder levels to split the listing by; ``wanted``, see :class:`Wanted`, for batches; ``settle`` and
    ``overlap``, seconds, for streams.
    """

    @classmethod
    def name(cls):
        return "file_manifest"

    def schema(self):
        return SCHEMA

    def _depth(self) -> int:
        return int(self.options.get("depth", str(DEPTH)))

    def reader(self, schema):
        return ManifestReader(self.options["path"], self._depth(), Wanted.of(self.options))

    def streamReader(self, schema):
        seconds = [float(self.options.get(k, v)) for k, v in (("settle", "5"), ("overlap", "0"))]
        return ManifestStreamReader(self.options["path"], self._depth(), *seconds)


def _to_batch(rows) -> pa.RecordBatch:
    paths, micros, sizes = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array(micros, pa.int64()).cast(pa.timestamp("us", tz="UTC")), pa.array(sizes, pa.int64())],
        names=["path", "modificationTime", "length"],
    )


def read_manifest(
    spark: SparkSession, root: str, depth: int = DEPTH, prefix: str = "", suffixes: tuple[str, ...] = (),
    since: dt.datetime | None = None, until: dt.datetime | None = None,
    least: int | None = None, most: int | None = None,
) -> DataFrame:
    """All files under a folder, recursively and without a page limit; see ``depth`` above for nested folders.

    What else is given limits the listing itself: a path prefix, see :func:`below`, any of some suffixes, and bounds of the
    modification time and the size, all inclusive.
    """
    micros = [None if t is None else (to_utc(t) - _EPOCH) // dt.timedelta(microseconds=1) for t in (since, until)]
    wanted = Wanted(below(root, prefix) if prefix else "", tuple(suffixes), *micros, least, most)
    spark.dataSource.register(ManifestSource)
    return spark.read.format("file_manifest").option("depth", depth).options(**wanted.options()).load(root)


def stream_manifest(
    spark: SparkSession, root: str, depth: int = DEPTH, settle: float = 5, overlap: float = 0
) -> DataFrame:
    """Files as they arrive under a folder.

    Without ``overlap`` a file must be visible ``settle`` seconds after its modification time. Uploads that take longer, or
    copies that keep their times, need an overlap as long: each batch then lists that much again, and what was given before
    is dropped by state that holds the paths, times and sizes of that time.
    """
    spark.dataSource.register(ManifestSource)
    stream = spark.readStream.format("file_manifest").option("depth", depth).option("settle", settle)
    files = stream.option("overlap", overlap).load(root)
    if not overlap:
        return files
    late = files.withWatermark("modificationTime", f"{int(overlap + settle) + 60} seconds")
    return late.dropDuplicatesWithinWatermark(["path", "modificationTime", "length"])


def from_inventory(df: DataFrame, path: str = "path", time: str = "modificationTime", size: str = "length") -> DataFrame:
    """A manifest from any table that lists keys, times and sizes."""
    return df.select(
        F.col(path).cast("string").alias("path"),
        F.col(time).cast("timestamp").alias("modificationTime"),
        F.col(size).cast("bigint").alias("length"),
    )


def drop_files(manifest: DataFrame) -> DataFrame:
    """Data files and end markers; folder keys, blank keys and other files go.

    A key with either suffix is neither blank nor a folder, so the suffix test decides alone.
    """
    return manifest.filter(is_drop_file("path"))


def with_prefix_and_suffix(manifest: DataFrame, prefix: str = "") -> DataFrame:
    """Drop files below a key prefix, such as a month folder."""
    return manifest.filter(F.col("path").startswith(prefix) & is_drop_file("path"))


def below(root: str, prefix: str) -> str:
    """A prefix in the spelling of listed paths: relative to the root, or absolute in any spelling of its scheme.

    A prefix outside the root is an error, not an empty listing.
    """
    home = storage.normalise(root).rstrip("/") + "/"
    if not prefix:
        return home
    absolute = prefix.startswith("/") or ":/" in prefix
    full = storage.normalise(prefix) if absolute else home + prefix
    if not full.startswith(home):
        raise ValueError(f"{prefix} is not below {root}")
    return full


def list_prefix(spark: SparkSession, root: str, prefix: str = "", depth: int = DEPTH) -> DataFrame:
    """Drop files whose path starts with a prefix; only the prefix's folder is listed, not the whole root."""
    full = below(root, prefix)
    folder = full[: full.rindex("/") + 1]
    return with_prefix_and_suffix(read_manifest(spark, folder, depth, full, (C.GZ_SUFFIX, C.END_SUFFIX)), full)


def is_recent(as_of: dt.datetime, time="modificationTime", window: dt.timedelta = dt.timedelta(hours=1)) -> Column:
    """Modified within the window that ends at ``as_of``; both ends count.

    The bounds are literals, so Parquet manifests are pruned by the scan.
    """
    end = to_utc(as_of)
    return _col(time).between(F.lit(end - window), F.lit(end))


def recent_files(manifest: DataFrame, as_of: dt.datetime, window: dt.timedelta = dt.timedelta(hours=1)) -> DataFrame:
    """Drop files modified within the window that ends at ``as_of``."""
    return drop_files(manifest).filter(is_recent(as_of, window=window))


def zero_size(manifest: DataFrame) -> DataFrame:
    """Empty data files."""
    return manifest.filter(F.col("path").endswith(".gz") & (F.col("length") == 0))
