"""Every listed file to one status, as files arrive: a stateful processor with event-time timers.

The stream's clock is the latest modification time that earlier batches have seen. A file waits for its partner in the
state of its base. A pair leaves in the batch that completes it, not when its grace period is over; a lone file leaves when
the clock has passed its time by ``grace``; and a file that comes when the clock has passed that already, and that nobody
waits for, leaves at once as ``late``. Of several copies of one kind the greatest path stays and the others leave as
``superseded``. So each file gets exactly one row, or still waits.

Spark drops rows behind its watermark before a processor sees them, which is why late files had no row. Here the watermark
lags ``RETENTION`` behind the clock, and timers are set that much earlier: nothing is dropped, and lateness is the
processor's decision.

State is one file for each waiting base. Every look at it and every timer is a call from Python to the JVM, so bases share state:
they are dealt to ``BUCKETS`` groups by a hash, and a group with new files reads what waits in it once, writes it once, and has one
timer, for the file that has waited longest. The rows of a group are exchanged and handled together, as a stream of batches; held
of a batch are the greatest file of each kind and base of one group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from filedrop.functions.names import base_key, basename, file_kind
from filedrop.sources.manifest import drop_files

RESULT = ("base string, path string, kind string, length bigint, modificationTime timestamp, status string, "
          "partner string")
STATUS = ("paired", "missing_end", "missing_gz", "late", "superseded")
#: Files older than this against the clock are dropped by Spark without a row.
RETENTION = dt.timedelta(days=3650)
# Fixed value: the state store that Spark asks for by this name where timers are used.
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: Groups of bases that share state and a timer. A checkpoint goes on only with the number it was begun with.
BUCKETS = 1024

# One element for each base that waits.
_FILES = "base array<string>, path array<string>, kind array<string>, length array<bigint>, ms array<bigint>"


class Settling(StatefulProcessor):
    """State of a group of bases: the file that waits, of either kind, for each of them."""

    def __init__(self, grace: dt.timedelta):
        self.grace = grace // dt.timedelta(milliseconds=1)
        self.lag = RETENTION // dt.timedelta(milliseconds=1)

    def init(self, handle):
        self.handle = handle
        self.waiting = handle.getValueState("waiting", _FILES)

    def close(self):
        pass

    def _rows(self, files):
        """A frame of ``(base, file, status, partner)``."""
        bases, found, status, partners = zip(*files)
        path, kind, length, ms = zip(*found)
        return pd.DataFrame({
            "base": bases, "path": path, "kind": kind, "length": pd.array(length, "Int64"),
            "modificationTime": pd.to_datetime(ms, unit="ms"), "status": status,
            "partner": pd.Series(partners, dtype=object),
        })

    def _held(self) -> dict[str, tuple]:
        """What waits, by base."""
        columns = self.waiting.get()
        return {row[0]: row[1:] for row in zip(*columns)} if columns is not None else {}

    def _hold(self, held: dict[str, tuple], before: int | None) -> None:
        """Write what waits, and set the timer for the first of it; ``before`` is the timer that stands."""
        if held:
            self.waiting.update(tuple(map(list, zip(*((base, *file) for base, file in held.items())))))
        else:
            self.waiting.clear()
        timer = self._timer(held)
        if timer != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if timer is not None:
                self.handle.registerTimer(timer)

    def _timer(self, held: dict[str, tuple]) -> int | None:
        return min(file[3] for file in held.values()) + self.grace - self.lag if held else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        before, changed = self._timer(held), False
        best: dict[str, dict[str, tuple]] = {}
        for frame in rows:
            out = []
            lengths = [None if gone else int(n) for n, gone in zip(frame["length"], frame["length"].isna())]
            files = zip(frame["path"], frame["kind"], lengths, frame["ms"].tolist())
            for base, file in zip(frame["base"], files):
                kinds = best.get(base)
                if kinds is None:
                    old = held.get(base)
                    kinds = best[base] = {old[1]: old} if old else {}
                other = kinds.get(file[1])
                if other is None or file[0] > other[0]:
                    kinds[file[1]] = file
                    out += [(base, other, "superseded", None)] if other else []
                else:
                    out.append((base, file, "superseded", None))
            if out:
                yield self._rows(out)
        watermark = timerValues.getCurrentWatermarkInMs()
        out = []
        for base, kinds in best.items():
            if len(kinds) == 2:
                changed |= held.pop(base, None) is not None
                out += [(base, kinds["gz"], "paired", kinds["end"][0]), (base, kinds["end"], "paired", kinds["gz"][0])]
                continue
            (file,) = kinds.values()
            if file == held.get(base):
                continue
            if watermark > 0 and file[3] + self.grace < watermark + self.lag:
                changed |= held.pop(base, None) is not None
                out.append((base, file, "late", None))
            else:
                changed, held[base] = True, file
        if changed:
            self._hold(held, before)
        if out:
            yield self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, clock = self._held(), timerValues.getCurrentWatermarkInMs() + self.lag
        # As Spark's timers, at the clock's time too; Spark removes the timer that has expired, and that of the others is later.
        over = {base: file for base, file in held.items() if file[3] + self.grace <= clock}
        self._hold({base: file for base, file in held.items() if base not in over}, None)
        if over:
            yield self._rows([(b, f, "missing_end" if f[1] == "gz" else "missing_gz", None) for b, f in over.items()])


def settle_stream(
    manifest: DataFrame, grace: dt.timedelta = dt.timedelta(minutes=10), replace_all: bool = False
) -> DataFrame:
    """``base, path, kind, length, modificationTime, status, partner``: a row for each file of a streaming manifest.

    Times are kept to the millisecond. Files without a time cannot be judged and are left out, as are keys that are no
    drop files.
    """
    time = F.col("modificationTime").cast("timestamp")
    keyed = drop_files(manifest).filter("modificationTime is not null").select(
        base_key(basename("path"), replace_all).alias("base"), "path", file_kind("path").alias("kind"), "length",
        F.unix_millis(time).alias("ms"), time.alias("clock"),
    )
    timed = keyed.withWatermark("clock", f"{RETENTION.days} days").withColumn("bucket", F.pmod(F.xxhash64("base"), F.lit(BUCKETS)))
    return timed.groupBy("bucket").transformWithStateInPandas(Settling(grace), RESULT, "Append", "EventTime")


def write_settled(settled: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append settled files to a Parquet table; ``available_now`` handles what has arrived and stops."""
    conf = settled.sparkSession.conf
    before = conf.get(PROVIDER)
    writer = settled.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    conf.set(PROVIDER, ROCKS_DB)
    try:
        return writer.start(path)
    finally:
        conf.set(PROVIDER, before)


def statuses(listed: DataFrame, settled: DataFrame) -> DataFrame:
    """Every listed drop file with its status and partner; those that still wait are ``waiting``."""
    found = settled.select("path", F.unix_millis("modificationTime").alias("ms"), "status", "partner")
    files = drop_files(listed).filter("modificationTime is not null").withColumn(
        "ms", F.unix_millis(F.col("modificationTime").cast("timestamp"))
    )
    return files.join(found, ["path", "ms"], "left").drop("ms").withColumn("status", F.coalesce("status", F.lit("waiting")))
