"""Claims, so that runs that overlap in time do not work on the same files.

A claim is a small file whose name tells a file version and whose content the run that made it. It is created only if absent, so
of any number of runs one gets it; a task that is repeated finds its own. A claim older than the lease belongs to a run that has
died: the next run creates the following generation of it, which again only one run can. The lease must be longer than any run
takes, as a run that goes on after its lease is not stopped.
"""

from __future__ import annotations

import datetime as dt
import time

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from filedrop.sources import storage

#: Claims that one task makes, each a call or two to the store.
PER_TASK = 2_000


def claim(keys: DataFrame, folder: str, run: str, lease: dt.timedelta) -> DataFrame:
    """``key, claimed`` for distinct texts ``key``; a claim is made when the rows are made, so write them once."""

    def take(batches):
        for batch in batches:
            names = batch.column("key").to_pylist()
            won = [_take(_at(folder, k), run.encode(), lease.total_seconds()) for k in names]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(won, pa.bool_())], names=["key", "claimed"])

    return _spread(keys).mapInArrow(take, "key string, claimed boolean")


def release(keys: DataFrame, folder: str, run: str) -> int:
    """Give back the run's claims of ``key``; returns how many there were."""

    def drop(batches):
        for batch in batches:
            given = [_drop(_at(folder, k), run.encode()) for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(given, pa.bool_())], names=["given"])

    return _spread(keys).mapInArrow(drop, "given boolean").filter("given").count()


def _spread(keys: DataFrame) -> DataFrame:
    n, cores = keys.count(), keys.sparkSession.sparkContext.defaultParallelism
    return keys.select("key").repartition(max(-(-n // PER_TASK), min(n, cores), 1), "key")


def _at(folder: str, key: str) -> str:
    # A folder of its own for each first pair of signs keeps single folders short.
    return f"{folder.rstrip('/')}/{key[:2]}/{key}"


def _take(uri: str, run: bytes, lease: float) -> bool:
    generation = 0
    while True:
        name = f"{uri}.{generation}"
        if storage.create_new(name, run):
            return True
        owner, made = _owner(name), storage.modified(name)
        if owner is None or made is None:
            continue  # given back meanwhile
        if owner == run:
            return True
        if time.time() - made <= lease:
            return False
        generation += 1


def _drop(uri: str, run: bytes) -> bool:
    generation = 0
    while (owner := _owner(f"{uri}.{generation}")) is not None:
        if owner == run:
            storage.delete(f"{uri}.{generation}")
            return True
        generation += 1
    return False


def _owner(name: str) -> bytes | None:
    try:
        with storage.open_binary(name) as file:
            return file.read()
    except FileNotFoundError:
        return None


def key_of(*columns) -> Column:
    """A file name for the values of some columns, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
