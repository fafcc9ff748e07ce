"""Carry out a move plan on the executors."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from filedrop.operators import packing
from filedrop.sources import storage

SCHEMA = "source string, destination string, action string, reason string, status string, detail string"
# Work of a task: bytes to copy, and for each file the calls it takes, in bytes that take about as long.
TASK_BYTES = 1 << 30
FILE_BYTES = 1 << 20


def apply_plan(plan: DataFrame, outcome_path: str, root: str = "", retries: int = 3) -> DataFrame:
    """Copy, and delete the source of a ``move`` only after its copy succeeded.

    The moves happen once, while the outcome table at ``outcome_path`` is written; the frame returned reads that
    table. Statuses are ``done``, ``failed`` and ``skipped`` (action ``none``). ``root`` is put before relative keys.

    Nothing at a target is lost: if another file is there, the new one is put beside it, under the time of its source,
    and ``detail`` names the place. A plan with ``length`` and ``modificationTime`` (:func:`moves.with_versions`) knows
    which file it means: a source of another size has been replaced and stays, and a source that is gone counts as moved
    before only if the target has that size and is not older. Without them a missing source is a failure. Any error of a
    file is that file's outcome and never stops the others.
    """
    spark = plan.sparkSession
    known = "length" in plan.columns
    versions = [
        (F.col("length") if known else F.lit(None)).cast("bigint").alias("length"),
        (F.col("modificationTime") if known else F.lit(None)).cast("timestamp").alias("modificationTime"),
    ]
    dealt = plan.select("source", "destination", "action", "reason", *versions)
    weight = F.greatest(F.coalesce("length", F.lit(0)), F.lit(0)) + FILE_BYTES
    totals = packing.weigh(dealt, "source", n=F.lit(1), weight=weight)
    # Rows are tiny but each is a remote call: fix the number of tasks, or Spark would merge them into one.
    cores = spark.sparkContext.defaultParallelism
    tasks = max(-(-sum(totals["weight"]) // TASK_BYTES), min(sum(totals["n"]), cores), 1)
    dealt = packing.packed(dealt, "source", weight, totals["weight"], tasks)
    dealt.mapInArrow(_mover(root, retries), SCHEMA).write.mode("errorifexists").parquet(outcome_path)
    return spark.read.schema(SCHEMA).parquet(outcome_path)


def _mover(root: str, retries: int):
    def move(batches):
        for batch in batches:
            rows = batch.to_pylist()
            outcomes = [_carry_out(r, root, retries) for r in rows]
            statuses, details = zip(*outcomes) if outcomes else ((), ())
            columns = [batch.column(c) for c in ("source", "destination", "action", "reason")]
            columns += [pa.array(statuses, pa.string()), pa.array(details, pa.string())]
            yield pa.RecordBatch.from_arrays(
                columns, names=["source", "destination", "action", "reason", "status", "detail"]
            )

    return move


def _carry_out(row: dict, root: str, retries: int) -> tuple[str, str | None]:
    if row["action"] == "none":
        return "skipped", row["reason"]
    detail = None
    for _ in range(retries):
        try:
            source, target = _absolute(root, row["source"]), _absolute(root, row["destination"])
            return _once(source, target, row["action"], row["length"], row["modificationTime"])
        except (OSError, ValueError, TypeError, AttributeError, pa.ArrowException) as e:
            detail = f"{type(e).__name__}: {e}"
    return "failed", detail


def _moved_before(target: str, length: int | None, since: dt.datetime | None) -> bool:
    """The target is the file that was listed: its size, and written since."""
    if length is None or storage.size_of(target) != length:
        return False
    written = storage.modified(target)
    # Stores keep whole seconds at worst.
    return since is None or written is None or written >= int(since.timestamp())


def _beside(target: str, source: str) -> str:
    """A name for a file whose target is taken by another one; the same on every attempt."""
    return f"{target}.{int((storage.modified(source) or 0) * 1000)}"


def _once(source: str, target: str, action: str, length=None, since=None) -> tuple[str, str | None]:
    size = storage.size_of(source)
    if size is None:
        if action == "move" and _moved_before(target, length, since):
            return "done", "moved before"
        return "failed", "source not found"
    if length is not None and size != length:
        return "failed", "source was replaced after it was listed"
    detail = None
    if storage.size_of(target) is not None and not storage.same_content(source, target):
        target = _beside(target, source)
        detail = f"target is another file; kept as {target}"
        if storage.size_of(target) is not None and not storage.same_content(source, target):
            return "failed", f"target and {target} are other files"
    if storage.size_of(target) is None:
        storage.copy(source, target)
        if storage.size_of(target) != size:
            raise OSError("copy is incomplete")
    if action == "move":
        storage.delete(source)
    return "done", detail


def _absolute(root: str, key: str) -> str:
    if not root or key.startswith("/") or "://" in key or key.startswith("file:"):
        return key
    return storage.join(root, key)
