"""Move plans: ``source, destination, action, reason`` per file. Nothing is touched here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop import constants as C
from filedrop.functions.formats import dated_destination, flat_destination, hive_destination
from filedrop.functions.names import basename, with_name_parts


#: Parts that the one name shared by all folder keys is dealt to.
SALTS = 64


def _both_files(pairs: DataFrame, *keep: str) -> DataFrame:
    """One row per file of each pair; absent and empty keys give no row."""
    files = pairs.select(*keep, F.explode(F.array("gz_key", "end_key")).alias("file_key"))
    return files.filter(F.col("file_key") != "")


def _plan(df: DataFrame, destination: Column, action: Column | str, reason: Column | str) -> DataFrame:
    as_column = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(
        F.col("file_key").alias("source"),
        destination.alias("destination"),
        as_column(action).alias("action"),
        as_column(reason).alias("reason"),
    )


def quarantine_plan(
    files: DataFrame, root: str = C.QUARANTINE_ROOT, reason: str = "quarantine", flat_unreadable: bool = False
) -> DataFrame:
    """Dated quarantine of ``file_key`` rows.

    A name that gives no date has no dated folder: its action is ``none``, or a flat move with ``flat_unreadable``.
    """
    named = with_name_parts(files.select("file_key"), "file_key")
    readable = F.col("transaction_date").isNotNull()
    dated = dated_destination(root, "file_key", "transaction_date", "transaction_hour")
    if flat_unreadable:
        destination = F.when(readable, dated).otherwise(flat_destination(root, "file_key"))
        action: Column | str = "move"
    else:
        destination = F.when(readable, dated)
        action = F.when(readable, F.lit("move")).otherwise(F.lit("none"))
    return _plan(named, destination, action, F.when(readable, F.lit(reason)).otherwise(F.lit("unparseable")))


def error_plan(pairs: DataFrame, root: str = C.QUARANTINE_ROOT) -> DataFrame:
    """Dated quarantine of whichever files of a pair exist."""
    return quarantine_plan(_both_files(pairs), root, reason="error")


def quarantine_plan_flat(triaged: DataFrame, root: str = C.QUARANTINE_ROOT) -> DataFrame:
    """Flat quarantine of all files of a targeted triage that were not processed."""
    failed = triaged.filter(F.col("status") != "processed")
    return _plan(_both_files(failed, "status"), flat_destination(root, "file_key"), "move", F.col("status"))


def archive_plan(valid: DataFrame, root: str = C.ARCHIVE_ROOT) -> DataFrame:
    """Dated archive of both files of each pair, by the pair's transaction date and hour."""
    files = _both_files(valid, "transaction_date", "transaction_hour")
    destination = dated_destination(root, "file_key", "transaction_date", "transaction_hour")
    return _plan(files, destination, "move", "archive")


def archive_plan_hive(triaged: DataFrame, root: str = C.ARCHIVE_ROOT) -> DataFrame:
    """Archive under ``year=/month=/day=/hour=`` of the pairs a targeted triage processed."""
    files = _both_files(triaged.filter(F.col("status") == "processed"), "date_key", "hour_key")
    return _plan(files, hive_destination(root, "file_key", "date_key", "hour_key"), "move", "archive")


def copy_plan(manifest: DataFrame, prefix: str, target: str) -> DataFrame:
    """Copy everything below ``prefix`` into one folder; sources stay.

    ``reason`` says ``duplicate`` where several sources share a destination. Names are counted before the shuffle.
    Folder keys, which may be many, all have an empty name: that one name is dealt to ``SALTS`` parts of the join.
    :func:`unique_destinations` tells duplicates apart before they are copied.
    """
    files = manifest.filter(F.col("path").startswith(prefix)).select(
        F.col("path").alias("file_key"), basename("path").alias("_name")
    )
    is_folder = F.col("_name") == ""
    salt = F.when(is_folder, F.pmod(F.xxhash64("file_key"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(is_folder, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = files.groupBy("_name").count().filter("count > 1").select(
        "_name", F.explode(salts).alias("_salt"), F.lit(True).alias("_repeated")
    )
    reason = F.when(F.col("_repeated"), F.lit("duplicate")).otherwise(F.lit("copy"))
    destination = F.concat(F.lit(target.rstrip("/") + "/"), F.col("_name"))
    joined = files.withColumn("_salt", salt).join(repeated, ["_name", "_salt"], "left")
    return _plan(joined, destination, "copy", reason)


def merge_plans(*plans: DataFrame) -> DataFrame:
    """One action per source: any move or copy beats ``none``, then the plan named first wins."""
    numbered = [p.select("*", F.lit(i).alias("_rank")) for i, p in enumerate(plans)]
    merged = numbered[0]
    for p in numbered[1:]:
        merged = merged.unionByName(p)
    idle = (F.col("action") == "none").alias("_idle")
    first = F.min(F.struct(idle, "_rank", "destination", "action", "reason")).alias("_first")
    return merged.groupBy("source").agg(first).select(
        "source", "_first.destination", "_first.action", "_first.reason"
    )


def unique_destinations(plan: DataFrame) -> DataFrame:
    """No two sources share a destination: all but the smallest get a suffix made from their own path.

    Only destinations that occur twice take part in the join.
    """
    shared = (
        plan.filter(F.col("action") != "none").groupBy("destination")
        .agg(F.min("source").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    )
    other = F.col("_first").isNotNull() & (F.col("action") != "none") & (F.col("source") != F.col("_first"))
    apart = F.concat("destination", F.lit("."), F.left(F.md5(F.col("source").cast("binary")), F.lit(16)))
    joined = plan.join(shared, "destination", "left")
    return joined.withColumn("destination", F.when(other, apart).otherwise(F.col("destination"))).select(*plan.columns)


def with_versions(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds ``length`` and ``modificationTime`` of each source as listed, so that a move knows which file it means."""
    listed = manifest.select(F.col("path").alias("source"), "length", "modificationTime")
    return plan.join(listed.dropDuplicates(["source"]), "source", "left")
