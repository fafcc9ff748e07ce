"""Audit rows: what happened to which file, at which level."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filedrop.functions.formats import run_slot, to_utc

SCHEMA = "timestamp timestamp, level string, message string, zone string, log_date string"

# Level and wording per status; the text is followed by the file key.
TRIAGE = {
    "valid": ("INFO", "pair accepted: "),
    "unparseable": ("ERROR", "name cannot be read: "),
    "missing_end": ("ERROR", "end marker missing for: "),
    "missing_gz": ("ERROR", "data file missing for: "),
    "invalid_name": ("ERROR", "name fails the check: "),
    "waiting": ("INFO", "waiting for its partner: "),
    "claimed": ("INFO", "another run has claimed: "),
}
DECODED = {
    "ok": ("INFO", "parsed: "),
    "raw": ("WARNING", "no gzip, taken as it is: "),
    "empty": ("WARNING", "no records in: "),
    "corrupt": ("ERROR", "cannot be decoded: "),
    "missing": ("ERROR", "gone before parsing: "),
}
MOVED = {
    "done": ("INFO", "moved: "),
    "failed": ("ERROR", "could not be moved: "),
}


def _choose(status: str, table: dict, at: int) -> Column:
    first, *rest = table.items()
    out = F.when(F.col(status) == first[0], F.lit(first[1][at]))
    for name, values in rest:
        out = out.when(F.col(status) == name, F.lit(values[at]))
    return out


def audit_rows(df: DataFrame, zone: str, as_of: dt.datetime, level: Column | str, message: Column) -> DataFrame:
    """``timestamp, level, message, zone, log_date`` for every row of an outcome frame."""
    return df.select(
        F.lit(to_utc(as_of)).alias("timestamp"),
        (F.lit(level) if isinstance(level, str) else level).alias("level"),
        message.alias("message"),
        F.lit(zone).alias("zone"),
        F.lit(run_slot(as_of)[0]).alias("log_date"),
    )


def audit_invalid(invalid: DataFrame, as_of: dt.datetime) -> DataFrame:
    return audit_rows(invalid, "RDZ", as_of, "ERROR", F.concat(F.lit("invalid file name: "), "file_key"))


def audit_triage(triaged: DataFrame, as_of: dt.datetime) -> DataFrame:
    message = F.concat(_choose("status", TRIAGE, 1), F.coalesce("gz_key", "end_key"))
    return audit_rows(triaged, "TDZ", as_of, _choose("status", TRIAGE, 0), message)


def audit_superseded(superseded: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Files of which another copy was taken; they stay where they are."""
    return audit_rows(superseded, "RDZ", as_of, "WARNING", F.concat(F.lit("another copy was taken than: "), "file_key"))


def audit_outcomes(outcomes: DataFrame, as_of: dt.datetime) -> DataFrame:
    message = F.concat(_choose("status", DECODED, 1), "path", F.lit(", records "), F.col("n_records").cast("string"))
    return audit_rows(outcomes, "TDZ", as_of, _choose("status", DECODED, 0), message)


def audit_targeted(final: DataFrame, as_of: dt.datetime) -> DataFrame:
    """What a targeted run decided about each pair."""
    level = F.when(F.col("status") == "processed", F.lit("INFO")).when(
        F.col("status") == "wrong_slot", F.lit("DEBUG")).otherwise(F.lit("ERROR"))
    message = F.concat(F.col("status"), F.lit(": "), F.coalesce("gz_key", "end_key"))
    return audit_rows(final, "TDZ", as_of, level, message)


def audit_summary(summary: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The daily and hourly figures of a targeted run."""
    figures = [F.concat(F.lit(f", {c} "), F.col(c).cast("string")) for c in ("total", "processed", "unprocessed")]
    size = F.concat(F.lit(", size "), F.coalesce(F.col("processed_size"), F.lit(0)).cast("string"))
    message = F.concat(F.lit("by "), "grouping", F.lit(" "), "value", *figures, size)
    return audit_rows(summary, "GLOBAL", as_of, "INFO", message)


def audit_moves(moves: DataFrame, as_of: dt.datetime) -> DataFrame:
    message = F.concat(_choose("status", MOVED, 1), "source", F.lit(" to "), "destination")
    return audit_rows(moves, "RDZ", as_of, _choose("status", MOVED, 0), message)


def audit_shape(shaped: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Pair rows that cannot be archived as they are."""
    bad = shaped.filter(F.col("shape") != "ok")
    level = F.when(F.col("shape") == "bad_entry", F.lit("ERROR")).otherwise(F.lit("WARNING"))
    message = F.concat_ws(" ", F.lit("pair entry:"), "shape", "gz_key", "end_key")
    return audit_rows(bad, "RDZ", as_of, level, message)


def audit_run(spark: SparkSession, as_of: dt.datetime, events: list[tuple[str, str]]) -> DataFrame:
    """Rows about the run itself, ``(level, message)`` each: DEBUG, INFO, WARNING, ERROR or CRITICAL."""
    df = spark.createDataFrame(events, "level string, message string")
    return audit_rows(df, "GLOBAL", as_of, F.col("level"), F.col("message"))


def union_audit(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)
