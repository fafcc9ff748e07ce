"""Decide what happens to each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop.functions.names import with_name_parts, with_position_parts
from filedrop.operators.pairing import is_complete

UNKNOWN = "Unknown"


def triage_hourly(pairs: DataFrame) -> DataFrame:
    """Adds transaction date and hour and ``status``: ``valid``, ``unparseable``, ``missing_end``, ``missing_gz``.

    Date and hour are set for valid pairs only.
    """
    date, hour = F.col("transaction_date"), F.col("transaction_hour")
    status = (
        F.when(F.col("gz_key").isNull(), F.lit("missing_gz"))
        .when(F.col("end_key").isNull(), F.lit("missing_end"))
        .when(date.isNull(), F.lit("unparseable"))
        .otherwise(F.lit("valid"))
    )
    return with_name_parts(pairs, "gz_key").select(
        "base", "gz_key", "end_key", "gz_length",
        F.when(is_complete(), date).alias("transaction_date"),
        F.when(is_complete(), hour).alias("transaction_hour"),
        status.alias("status"),
    )


def valid_pairs(triaged: DataFrame) -> DataFrame:
    """``gz_key, end_key, transaction_date, transaction_hour`` of pairs ready to be parsed."""
    return triaged.filter(F.col("status") == "valid").select(
        "gz_key", "end_key", "transaction_date", "transaction_hour"
    )


def in_slot(date: str, hour: str) -> Column:
    """Belongs to the target date and hour."""
    return (F.col("transaction_date") == date) & (F.col("transaction_hour") == hour)


def triage_targeted(pairs: DataFrame, date: str, hour: str) -> DataFrame:
    """Status against one target slot, the first match wins.

    ``missing_end`` / ``missing_gz``, ``unparseable``, ``zero_size``, ``size_unavailable``, ``wrong_slot``,
    ``processed``. ``date_key`` and ``hour_key`` are ``Unknown`` when either cannot be read, else those of the name.
    """
    cut = with_position_parts(pairs.select("*", F.coalesce("gz_key", "end_key").alias("_present")), "_present")
    readable = (F.col("transaction_date") != "") & (F.col("transaction_hour") != "")
    status = (
        F.when(F.col("end_key").isNull(), F.lit("missing_end"))
        .when(F.col("gz_key").isNull(), F.lit("missing_gz"))
        .when(~readable, F.lit("unparseable"))
        .when(F.col("gz_length") == 0, F.lit("zero_size"))
        .when(F.col("gz_length").isNull(), F.lit("size_unavailable"))
        .when(~in_slot(date, hour), F.lit("wrong_slot"))
        .otherwise(F.lit("processed"))
    )
    return cut.select(
        "base", "gz_key", "end_key", "gz_length",
        F.when(readable, F.col("transaction_date")).otherwise(F.lit(UNKNOWN)).alias("date_key"),
        F.when(readable, F.col("transaction_hour")).otherwise(F.lit(UNKNOWN)).alias("hour_key"),
        status.alias("status"),
    )


def apply_outcomes(triaged: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Turn ``processed`` into ``process_error`` where the file's content could not be used."""
    failed = outcomes.filter(F.col("status").isin("corrupt", "missing")).select(
        F.col("path").alias("gz_key"), F.lit(True).alias("_failed")
    )
    # Only processed rows take part: the others, many without a data file, would meet in one join key.
    processed, others = triaged.filter("status = 'processed'"), triaged.filter("status <> 'processed'")
    status = F.when(F.col("_failed"), F.lit("process_error")).otherwise(F.col("status"))
    joined = processed.join(failed, "gz_key", "left").withColumn("status", status)
    return joined.select(*triaged.columns).unionByName(others)
