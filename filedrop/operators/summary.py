"""Counts and sizes per day, per hour and per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop.functions.names import base_key, basename, file_kind, is_drop_file, is_valid_name, with_name_parts
from filedrop.operators.pairing import is_complete


def _counters() -> list[Column]:
    """Total counts readable complete pairs only; orphans and unreadable pairs are unprocessed without being in it."""
    status = F.col("status")
    processed = status == "processed"
    in_total = ~status.isin("missing_end", "missing_gz", "unparseable")
    return [
        F.count_if(in_total).alias("total"),
        F.count_if(processed).alias("processed"),
        F.count_if(~processed).alias("unprocessed"),
        F.coalesce(F.sum(F.when(processed, F.col("gz_length"))), F.lit(0).cast("bigint")).alias("processed_size"),
    ]


def daily_summary(triaged: DataFrame) -> DataFrame:
    """``date, total, processed, unprocessed, processed_size`` of a targeted triage."""
    return triaged.groupBy(F.col("date_key").alias("date")).agg(*_counters())


def hourly_summary(triaged: DataFrame) -> DataFrame:
    """The same per hour of day, over all dates."""
    return triaged.groupBy(F.col("hour_key").alias("hour")).agg(*_counters())


def slot_summary(triaged: DataFrame) -> DataFrame:
    """Daily and hourly summary from one pass: ``grouping`` is ``date`` or ``hour``, ``value`` its key."""
    date, hour = F.col("date_key"), F.col("hour_key")
    grouped = triaged.groupingSets([[date], [hour]], date, hour).agg(
        F.grouping(date).alias("_no_date"), *_counters()
    )
    by_hour = F.col("_no_date") == 1
    return grouped.select(
        F.when(by_hour, F.lit("hour")).otherwise(F.lit("date")).alias("grouping"),
        F.when(by_hour, hour).otherwise(date).alias("value"),
        "total", "processed", "unprocessed", "processed_size",
    )


def run_counts(manifest: DataFrame, replace_all: bool = False) -> DataFrame:
    """One row: ``files, invalid_files, drop_files, pairs_found, valid_pairs``, from one pass over the listing."""
    keyed = manifest.select(
        "path",
        basename("path").alias("_name"),
        F.when(is_drop_file("path"), file_kind("path")).alias("_kind"),
    ).select(
        "path", "_kind", F.when(F.col("_kind").isNotNull(), base_key("_name", replace_all)).alias("base"),
        (~is_valid_name("_name")).alias("_bad"),
    )
    per_base = keyed.groupBy("base").agg(
        F.count("*").alias("files"),
        F.count_if("_bad").alias("invalid_files"),
        F.count("_kind").alias("drop_files"),
        F.max(F.when(F.col("_kind") == "gz", F.col("path"))).alias("gz_key"),
        F.max(F.when(F.col("_kind") == "end", F.col("path"))).alias("end_key"),
    )
    readable = F.col("transaction_date").isNotNull()

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)

    return with_name_parts(per_base, "gz_key").agg(
        total("files"), total("invalid_files"), total("drop_files"),
        F.count("base").alias("pairs_found"),
        F.count_if(is_complete() & readable).alias("valid_pairs"),
    )
