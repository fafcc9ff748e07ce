"""Pair data files with their end markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop.functions.names import base_key, basename, file_kind
from filedrop.sources.manifest import drop_files


def pair_files(manifest: DataFrame, replace_all: bool = False) -> DataFrame:
    """``base, gz_key, end_key, gz_length``: one row per base name, one shuffle.

    The same base in several folders keeps the greatest path of each kind. Copies of a base are merged before the
    shuffle, so a base that fills a third of the listing does not travel whole.
    """
    keyed = drop_files(manifest).select(
        base_key(basename("path"), replace_all).alias("base"),
        file_kind("path").alias("kind"),
        "path",
        "length",
    )
    return keyed.groupBy("base").agg(*_sides()).select(
        "base",
        F.col("gz.path").alias("gz_key"),
        "end_key",
        F.col("gz.length").alias("gz_length"),
    )


def _sides() -> list[Column]:
    return [
        F.max(F.when(F.col("kind") == "gz", F.struct("path", "length"))).alias("gz"),
        F.max(F.when(F.col("kind") == "end", F.col("path"))).alias("end_key"),
    ]


def is_complete() -> Column:
    """Both files of the pair are there."""
    return F.col("gz_key").isNotNull() & F.col("end_key").isNotNull()


def complete_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(is_complete())


def orphans(pairs: DataFrame) -> DataFrame:
    """``base, file_key, status`` of files without a partner.

    Works on the pairs already built, so no second scan or anti join is needed.
    """
    status = F.when(F.col("gz_key").isNotNull(), F.lit("missing_end")).otherwise(F.lit("missing_gz"))
    return pairs.filter(~is_complete()).select(
        "base", F.coalesce("gz_key", "end_key").alias("file_key"), status.alias("status")
    )


def orphan_keys(pairs: DataFrame) -> DataFrame:
    """``file_key``: data files without marker and markers without data file, as one list."""
    return orphans(pairs).select("file_key")


def check_shape(files: DataFrame) -> DataFrame:
    """Adds ``shape`` to pair rows: ``bad_entry`` (a value is missing), ``empty_key`` or ``ok``."""
    values = [F.col(c) for c in ("gz_key", "end_key", "transaction_date", "transaction_hour")]
    missing = values[0].isNull()
    for v in values[1:]:
        missing = missing | v.isNull()
    empty = (F.col("gz_key") == "") | (F.col("end_key") == "")
    return files.withColumn(
        "shape", F.when(missing, F.lit("bad_entry")).when(empty, F.lit("empty_key")).otherwise(F.lit("ok"))
    )
