"""Name check over a whole listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filedrop.functions.names import basename, is_valid_name


def check_names(manifest: DataFrame, path: str = "path") -> DataFrame:
    """``file_key, filename, is_valid`` of every key."""
    named = manifest.select(F.col(path).alias("file_key"), basename(F.col(path)).alias("filename"))
    return named.select("file_key", "filename", is_valid_name("filename").alias("is_valid"))


def invalid_files(manifest: DataFrame, path: str = "path") -> DataFrame:
    """``file_key`` of every key whose name fails the check; stays distributed."""
    return check_names(manifest, path).filter(~F.col("is_valid")).select("file_key")
