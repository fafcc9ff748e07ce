"""Binary scans of data files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_binary(spark: SparkSession, paths: str | list[str], glob: str = "*.gz") -> DataFrame:
    """``path, modificationTime, length, content`` of files whose names match ``glob``.

    One load covers every folder given. Filters on ``length`` and ``modificationTime`` reach the scan, so files
    they exclude are not opened, and ``content`` is not read unless selected. Zero-byte files are not listed; use
    the manifest for those. To read files chosen one by one, hand their manifest rows to
    :func:`filedrop.operators.gunzip.decode_files`, which opens them inside the tasks.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(paths)
