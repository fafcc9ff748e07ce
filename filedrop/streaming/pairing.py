"""Pairing as files arrive, with a grace period instead of an hourly poll.

A session window per base name collects its files until ``grace`` has passed without another one. The window
aggregate is native: files of one base are merged before the shuffle and state stays in the JVM. Each session gives
one row, after the watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from filedrop.functions.names import base_key, basename, file_kind
from filedrop.operators.pairing import _sides, is_complete
from filedrop.sources.manifest import drop_files

STATUS = ("paired", "missing_end", "missing_gz")


def pair_stream(
    manifest: DataFrame, grace: str = "10 minutes", delay: str = "10 minutes", replace_all: bool = False
) -> DataFrame:
    """``base, gz_key, end_key, gz_length, first_seen, status`` from a streaming manifest.

    ``grace`` is how long a file waits for its partner, ``delay`` how late a listing may report a file. A listing with an
    overlap brings its own delay, which holds.
    """
    timed = drop_files(manifest)
    if "spark.watermarkDelayMs" not in manifest.schema["modificationTime"].metadata:
        # Parquet may hold times without a zone, which a watermark does not accept.
        timed = timed.withColumn("modificationTime", F.col("modificationTime").cast("timestamp"))
        timed = timed.withWatermark("modificationTime", delay)
    keyed = timed.select(
        base_key(basename("path"), replace_all).alias("base"),
        file_kind("path").alias("kind"),
        "path", "length", "modificationTime",
    )
    sessions = keyed.groupBy("base", F.session_window("modificationTime", grace).alias("session")).agg(*_sides())
    status = (
        F.when(is_complete(), F.lit("paired"))
        .when(F.col("gz_key").isNotNull(), F.lit("missing_end"))
        .otherwise(F.lit("missing_gz"))
    )
    flat = sessions.select(
        "base",
        F.col("gz.path").alias("gz_key"),
        "end_key",
        F.col("gz.length").alias("gz_length"),
        F.col("session.start").alias("first_seen"),
    )
    return flat.select("*", status.alias("status"))


def write_pairs(pairs: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append settled pairs to a Parquet table; ``available_now`` handles what has arrived and stops."""
    writer = pairs.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
