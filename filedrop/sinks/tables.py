"""Partitioned appends, counted while they are written, and their checks by reading back."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from filedrop.operators.audit import SCHEMA as AUDIT_SCHEMA
from filedrop.sources.layout import Layout

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whole contents that go to Python at once. By default it would be as many as a task has, up to 10,000.
CONTENTS_PER_BATCH = 500


@contextmanager
def pending_apart(spark: SparkSession, root: str):
    """Options for an append below ``root`` that may run at the same time as others.

    Until it commits, Hadoop's committer keeps a write in ``_temporary/<attempt>`` of the target. All writes would share
    attempt 0, take each other's files for their own, and remove the whole folder when they are done. Here each has an
    attempt of its own and removes only that.
    """
    attempt = 1 + uuid.uuid4().int % (2**31 - 1)
    try:
        yield {"mapreduce.job.application.attempt.id": str(attempt),
               "mapreduce.fileoutputcommitter.cleanup.skipped": "true"}
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_temporary/{attempt}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def append_partitioned(df: DataFrame, root: str, by: tuple[str, ...] = ("date", "hour")) -> int:
    """Append below ``root`` in ``date=/hour=`` folders; returns the rows written.

    The count is observed by the write itself. Run date and hour are constants, so no sort is planned.
    """
    seen = Observation()
    with pending_apart(df.sparkSession, root) as options:
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("append").options(**options).partitionBy(*by).parquet(root)
    return seen.get["rows"]


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType | str) -> DataFrame:
    """Read with an explicit schema: inference would turn the hour ``05`` into the number 5."""
    return spark.read.schema(schema).parquet(root)


@contextmanager
def contents_apart(spark: SparkSession):
    """While a write lasts, rows go to Python few at a time: rows of whole files are as large as the files are."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(CONTENTS_PER_BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


@contextmanager
def concurrent_writers(spark: SparkSession, n: int):
    """Let a task keep ``n`` partition files open, so that rows need no sort by partition before the write."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(n))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def append_parsed(tagged: DataFrame, root: str) -> None:
    """Append record rows and file outcome rows in one job, so both are committed or neither.

    They lie in ``drop_kind=record`` and ``drop_kind=outcome`` below ``root``.
    """
    spark = tagged.sparkSession
    with concurrent_writers(spark, 2), pending_apart(spark, root) as options:
        tagged.write.mode("append").options(**options).partitionBy("drop_kind", "date", "hour").parquet(root)


def _parsed_schema(layout: Layout) -> T.StructType:
    extra = "drop_file string, drop_run string, drop_status string, drop_records bigint, drop_kind string"
    return T.StructType(layout.table_schema.fields + T.StructType.fromDDL(extra).fields)


def _read_kind(spark: SparkSession, root: str, layout: Layout, kind: str, slot, run) -> DataFrame:
    reader = spark.read.schema(_parsed_schema(layout))
    if slot:
        # Only this folder is listed, however many runs the table holds.
        date, hour = slot
        table = reader.option("basePath", root).parquet(f"{root}/drop_kind={kind}/date={date}/hour={hour}")
    else:
        table = reader.parquet(root).filter(F.col("drop_kind") == kind)
    return table if run is None else table.filter(F.col("drop_run") == run)


def read_records(
    spark: SparkSession,
    root: str,
    layout: Layout,
    slot: tuple[str, str] | None = None,
    run: str | None = None,
    lineage: bool = False,
) -> DataFrame:
    """The parsed table: fields, run date and hour; with ``lineage`` also the file and run of each row.

    ``slot`` is the date and hour of one run, and must have been written.
    """
    extra = ["drop_file", "drop_run"] if lineage else []
    return _read_kind(spark, root, layout, "record", slot, run).select(*layout.names, "date", "hour", *extra)


def read_outcomes(
    spark: SparkSession,
    root: str,
    layout: Layout,
    slot: tuple[str, str] | None = None,
    run: str | None = None,
) -> DataFrame:
    """``path, status, n_records, date, hour, run``: what became of each file."""
    return _read_kind(spark, root, layout, "outcome", slot, run).select(
        F.col("drop_file").alias("path"),
        F.col("drop_status").alias("status"),
        F.col("drop_records").alias("n_records"),
        "date", "hour", F.col("drop_run").alias("run"),
    )


def reconcile(
    spark: SparkSession, root: str, layout: Layout, run: str | None = None, slot: tuple[str, str] | None = None
) -> DataFrame:
    """``run, path, status, n_records, n_written, matches`` per file: rows decoded against rows in the table.

    Only the file and run columns of the records are read, and they are counted before the shuffle. With ``slot`` only
    that date and hour are listed; it must hold records.
    """
    written = (
        read_records(spark, root, layout, slot, run=run, lineage=True)
        .groupBy(F.col("drop_run").alias("run"), F.col("drop_file").alias("path"))
        .agg(F.count(F.lit(1)).alias("n_written"))
    )
    outcomes = read_outcomes(spark, root, layout, slot, run=run).select("run", "path", "status", "n_records")
    n = F.coalesce("n_written", F.lit(0).cast("bigint"))
    joined = outcomes.join(written, ["run", "path"], "full")
    return joined.select(
        "run", "path", "status", "n_records", n.alias("n_written"), F.col("n_records").eqNullSafe(n).alias("matches")
    )


def append_audit(audit: DataFrame, root: str) -> None:
    """Append audit rows by zone and date.

    Rebalancing gives each zone few files and lets Spark split a zone that holds most rows.
    """
    columns = [f.name for f in T.StructType.fromDDL(AUDIT_SCHEMA)]
    with pending_apart(audit.sparkSession, root) as options:
        audit.select(*columns).hint("rebalance", "zone", "log_date").write.mode("append").options(**options).partitionBy(
            "zone", "log_date"
        ).parquet(root)


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return read_partitioned(spark, root, AUDIT_SCHEMA)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at; never part of a job."""
    return df.limit(n)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on from the written table, so later steps never repeat what made it."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
