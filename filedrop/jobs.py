"""Whole runs composed from the operators."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import nullcontext
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from filedrop import constants as C
from filedrop.functions.formats import run_slot, to_utc
from filedrop.functions.names import basename, is_valid_name
from filedrop.functions.records import slice_fields
from filedrop.operators import audit, claims
from filedrop.operators.gunzip import OUTCOME, decode_files, decode_listed
from filedrop.operators.naming import invalid_files
from filedrop.operators.pairing import check_shape, orphan_keys, pair_files
from filedrop.operators.summary import run_counts, slot_summary
from filedrop.operators.triage import apply_outcomes, triage_hourly, triage_targeted, valid_pairs
from filedrop.plans.apply import apply_plan
from filedrop.plans.moves import (
    archive_plan, archive_plan_hive, copy_plan, error_plan, merge_plans, quarantine_plan, quarantine_plan_flat,
    unique_destinations, with_versions,
)
from filedrop.session import exists, prepare, qualify
from filedrop.sinks.tables import (
    append_audit, append_parsed, contents_apart, materialise, read_outcomes, reconcile,
)
from filedrop.sources.layout import Layout
from filedrop.sources.manifest import DEPTH, below, list_prefix, read_manifest, recent_files, with_prefix_and_suffix


@dataclass(frozen=True)
class Zones:
    """Folders of one installation. ``work`` holds the tables a run writes for itself."""

    raw: str
    table: str
    archive: str
    quarantine: str
    audit: str
    work: str

    def qualified(self, spark: SparkSession) -> Zones:
        """Every folder with the meaning that Spark gives it."""
        return Zones(*(qualify(spark, folder) + "/" * folder.endswith("/") for folder in astuple(self)))

    @classmethod
    def under(cls, root: str, work: str) -> Zones:
        """The usual folders below one root."""
        at = root.rstrip("/") + "/"
        return cls(at + C.RAW_ROOT, at + C.TABLE_ROOT.rstrip("/"), at + C.ARCHIVE_ROOT, at + C.QUARANTINE_ROOT,
                   at + C.LOG_ROOT.rstrip("/"), work)


def _decode(files: DataFrame, on_error: str, columns: tuple[str, ...]) -> DataFrame:
    listed = "content" not in files.columns and "length" in files.columns
    return (decode_listed if listed else decode_files)(files, on_error=on_error, columns=columns)


def parse_batch(
    files: DataFrame, layout: Layout, as_of: dt.datetime, mode: str = "chars", on_error: str = "skip"
) -> DataFrame:
    """All records of all files as text fields plus run date and hour: one decoding pass, no shuffle of records.

    ``files`` is a binary scan, or a listing with ``path`` and ``length`` whose sizes are added up first.
    """
    date, hour = run_slot(as_of)
    fields = slice_fields(_decode(files, on_error, ("rec",)), layout, mode=mode)
    return fields.select("*", F.lit(date).alias("date"), F.lit(hour).alias("hour"))


def parse_and_append(
    files: DataFrame,
    layout: Layout,
    as_of: dt.datetime,
    table: str,
    run: str,
    mode: str = "chars",
    on_error: str = "skip",
) -> dict[str, int]:
    """Parse all files and append their records and outcomes in one job; returns ``rows, files, files_ok``.

    Rows are counted as they come out of Python, where a break in the generated code costs nothing extra. Counting the
    sliced rows instead made the job half as slow again. Slicing keeps every row, so the counts are those written.
    """
    date, hour = run_slot(as_of)
    keep = ("drop_kind", "drop_file", "drop_status", "drop_records")
    seen = Observation()
    decoded = _decode(files, on_error, (*keep, "rec")).observe(
        seen,
        F.count(F.lit(1)).alias("all"),
        F.count("drop_status").alias("files"),
        F.count_if(F.col("drop_records") > 0).alias("files_ok"),
    )
    tagged = slice_fields(decoded, layout, mode=mode, keep=keep)
    tagged = tagged.select(
        "*", F.lit(run).alias("drop_run"), F.lit(date).alias("date"), F.lit(hour).alias("hour")
    )
    with contents_apart(files.sparkSession) if "content" in files.columns else nullcontext():
        append_parsed(tagged, table)
    counts = seen.get
    return {"rows": counts["all"] - counts["files"], "files": counts["files"], "files_ok": counts["files_ok"]}


def _slots(as_of: dt.datetime, back: dt.timedelta) -> list[tuple[str, str]]:
    """Run date and hour of ``as_of`` and of the hours before it, as far as ``back`` reaches."""
    hours = int(back.total_seconds() // 3600) + 1
    return [run_slot(as_of - dt.timedelta(hours=h)) for h in range(hours + 1)]


def _in_table(spark: SparkSession, zones: Zones, layout: Layout, as_of: dt.datetime, back: dt.timedelta) -> DataFrame:
    """``path, status, n_records, length, modificationTime``: files whose records recent runs put into the table.

    Outcomes are committed with the records, so this holds even if a run ended before it moved its files. Which version
    of a file a run read is in the triage that the run wrote first. Only the folders of these hours and the triages of
    the runs in them are listed.
    """
    found = []
    for date, hour in _slots(as_of, back):
        if exists(spark, f"{zones.table}/drop_kind=outcome/date={date}/hour={hour}"):
            outcomes = read_outcomes(spark, zones.table, layout, (date, hour))
            found.append(outcomes.filter(F.col("status").isin("ok", "raw")))
    schema = "path string, status string, n_records bigint, length bigint, modificationTime timestamp"
    if not found:
        return spark.createDataFrame([], schema)
    outcomes = audit.union_audit(found)
    runs = [r["run"] for r in outcomes.select("run").distinct().collect()]
    triages = []
    for run in runs:
        triage = f"{zones.work.rstrip('/')}/run-{run}/triage"
        if exists(spark, triage):  # else written by parse_and_append alone, without a run
            read = spark.read.parquet(triage)
            triages.append(read.select(F.lit(run).alias("run"), F.col("gz_key").alias("path"),
                                       F.col("gz_length").alias("length"), F.col("gz_time").alias("modificationTime")))
    if not triages:
        return spark.createDataFrame([], schema)
    known = outcomes.join(audit.union_audit(triages), ["run", "path"])
    return known.select("path", "status", "n_records", "length", "modificationTime").dropDuplicates(
        ["path", "length", "modificationTime"])


def _triage(manifest: DataFrame, as_of: dt.datetime, grace: dt.timedelta | None) -> DataFrame:
    """Hourly triage of recent files with ``gz_time``; names that fail the check are not ``valid``, young files wait."""
    window = dt.timedelta(hours=1) + (grace or dt.timedelta())
    recent = recent_files(manifest, as_of, window)
    times = recent.select("path", "modificationTime")
    triaged = triage_hourly(pair_files(recent, replace_all=True))
    key = F.coalesce("gz_key", "end_key")
    present = times.select(F.col("path").alias("_key"), F.col("modificationTime").alias("_time"))
    timed = triaged.join(present.dropDuplicates(["_key"]), key == F.col("_key"), "left").drop("_key")
    status = F.when((F.col("status") == "valid") & ~is_valid_name(basename("gz_key")), F.lit("invalid_name"))
    if grace:
        young = F.col("_time") > F.lit(to_utc(as_of) - grace)
        status = status.when(F.col("status").isin("missing_end", "missing_gz") & young, F.lit("waiting"))
    return timed.withColumn("status", status.otherwise(F.col("status"))).withColumn(
        "gz_time", F.when(F.col("gz_key").isNotNull(), F.col("_time"))).drop("_time")


def _claim_key() -> Column:
    """What a claim is made for: the version of the data file, or the path of a lone marker."""
    return claims.key_of(
        F.coalesce("gz_key", "end_key").alias("path"), F.col("gz_length"), F.unix_micros("gz_time").alias("time"))


def _claimed(triaged: DataFrame, mine: DataFrame) -> DataFrame:
    """The triage, with the status ``claimed`` where another run has the claim."""
    joined = triaged.withColumn("key", _claim_key()).join(mine, "key")
    return joined.withColumn("status", F.when(F.col("claimed"), F.col("status")).otherwise("claimed")).select(*triaged.columns)


def _give_back(spark: SparkSession, work: str, claimed_at: str, run: str) -> None:
    """Release the claims of what this run did not move away; if it never came to moving, all."""
    keys = spark.read.parquet(f"{work}/triage").withColumn("key", _claim_key())
    if exists(spark, f"{work}/moves/_SUCCESS"):
        moved = spark.read.parquet(f"{work}/moves").filter("status = 'done'").select(F.col("source").alias("path"))
        keys = keys.withColumn("path", F.coalesce("gz_key", "end_key")).join(moved, "path", "left_anti")
    claims.release(keys, claimed_at, run)


def _superseded(manifest: DataFrame, triaged: DataFrame, as_of: dt.datetime, grace: dt.timedelta | None) -> DataFrame:
    """``file_key`` of recent files that lost to another copy of their name."""
    window = dt.timedelta(hours=1) + (grace or dt.timedelta())
    taken = triaged.select(F.explode(F.array("gz_key", "end_key")).alias("path")).filter("path is not null")
    return recent_files(manifest, as_of, window).select("path").join(taken, "path", "left_anti").withColumnRenamed(
        "path", "file_key")


def hourly_run(
    spark: SparkSession,
    zones: Zones,
    layout: Layout,
    as_of: dt.datetime,
    mode: str = "chars",
    archive_failed: bool = False,
    depth: int = DEPTH,
    manifest: DataFrame | None = None,
    grace: dt.timedelta | None = None,
    lease: dt.timedelta | None = None,
) -> DataFrame:
    """List, check names, pair, triage, parse, archive or quarantine, check the table, audit.

    Returns ``stage, status, n``. The listing, the triage and the moves are each written once to ``zones.work``
    and read from there, so files that move meanwhile cannot change an earlier decision. Files are archived when
    their records are in the table; ``archive_failed`` archives the others too instead of quarantining them.

    ``manifest`` replaces the listing, for instance by a store's inventory. With ``grace`` a file without partner that is
    younger stays where it is and waits for the next run, whose window reaches back as much further; without it the pair is
    judged at the hour's end. Every listed file gets one route. A file whose records an earlier run of these hours has put
    into the table is not parsed again, only moved, so a run may be repeated after any failure. The audit is written even
    when the run fails; misnamed files are quarantined even when nothing is recent.

    Runs may overlap in time if all of them are given a ``lease``, longer than any run takes: each data file version, with its
    marker, then belongs to the run that claimed it first, and has the status ``claimed`` in the others, which leave it alone.
    Claims of files that stay in the raw zone are given back when the run ends; those of a run that died end with the lease.
    """
    prepare(spark)
    zones = zones.qualified(spark)
    started = time.monotonic()
    run = uuid.uuid4().hex
    work = f"{zones.work.rstrip('/')}/run-{run}"
    slot = run_slot(as_of)
    claimed_at = f"{zones.work.rstrip('/')}/claims"
    logs: list[DataFrame] = []
    events = [("DEBUG", f"run {run}: {len(layout)} fields into {zones.table}/date={slot[0]}/hour={slot[1]}")]
    try:
        listed = read_manifest(spark, zones.raw, depth) if manifest is None else manifest
        listed = materialise(listed, f"{work}/manifest")
        invalid = invalid_files(listed)
        triaged = materialise(_triage(listed, as_of, grace), f"{work}/triage")
        if lease:
            mine = claims.claim(triaged.select(_claim_key().alias("key")), claimed_at, run, lease)
            triaged = _claimed(triaged, materialise(mine, f"{work}/claims"))
            triaged = materialise(triaged, f"{work}/triage-claimed")
        superseded = materialise(_superseded(listed, triaged, as_of, grace), f"{work}/superseded")
        valid = valid_pairs(triaged)
        logs += [audit.audit_invalid(invalid, as_of), audit.audit_triage(triaged, as_of),
                 audit.audit_superseded(superseded, as_of)]
        found = run_counts(listed, replace_all=True).first().asDict()
        events.append(("INFO", ", ".join(f"{k} {v}" for k, v in found.items())))

        chosen = triaged.filter(F.col("status") == "valid").select(
            F.col("gz_key").alias("path"), F.col("gz_length").alias("length"), F.col("gz_time").alias("modificationTime")
        )
        before = _in_table(spark, zones, layout, as_of, dt.timedelta(hours=1) + (grace or dt.timedelta()))
        version = ["path", "length", "modificationTime"]
        before = materialise(before.join(chosen, version, "left_semi"), f"{work}/parsed-before")
        to_read = materialise(chosen.join(before, version, "left_anti").select("path", "length"), f"{work}/to-read")
        counts = {"rows": 0, "files": 0, "files_ok": 0}
        if to_read.isEmpty():
            events.append(("WARNING", "no complete recent pair to parse"))
        else:
            counts = parse_and_append(to_read, layout, as_of, zones.table, run, mode)
            events.append(
                ("INFO", f"parsed {counts['rows']} records of {counts['files']} files, {counts['files_ok']} good"))

        # The first run may have had nothing to parse; then there is no table to read.
        if counts["files"]:
            outcomes = read_outcomes(spark, zones.table, layout, slot, run).select("path", "status", "n_records")
        else:
            outcomes = spark.createDataFrame([], "path string, status string, n_records bigint")
        logs.append(audit.audit_outcomes(outcomes, as_of))
        if counts["rows"]:
            lost = reconcile(spark, zones.table, layout, run, slot).filter("not matches").count()
            events.append(("CRITICAL", f"{lost} files whose rows in the table differ from those decoded") if lost
                          else ("DEBUG", "all decoded rows are in the table"))

        decoded = outcomes.select("path", "status").unionByName(before.select("path", "status"))
        with_outcome = check_shape(valid).join(
            decoded.select(F.col("path").alias("gz_key"), F.col("status").alias("decoded")), "gz_key", "left"
        )
        good = F.col("decoded").isin("ok", "raw")
        if archive_failed:
            plans = [archive_plan(with_outcome, zones.archive)]
        else:
            failed = with_outcome.filter(F.col("decoded").isin("empty", "corrupt"))
            plans = [archive_plan(with_outcome.filter(good), zones.archive), error_plan(failed, zones.quarantine)]
        lone = triaged.filter(~F.col("status").isin("waiting", "claimed"))
        stay = superseded.select(F.col("file_key").alias("source"), F.lit(None).cast("string").alias("destination"),
                                 F.lit("none").alias("action"), F.lit("superseded").alias("reason"))
        plans += [quarantine_plan(orphan_keys(lone), zones.quarantine, "orphan"),
                  quarantine_plan(invalid, zones.quarantine, "invalid_name"), stay]
        plan = with_versions(unique_destinations(merge_plans(*plans)), listed)
        moves = apply_plan(materialise(plan, f"{work}/plan"), f"{work}/moves")
        logs += [audit.audit_shape(with_outcome, as_of), audit.audit_moves(moves.filter("status != 'skipped'"), as_of)]
    except Exception as e:
        events.append(("CRITICAL", f"run failed: {type(e).__name__}: {str(e)[:500]}"))
        raise
    finally:
        if lease and exists(spark, f"{work}/triage/_SUCCESS"):
            _give_back(spark, work, claimed_at, run)
        events.append(("INFO", f"run time {_elapsed(time.monotonic() - started)}"))
        append_audit(audit.union_audit([*logs, audit.audit_run(spark, as_of, events)]), zones.audit)

    def tally(df: DataFrame, stage: str) -> DataFrame:
        return df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "status", "n")

    return audit.union_audit([
        tally(invalid.select(F.lit("invalid").alias("status")), "names"),
        tally(triaged, "triage"),
        tally(outcomes, "parse"),
        tally(moves, "move"),
        spark.createDataFrame([("records", "written", counts["rows"])], "stage string, status string, n bigint"),
    ])


def _elapsed(seconds: float) -> str:
    """``HH:MM:SS``, wrapping after a day like the column expression of the same meaning."""
    whole = int(seconds) % 86_400
    return f"{whole // 3600:02}:{whole // 60 % 60:02}:{whole % 60:02}"


def targeted_run(
    spark: SparkSession,
    zones: Zones,
    date: str,
    hour: str,
    prefix: str = "",
    depth: int = DEPTH,
    manifest: DataFrame | None = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Process one date and hour, quarantine everything else, and return the daily and hourly summary.

    ``prefix`` narrows the listing, for instance to a month folder: relative to the raw zone, or absolute in any spelling;
    one outside of it is an error. ``manifest`` replaces the listing. Files that are no gzip count as they are. The audit,
    dated ``as_of`` (now by default), is written even when the run fails.
    """
    prepare(spark)
    zones = zones.qualified(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    work = f"{zones.work.rstrip('/')}/run-{uuid.uuid4().hex}"
    logs: list[DataFrame] = []
    events = [("DEBUG", f"slot {date} {hour}, prefix '{prefix}'")]
    try:
        if manifest is None:
            listed = list_prefix(spark, zones.raw, prefix, depth)
        else:
            listed = with_prefix_and_suffix(manifest, below(zones.raw, prefix) if prefix else "")
        listed = materialise(listed, f"{work}/manifest")
        triaged = materialise(triage_targeted(pair_files(listed), date, hour), f"{work}/triage")
        chosen = triaged.filter(F.col("status") == "processed").select(
            F.col("gz_key").alias("path"), F.col("gz_length").alias("length")
        )
        decoded = decode_listed(chosen, on_error="raw", columns=OUTCOME).toDF("path", "status", "n_records")
        outcomes = materialise(decoded, f"{work}/outcomes")
        final = materialise(apply_outcomes(triaged, outcomes), f"{work}/final")
        logs += [audit.audit_targeted(final, as_of), audit.audit_outcomes(outcomes, as_of)]
        plan = merge_plans(archive_plan_hive(final, zones.archive), quarantine_plan_flat(final, zones.quarantine))
        plan = with_versions(unique_destinations(plan), listed)
        moves = apply_plan(materialise(plan, f"{work}/plan"), f"{work}/moves")
        logs.append(audit.audit_moves(moves.filter("status != 'skipped'"), as_of))
        summary = materialise(slot_summary(final), f"{work}/summary")
        logs.append(audit.audit_summary(summary, as_of))
    except Exception as e:
        events.append(("CRITICAL", f"run failed: {type(e).__name__}: {str(e)[:500]}"))
        raise
    finally:
        append_audit(audit.union_audit([*logs, audit.audit_run(spark, as_of, events)]), zones.audit)
    return summary


def copy_files(
    spark: SparkSession, source: str, target: str, outcome_path: str, depth: int = DEPTH,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Copy all files below one folder into another; sources stay. Files of one name get distinct names at the target."""
    source, target = qualify(spark, source), qualify(spark, target)
    listed = read_manifest(spark, source, depth) if manifest is None else manifest
    # Written first: a live folder must not be listed twice with different results.
    listed = materialise(listed, f"{outcome_path}-listing")
    plan = with_versions(unique_destinations(copy_plan(listed, "", target)), listed)
    return apply_plan(materialise(plan, f"{outcome_path}-plan"), outcome_path)
