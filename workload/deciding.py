"""Triage, summaries and move plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from filedrop import jobs
from filedrop.functions import formats
from filedrop.functions.names import with_position_parts
from filedrop.operators import gunzip, pairing, summary, triage
from filedrop.plans import moves
from filedrop.plans.apply import apply_plan as carry_out
from filedrop.session import new_scratch
from filedrop.sinks.tables import materialise
from filedrop.sources.binary import scan_binary
from filedrop.sources.manifest import read_manifest
from workload import fixtures as fx
from workload.listing import NAME, ORPHANS, PAIRS, POSITIONAL, READ, READABLE, WITH
from workload.registry import query

HOURLY = f"""{PAIRS},
hourly as (
  select base, gz_key, end_key, gz_length,
    case when status = 'valid' then substring({READ.format('gz_key')}, 9, 8) end as transaction_date,
    case when status = 'valid' then substring({READ.format('gz_key')}, 17, 2) end as transaction_hour,
    status
  from (
    select *, case when gz_key is null then 'missing_gz' when end_key is null then 'missing_end'
      when not {READABLE.format('gz_key')} then 'unparseable' else 'valid' end as status
    from pairs))"""

TARGETED = f"""{PAIRS},
cut as (
  select *, substring(base_filename, 9, 8) as d, substring(base_filename, 17, 2) as h
  from (select *, {POSITIONAL} as base_filename from (select *, coalesce(gz_key, end_key) as path from pairs))),
targeted as (
  select base, gz_key, end_key, gz_length,
    case when d <> '' and h <> '' then d else 'Unknown' end as date_key,
    case when d <> '' and h <> '' then h else 'Unknown' end as hour_key,
    case when end_key is null then 'missing_end' when gz_key is null then 'missing_gz'
      when d = '' or h = '' then 'unparseable' when gz_length = 0 then 'zero_size'
      when gz_length is null then 'size_unavailable'
      when d <> '{fx.TARGET_DATE}' or h <> '{fx.TARGET_HOUR}' then 'wrong_slot' else 'processed' end as status
  from cut)"""

COUNTERS = """
  count(*) filter (status not in ('missing_end', 'missing_gz', 'unparseable')) as total,
  count(*) filter (status = 'processed') as processed,
  count(*) filter (status <> 'processed') as unprocessed,
  cast(coalesce(sum(gz_length) filter (status = 'processed'), 0) as bigint) as processed_size
"""


def _pairs(spark, sf):
    return pairing.pair_files(fx.manifest(spark, sf))


def _hourly(spark, sf):
    return triage.triage_hourly(_pairs(spark, sf))


def _targeted(spark, sf):
    return triage.triage_targeted(_pairs(spark, sf), fx.TARGET_DATE, fx.TARGET_HOUR)


@query("triage_hourly", f"{HOURLY} select * from hourly")
def triage_hourly(spark, sf):
    """Valid, unreadable and lone files."""
    return _hourly(spark, sf)


@query("triage_targeted", f"{TARGETED} select * from targeted")
def triage_targeted(spark, sf):
    """Status of every pair against one slot."""
    return _targeted(spark, sf)


@query("target_slot", f"""{TARGETED}
select base, d = '{fx.TARGET_DATE}' and h = '{fx.TARGET_HOUR}' as in_slot from cut""")
def target_slot(spark, sf):
    """Does the name belong to the target date and hour."""
    keys = _pairs(spark, sf).select("base", F.coalesce("gz_key", "end_key").alias("path"))
    return with_position_parts(keys).select("base", triage.in_slot(fx.TARGET_DATE, fx.TARGET_HOUR).alias("in_slot"))


@query("daily_summary", f"{TARGETED} select date_key as date, {COUNTERS} from targeted group by 1")
def daily_summary(spark, sf):
    """Counts and processed bytes per day."""
    return summary.daily_summary(_targeted(spark, sf))


@query("hourly_summary", f"{TARGETED} select hour_key as hour, {COUNTERS} from targeted group by 1")
def hourly_summary(spark, sf):
    """Counts and processed bytes per hour of day."""
    return summary.hourly_summary(_targeted(spark, sf))


def _size_sql(n: str) -> str:
    units = [("Bytes", 1), ("KB", 1024), ("MB", 1024**2), ("GB", 1024**3), ("TB", 1024**4)]
    rungs = " ".join(f"when {n} < {k * 1024} then printf('%.2f {u}', {n} / {k}::double)" for u, k in units)
    return f"case {rungs} else printf('%.2f PB', {n} / {1024**5}::double) end"


@query("slot_summary", f"""{TARGETED}, both_ways as (
  select 'date' as grouping, date_key as value, {COUNTERS} from targeted group by 2
  union all select 'hour', hour_key, {COUNTERS} from targeted group by 2)
select * exclude (processed_size), {_size_sql('processed_size')} as size from both_ways""")
def slot_summary(spark, sf):
    """Both summaries from one pass, sizes as text."""
    both = summary.slot_summary(_targeted(spark, sf))
    return both.select(
        "grouping", "value", "total", "processed", "unprocessed", formats.format_size("processed_size").alias("size")
    )


@query("format_size", f"""
select l_orderkey, l_linenumber, n as size, {_size_sql('n')} as size_text from (
  select l_orderkey, l_linenumber, cast(round(l_extendedprice * 100) as bigint) * l_orderkey as n from lineitem
  union all select l_orderkey, l_linenumber, l_partkey * l_linenumber from lineitem)""")
def format_size(spark, sf):
    """Readable sizes from bytes up to the largest unit the data reach."""
    items = fx.table(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    large = items.select("l_orderkey", "l_linenumber", (cents * F.col("l_orderkey")).alias("size"))
    small = items.select("l_orderkey", "l_linenumber", (F.col("l_partkey") * F.col("l_linenumber")).alias("size"))
    return large.unionByName(small).select("*", formats.format_size("size").alias("size_text"))


@query("elapsed_fmt", """
select l_orderkey, l_linenumber,
  printf('%02d:%02d:%02d', (s // 3600) % 24, (s // 60) % 60, s % 60) as elapsed
from (select *, l_orderkey * 7 + l_partkey as s from lineitem)""")
def elapsed_fmt(spark, sf):
    """Seconds as HH:MM:SS, beginning again after a day."""
    seconds = F.col("l_orderkey") * 7 + F.col("l_partkey")
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", formats.format_elapsed(seconds).alias("elapsed")
    )


@query("run_partition", """
select event_id, strftime(ts, '%Y%m%d') as date, strftime(ts, '%H') as hour,
  'TDZ/date=' || strftime(ts, '%Y%m%d') || '/hour=' || strftime(ts, '%H') || '/' as location
from events""")
def run_partition(spark, sf):
    """Run date, hour and output folder of every event time."""
    slots = fx.table(spark, sf, "events").select(
        "event_id", *[c.alias(n) for n, c in formats.slot_columns("ts").items()]
    )
    return slots.select("*", formats.output_location("TDZ/", "date", "hour").alias("location"))


# --- plans ------------------------------------------------------------------------------------------------------

def _file_name(column: str) -> str:
    return f"regexp_extract({column}, '[^/]*$')"


def _quarantine_sql(reason: str) -> str:
    d, h = f"substring({READ.format('file_key')}, 9, 8)", f"substring({READ.format('file_key')}, 17, 2)"
    ok = READABLE.format("file_key")
    return f"""select file_key as source,
      case when {ok} then 'RDZ/error-files/' || left({d}, 4) || '/' || {d} || '/' || {h} || '/'
        || {_file_name('file_key')} end as destination,
      case when {ok} then 'move' else 'none' end as action,
      case when {ok} then '{reason}' else 'unparseable' end as reason"""


@query("quarantine_plan", f"{ORPHANS} {_quarantine_sql('quarantine')} from lone")
def quarantine_plan(spark, sf):
    """Dated quarantine of lone files."""
    return moves.quarantine_plan(pairing.orphan_keys(_pairs(spark, sf)))


@query("error_plan", f"""{PAIRS} {_quarantine_sql('error')} from (
  select gz_key as file_key from pairs where gz_key is not null
  union all select end_key from pairs where end_key is not null)""")
def error_plan(spark, sf):
    """Dated quarantine of both files of every pair."""
    return moves.error_plan(_pairs(spark, sf))


@query("quarantine_plan_flat", f"""{TARGETED}
select file_key as source, 'RDZ/error-files/' || {_file_name('file_key')} as destination, 'move' as action,
  status as reason
from (select gz_key as file_key, status from targeted union all select end_key, status from targeted)
where file_key is not null and status <> 'processed'""")
def quarantine_plan_flat(spark, sf):
    """Flat quarantine of whatever was not processed."""
    return moves.quarantine_plan_flat(_targeted(spark, sf))


@query("archive_plan", f"""{HOURLY}
select file_key as source, 'RDZ/backup/' || left(d, 4) || '/' || d || '/' || h || '/' || {_file_name('file_key')}
  as destination, 'move' as action, 'archive' as reason
from (select gz_key as file_key, transaction_date as d, transaction_hour as h from hourly where status = 'valid'
  union all select end_key, transaction_date, transaction_hour from hourly where status = 'valid')""")
def archive_plan(spark, sf):
    """Dated archive of valid pairs."""
    return moves.archive_plan(triage.valid_pairs(_hourly(spark, sf)))


@query("archive_plan_hive", f"""{TARGETED}
select file_key as source, 'RDZ/backup/year=' || substring(d, 1, 4) || '/month=' || substring(d, 5, 2) || '/day='
  || substring(d, 7, 2) || '/hour=' || h || '/' || {_file_name('file_key')} as destination,
  'move' as action, 'archive' as reason
from (select gz_key as file_key, date_key as d, hour_key as h from targeted where status = 'processed'
  union all select end_key, date_key, hour_key from targeted where status = 'processed')""")
def archive_plan_hive(spark, sf):
    """Archive in year, month, day and hour folders."""
    return moves.archive_plan_hive(_targeted(spark, sf))


@query("copy_plan", f"""{WITH}
select path as source, 'RDZ/Raw-Data/' || {NAME} as destination, 'copy' as action,
  case when count(*) over (partition by {NAME}) > 1 then 'duplicate' else 'copy' end as reason
from manifest where path like 'raw/%'""")
def copy_plan(spark, sf):
    """Copy of a whole prefix, shared destinations marked."""
    return moves.copy_plan(fx.manifest(spark, sf), "raw/", "RDZ/Raw-Data")


@query("apply_plan", f"""with {fx.DROPS_SQL}
select name, case when base like 'R520%' then 'move' else 'none' end as action,
  case when base like 'R520%' then 'done' else 'skipped' end as status,
  case when base like 'R520%' then substring(base, 9, 4) || '/' || substring(base, 9, 8) || '/'
    || substring(base, 17, 2) || '/' || name end as destination,
  case when base like 'R520%' and name like '%.gz' then case when content = 'ok' then n else 0 end end as n_records
from (select *, base || '.gz' as name from drops where has_gz
  union all select *, base || '_END' from drops where has_end)""")
def apply_plan(spark, sf):
    """Quarantine every file of a real folder; what lies at the target is decoded again."""
    folder = fx.drop_folder(spark, sf, fresh=True)
    out = new_scratch(spark, "apply")
    listed = materialise(read_manifest(spark, folder), f"{out}/listed")
    plan = moves.with_versions(moves.error_plan(pairing.pair_files(listed), f"{out}/error-files/"), listed)
    moved = carry_out(materialise(plan, f"{out}/plan"), f"{out}/moves")
    there = gunzip.file_outcomes(scan_binary(spark, f"{out}/error-files")).select(
        moves.basename("path").alias("name"), "n_records")
    return moved.select(
        moves.basename("source").alias("name"), "action", "status",
        F.substring_index("destination", "/error-files/", -1).alias("destination"),
    ).join(there, "name", "left")


@query("copy_run", f"""with {fx.DROPS_SQL}
select name, 'copy' as action, 'done' as status, name as destination,
  case when name like '%.gz' then case when content = 'ok' then n else 0 end end as n_records
from (select *, base || '.gz' as name from drops where has_gz
  union all select *, base || '_END' from drops where has_end)""")
def copy_run(spark, sf):
    """Copy a real folder as a whole job, listing included; what lies at the target is listed and decoded again."""
    out = new_scratch(spark, "copy")
    copied = jobs.copy_files(spark, fx.drop_folder(spark, sf), f"{out}/target", f"{out}/copies")
    there = read_manifest(spark, f"{out}/target")
    records = gunzip.decode_listed(there.filter(F.col("path").endswith(".gz")), columns=gunzip.OUTCOME)
    found = there.select(moves.basename("path").alias("destination")).join(
        records.select(moves.basename("drop_file").alias("destination"), F.col("drop_records").alias("n_records")),
        "destination", "left")
    return copied.select(
        moves.basename("source").alias("name"), "action", "status", moves.basename("destination").alias("destination")
    ).join(found, "destination")
