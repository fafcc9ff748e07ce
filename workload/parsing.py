"""Records, tables, audit and whole runs."""

from __future__ import annotations

import dataclasses
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Window, functions as F

from filedrop import jobs
from filedrop.functions import names, records as rec
from filedrop.operators import audit, gunzip, pairing, triage
from filedrop.operators.naming import invalid_files
from filedrop.plans import moves
from filedrop.session import new_scratch
from filedrop.sinks import tables
from filedrop.sources import storage
from filedrop.sources.binary import scan_binary
from filedrop.sources.layout import load_layout
from filedrop.sources.manifest import read_manifest
from filedrop.streaming import pairing as streaming, settling
from workload import fixtures as fx
from workload.deciding import HOURLY
from workload.listing import DROPS, NAME, VALID, WITH
from workload.registry import query

RECORDS = f"with {fx.RECORDS_SQL}"
SLOT = "'20240115' as date, '13' as hour"

# Each text cut every 520 bytes.
CHUNKS = """with bytes as (select doc_id, source, encode(text) as b from documents),
cuts as (
  select doc_id, source, i as ord, b[i * 520 + 1 : least((i + 1) * 520, octet_length(b))] as rec
  from (select *, unnest(range(0, cast(ceil(octet_length(b) / 520) as bigint))) as i from bytes))"""
# Undecodable bytes of a cut are the tail of the character before it and the head of the one after it.
LOSSY = r"""decode(unhex(regexp_replace(regexp_replace(hex(rec), '^([89AB][0-9A-F])+', ''),
  '([CD][0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-9A-F]([89AB][0-9A-F]){0,2})$', '')))"""


@query("gunzip_records", f"{RECORDS} select md5(rec) as digest, 520 as n_bytes from records")
def gunzip_records(spark, sf):
    """All records of all gzip contents."""
    out = gunzip.gunzip_records(fx.record_files(spark, sf))
    return out.select(F.md5("rec").alias("digest"), F.octet_length("rec").alias("n_bytes"))


@query("gunzip_members", f"""{RECORDS}
select 'record' as kind, md5(rec) as digest, 520 as n_bytes, cast(null as varchar) as status from records""")
def gunzip_members(spark, sf):
    """All records of real gzip files of many members, which are found first and decoded by stretches.

    Files that do not come out whole are rows too.
    """
    listed = read_manifest(spark, fx.member_folder(spark, sf))
    out = gunzip.decode_listed(listed, index_bytes=0).filter("drop_kind = 'record' or drop_status <> 'ok'")
    return out.select(
        F.col("drop_kind").alias("kind"), F.md5("rec").alias("digest"), F.octet_length("rec").alias("n_bytes"),
        F.col("drop_status").alias("status"),
    )


@query("chunk_native", f"""{CHUNKS}
select doc_id, ord, octet_length(rec) as n_bytes, md5(rec) as digest from cuts""")
def chunk_native(spark, sf):
    """Whole texts cut every 520 bytes without Python."""
    cut = rec.cut_records(fx.texts(spark, sf), "content")
    n_bytes = F.octet_length("rec").cast("bigint").alias("n_bytes")
    return cut.select("doc_id", "ord", n_bytes, F.md5("rec").alias("digest"))


@query("decode_lossy", f"{CHUNKS} select doc_id, ord, {LOSSY} as text from cuts")
def decode_lossy(spark, sf):
    """Text of every cut with split characters dropped."""
    cut = rec.cut_records(fx.texts(spark, sf), "content")
    return cut.select("doc_id", "ord", rec.decode_lossy("rec").alias("text"))


@query("gunzip_fallback", f"""{CHUNKS}
select 'raw/doc' || doc_id || '.gz' as path, ord, octet_length(rec) as n_bytes, md5(rec) as digest
from cuts where source <> 'src1'""")
def gunzip_fallback(spark, sf):
    """Contents that are no gzip are taken as they are; truncated ones give nothing."""
    files = fx.text_files(spark, sf, {"src0": "plain", "src1": "truncated", "src2": "members"})
    out = gunzip.gunzip_records(files, on_error="raw")
    n_bytes = F.octet_length("rec").cast("bigint").alias("n_bytes")
    return out.select("path", "ord", n_bytes, F.md5("rec").alias("digest"))


DAMAGE = {"src0": "plain", "src1": "truncated", "src2": "garbage", "src3": "empty", "src4": "members"}


@query("file_outcomes", """
select 'raw/doc' || doc_id || '.gz' as path, status,
  case when status = 'ok' then cast(ceil(octet_length(encode(text)) / 520) as bigint) else 0 end as n_records
from (select *, case when source in ('src1', 'src2') then 'corrupt'
    when source = 'src3' or text = '' then 'empty' when source = 'src0' then 'corrupt' else 'ok' end as status
  from documents)""")
def file_outcomes(spark, sf):
    """One outcome per file: good, empty or corrupt."""
    return gunzip.file_outcomes(fx.text_files(spark, sf, DAMAGE))


@query("fixed_width", f"{RECORDS} select {fx.FIELDS_SQL} from records")
def fixed_width(spark, sf):
    """Fields cut out of records."""
    return rec.slice_fields(fx.records(spark, sf), fx.LAYOUT)


#: Fields that cover a record without gaps.
WHOLE_RECORD = fx.Layout([("a", 1, 40), ("b", 41, 60), ("c", 101, 200), ("d", 301, 200), ("e", 501, 20)])


@query("fixed_width_bytes", f"""{CHUNKS},
trimmed as (
  select doc_id, ord, rec[1:40] as a, rec[41:100] as b, rec[101:300] as c, rec[301:500] as d, rec[501:520] as e from cuts)
select doc_id, ord, {', '.join(LOSSY.replace('hex(rec)', f'hex({c})') + f' as {c}' for c in 'abcde')} from trimmed""")
def fixed_width_bytes(spark, sf):
    """Fields cut by bytes out of multibyte text."""
    layout = WHOLE_RECORD
    cut = rec.cut_records(fx.texts(spark, sf), "content")
    return rec.slice_fields(cut, layout, mode="bytes", keep=("doc_id", "ord"))


@query("fixed_width_chars", f"""{CHUNKS}
select doc_id, ord, substring(t, 1, 40) as a, substring(t, 41, 60) as b, substring(t, 101, 200) as c,
  substring(t, 301, 200) as d, substring(t, 501, 20) as e
from (select doc_id, ord, {LOSSY} as t from cuts)""")
def fixed_width_chars(spark, sf):
    """Fields cut by characters out of multibyte text."""
    layout = WHOLE_RECORD
    cut = rec.cut_records(fx.texts(spark, sf), "content")
    return rec.slice_fields(cut, layout, keep=("doc_id", "ord"))


@query("parse_batch", f"{RECORDS} select {fx.FIELDS_SQL}, {SLOT} from records")
def parse_batch(spark, sf):
    """Gzip contents to typed table rows in one pass."""
    return jobs.parse_batch(fx.record_files(spark, sf), fx.LAYOUT, fx.AS_OF)


@query("binary_scan", f"""with {fx.DROPS_SQL}
select base || '.gz' as name, case when content = 'ok' then n else 0 end as n_records from drops where has_gz""")
def binary_scan(spark, sf):
    """Real data files scanned and decoded; markers are not matched."""
    outcomes = gunzip.file_outcomes(scan_binary(spark, fx.drop_folder(spark, sf)))
    return outcomes.select(names.basename("path").alias("name"), "n_records")


FIELD_ROWS = "\nunion all ".join(
    f"select '{f.name}' as field, {f.start} as start, {f.length} as length, count(*) as records, "
    f"count(*) filter (trim(substring(rec, {f.start}, {f.length})) <> '') as filled, "
    f"cast(sum(length(trim(substring(rec, {f.start}, {f.length})))) as bigint) as characters from records"
    for f in fx.LAYOUT
)


@query("layout_load", f"{RECORDS} {FIELD_ROWS}")
def layout_load(spark, sf):
    """A layout sheet read back and applied to all records."""
    path = new_scratch(spark, "layout")
    rows = [(f.name, f.start, f.length) for f in fx.LAYOUT]
    sheet = spark.createDataFrame(rows, "Column string, Starting_Index int, Length int")
    sheet.coalesce(1).write.option("header", True).csv(path)
    layout = load_layout(spark, path)
    parsed = rec.trim_fields(rec.slice_fields(fx.records(spark, sf), layout), layout)
    per_field = [
        F.struct(
            F.lit(f.name).alias("field"), F.lit(f.start).alias("start"), F.lit(f.length).alias("length"),
            F.count(F.lit(1)).alias("records"), F.count_if(F.col(f.name) != "").alias("filled"),
            F.sum(F.length(f.name)).cast("bigint").alias("characters"),
        ).alias(f.name)
        for f in layout
    ]
    return parsed.agg(*per_field).select(F.inline(F.array(*layout.names)))


# --- tables -----------------------------------------------------------------------------------------------------

@query("partitioned_append", f"{RECORDS} select {fx.FIELDS_SQL}, {SLOT} from records")
def partitioned_append(spark, sf):
    """Parsed rows appended by run date and hour, then read back."""
    root = new_scratch(spark, "table")
    tables.append_partitioned(jobs.parse_batch(fx.record_files(spark, sf), fx.LAYOUT, fx.AS_OF), root)
    return tables.read_partitioned(spark, root, fx.LAYOUT.table_schema)


@query("row_count", "select count(*) as n_rows from lineitem")
def row_count(spark, sf):
    """Rows counted by the write itself."""
    parsed = jobs.parse_batch(fx.record_files(spark, sf), fx.LAYOUT, fx.AS_OF)
    n = tables.append_partitioned(parsed, new_scratch(spark, "table"))
    return spark.createDataFrame([(n,)], "n_rows bigint")


@query("reconcile_output", """
select 'raw/doc' || doc_id || '.gz' as path, status, n_records, n_records + moved as n_written, moved = 0 as matches
from (
  select *, case when n_records = 0 then 0 when doc_id % 10 = 3 then -1 when doc_id % 10 = 7 then 1 else 0 end as moved from (
  select *, case when status = 'ok' then cast(ceil(octet_length(encode(text)) / 520) as bigint) else 0 end as n_records
  from (select *, case when source in ('src1', 'src2') then 'corrupt'
      when source = 'src3' or text = '' then 'empty' when source = 'src0' then 'corrupt' else 'ok' end as status
    from documents)))""")
def reconcile_output(spark, sf):
    """Rows in the table against rows decoded, per file; some files have lost a row since, some have one twice."""
    root = new_scratch(spark, "table")
    files = fx.text_files(spark, sf, DAMAGE)
    jobs.parse_and_append(files, fx.LAYOUT, fx.AS_OF, root, run="r1")
    whole = spark.read.parquet(root)
    first = F.row_number().over(Window.partitionBy("drop_kind", "drop_file").orderBy(*fx.LAYOUT.names)) == 1
    digit = F.regexp_extract("drop_file", r"(\d)\.gz$", 1)
    times = F.when((F.col("drop_kind") == "record") & first & (digit == "3"), 0).when(
        (F.col("drop_kind") == "record") & first & (digit == "7"), 2).otherwise(1)
    changed = whole.withColumn("times", times).withColumn("once", F.explode(F.array_repeat(F.lit(1), F.col("times"))))
    tables.append_parsed(changed.drop("times", "once"), f"{root}-changed")
    return tables.reconcile(spark, f"{root}-changed", fx.LAYOUT).drop("run")


def _logs(spark, sf):
    manifest = fx.manifest(spark, sf)
    triaged = triage.triage_hourly(pairing.pair_files(manifest))
    return audit.audit_invalid(invalid_files(manifest), fx.AS_OF), audit.audit_triage(triaged, fx.AS_OF)


def _as_text(df):
    return df.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "level", "message", "zone", "log_date"
    )


STAMP = "'2024-01-15 13:00:00' as timestamp"
TRIAGE_LOG = f"""select {STAMP}, case when status = 'valid' then 'INFO' else 'ERROR' end as level,
  case status when 'valid' then 'pair accepted: ' when 'unparseable' then 'name cannot be read: '
    when 'missing_end' then 'end marker missing for: ' else 'data file missing for: ' end
  || coalesce(gz_key, end_key) as message, 'TDZ' as zone, '20240115' as log_date from hourly"""
ALL_LOGS = f"""{HOURLY} {TRIAGE_LOG}
union all select {STAMP}, 'ERROR', 'invalid file name: ' || file_key, 'RDZ', '20240115'
from (select path as file_key, {NAME} as filename from manifest) where not {VALID}"""


@query("audit_rows", f"{HOURLY} {TRIAGE_LOG}")
def audit_rows(spark, sf):
    """Log rows of a triage."""
    return _as_text(_logs(spark, sf)[1])


@query("audit_union", ALL_LOGS)
def audit_union(spark, sf):
    """Log rows of several steps together."""
    return _as_text(audit.union_audit(list(_logs(spark, sf))))


@query("audit_log", ALL_LOGS)
def audit_log(spark, sf):
    """Log rows appended by zone and date, then read back."""
    root = new_scratch(spark, "audit")
    tables.append_audit(audit.union_audit(list(_logs(spark, sf))), root)
    return _as_text(tables.read_audit(spark, root))


@query("empty_inputs", f"""{WITH}
select step, case when step = 'listed' then (select count(*) from manifest) else 0 end as n
from (select unnest(['listed', 'selected', 'invalid', 'pairs', 'valid', 'archived', 'parsed']) as step)""")
def empty_inputs(spark, sf):
    """An empty selection goes through every step and gives empty frames."""
    manifest = fx.manifest(spark, sf)
    nothing = manifest.filter(F.col("length") < 0)
    triaged = triage.triage_hourly(pairing.pair_files(nothing))
    valid = triage.valid_pairs(triaged)
    parsed = jobs.parse_batch(valid.select(F.col("gz_key").alias("path")), fx.LAYOUT, fx.AS_OF)
    steps = {
        "listed": manifest, "selected": nothing, "invalid": invalid_files(nothing), "pairs": triaged,
        "valid": valid, "archived": moves.archive_plan(valid), "parsed": parsed,
    }
    return audit.union_audit(
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n") for step, df in steps.items()]
    )


# --- whole runs -------------------------------------------------------------------------------------------------

def _zones(spark, sf):
    out = new_scratch(spark, "run")
    raw = fx.drop_folder(spark, sf, fresh=True)
    return jobs.Zones(raw, f"{out}/TDZ", f"{out}/backup/", f"{out}/error-files/", f"{out}/LOGS", f"{out}/work")


@query("hourly_run", f"""with {fx.DROPS_SQL},
files as (
  select *, base || '.gz' as key from drops where has_gz union all select *, base || '_END' from drops where has_end),
triaged as (
  select *, case when not has_gz then 'missing_gz' when not has_end then 'missing_end'
    when base like 'X%' then 'unparseable' else 'valid' end as status from drops where has_gz or has_end)
select 'names' as stage, 'invalid' as status, count(*) as n from files where base like 'X%' having count(*) > 0
union all select 'triage', status, count(*) from triaged group by status
union all select 'parse', content, count(*) from triaged where status = 'valid' group by content
union all select 'records', 'written', cast(coalesce(sum(n), 0) as bigint)
  from triaged where status = 'valid' and content = 'ok'
union all select 'move', case when base like 'X%' then 'skipped' else 'done' end, count(*) from files group by 2""")
def hourly_run(spark, sf):
    """The whole hourly run on real files."""
    as_of = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)
    zones = _zones(spark, sf)
    as_of = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)
    return jobs.hourly_run(spark, zones, fx.EVENT_LAYOUT, as_of)


EVENTS_IN_TABLE = """
select lpad(cast(event_id as varchar), 12, '0') as event, lpad(cast(user_id as varchar), 8, '0') as "user",
  strftime(ts, '%Y%m%d%H%M%S') as stamp, lpad(cast(cast(round(value * 100) as bigint) as varchar), 12, '0') as cents
from events
where not (event_type = 'purchase' and strftime(ts, '%H') = '07') and not (event_type = 'signup' and strftime(ts, '%H') = '03')
  and not (event_type = 'view' and strftime(ts, '%H') = '04')
  and not (event_type = 'error' and strftime(ts, '%H') in ('05', '06'))"""


@query("hourly_run_twice", EVENTS_IN_TABLE)
def hourly_run_twice(spark, sf):
    """The table after a run that could not archive anything, and its repetition."""
    zones = _zones(spark, sf)
    as_of = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)
    storage.write_bytes(f"{zones.work}/blocked", b"a file where a folder is needed")
    jobs.hourly_run(spark, dataclasses.replace(zones, archive=f"{zones.work}/blocked/"), fx.EVENT_LAYOUT, as_of)
    jobs.hourly_run(spark, zones, fx.EVENT_LAYOUT, as_of)
    return tables.read_records(spark, zones.table, fx.EVENT_LAYOUT).drop("date", "hour")


@query("hourly_run_overlapping", EVENTS_IN_TABLE)
def hourly_run_overlapping(spark, sf):
    """The table after three runs that worked on the same folder at the same time."""
    zones = _zones(spark, sf)
    as_of = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)

    def run(session):
        return jobs.hourly_run(session, zones, fx.EVENT_LAYOUT, as_of, lease=dt.timedelta(hours=6)).count()

    # A session has settings of its own, which a write changes while it lasts.
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(run, [spark.newSession() for _ in range(3)]))
    return tables.read_records(spark, zones.table, fx.EVENT_LAYOUT).drop("date", "hour")


@query("targeted_run", f"""with {fx.DROPS_SQL},
triaged as (
  select *, substring(base, 9, 8) as d, substring(base, 17, 2) as h,
    case when not has_gz then 'missing_gz' when not has_end then 'missing_end'
      when substring(base, 9, 10) <> '2024011505' then 'wrong_slot' when content = 'corrupt' then 'process_error'
      else 'processed' end as status from drops where has_gz or has_end)
select 'date' as grouping, d as value, count(*) filter (status not like 'missing%') as total,
  count(*) filter (status = 'processed') as processed, count(*) filter (status <> 'processed') as unprocessed
from triaged group by 2
union all select 'hour', h, count(*) filter (status not like 'missing%'),
  count(*) filter (status = 'processed'), count(*) filter (status <> 'processed')
from triaged group by 2""")
def targeted_run(spark, sf):
    """One date and hour processed on real files, the rest quarantined."""
    return jobs.targeted_run(spark, _zones(spark, sf), "20240115", "05").drop("processed_size")


@query("stream_pairing", f"""{DROPS},
sessions as (
  select base, max(path) filter (kind = 'gz') as gz_key, max(path) filter (kind = 'end') as end_key,
    arg_max(length, path) filter (kind = 'gz') as gz_length, min(modificationTime) as first,
    max(modificationTime) as last
  from files group by base)
select base, gz_key, end_key, gz_length, strftime(first, '%Y-%m-%d %H:%M:%S') as first_seen, case when gz_key is not null and end_key is not null then 'paired'
  when gz_key is not null then 'missing_end' else 'missing_gz' end as status
from sessions
where last + interval 20 minutes <= (select date_trunc('milliseconds', max(modificationTime)) from files)""")
def stream_pairing(spark, sf):
    """Pairs settled by a stream over the listing."""
    out = new_scratch(spark, "stream")
    listing = tables.materialise(fx.manifest(spark, sf), f"{out}/manifest")
    stream = spark.readStream.schema(listing.schema).parquet(f"{out}/manifest")
    pairs = streaming.pair_stream(stream, grace="10 minutes", delay="10 minutes")
    streaming.write_pairs(pairs, f"{out}/pairs", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(pairs.schema).parquet(f"{out}/pairs").select(
        "base", "gz_key", "end_key", "gz_length",
        F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"), "status",
    )


#: Data files and markers of events, their times, and the run of three in which they arrive: by time, some a run late.
ARRIVALS = """
with named as (
  select 'raw/R' || lpad(cast(event_id as varchar), 12, '0') as base, epoch_us(ts) // 1000 as ms, event_id from events
), span as (
  select min(ms) as first, (max(ms) - min(ms)) // 3 + 1 as third from named
), files as (
  select base, base || '.gz' as path, ms, event_id % 7 = 0 as slow from named where event_id % 11 <> 0
  union all
  select base, base || '_END', ms + 60000 * (event_id % 17), event_id % 7 = 3 from named where event_id % 5 <> 0
), dealt as (
  select base, path, ms, least(3, 1 + (ms - first) // third + case when slow then 1 else 0 end) as run from files, span
)"""


@query("stream_settling", f"""{ARRIVALS}, clocks as (
  select run, max(max(ms)) over (order by run) as clock from dealt group by run
), alone as (
  select d.*, coalesce((select clock from clocks c where c.run = d.run - 1) > ms + 600000, false) as late,
    (select min(run) from clocks c where c.run >= d.run and clock > ms + 600000) as given_up
  from dealt d
), judged as (
  select f.path, f.ms, f.late, f.given_up, p.path as partner,
    p.path is not null and case when f.run = p.run then true
      when f.run < p.run then not f.late and coalesce(f.given_up >= p.run, true)
      else not p.late and coalesce(p.given_up >= f.run, true) end as meets
  from alone f left join alone p on f.base = p.base and f.path <> p.path
)
select path, ms, case when meets then 'paired' when late then 'late' when given_up is null then 'waiting'
  when path like '%.gz' then 'missing_end' else 'missing_gz' end as status, case when meets then partner end as partner
from judged""")
def stream_settling(spark, sf):
    """Every listed file in one status after three runs of the stateful stream."""
    out = new_scratch(spark, "settling")
    ms, id_ = F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id")
    named = fx.table(spark, sf, "events").select(
        F.concat(F.lit("raw/R"), F.lpad(id_.cast("string"), 12, "0")).alias("base"), ms.alias("ms"), "event_id"
    )
    first, last = named.agg(F.min("ms"), F.max("ms")).first()
    third = (last - first) // 3 + 1
    gz = named.filter(id_ % 11 != 0).select(F.concat("base", F.lit(".gz")).alias("path"), "ms", (id_ % 7 == 0).alias("slow"))
    end = named.filter(id_ % 5 != 0).select(
        F.concat("base", F.lit("_END")).alias("path"), (F.col("ms") + 60000 * (id_ % 17)).alias("ms"), (id_ % 7 == 3).alias("slow")
    )
    run = F.least(F.lit(3), F.lit(1) + F.floor((F.col("ms") - first) / third) + F.col("slow").cast("int"))
    files = gz.unionByName(end).select(
        "path", F.timestamp_millis("ms").alias("modificationTime"), F.lit(1).cast("bigint").alias("length"), run.alias("run")
    )
    files = tables.materialise(files, f"{out}/dealt")
    listed = files.drop("run")
    for k in (1, 2, 3):
        files.filter(F.col("run") == k).drop("run").write.mode("append").parquet(f"{out}/listed")
        stream = spark.readStream.schema(listed.schema).parquet(f"{out}/listed")
        settled = settling.settle_stream(stream, dt.timedelta(minutes=10))
        settling.write_settled(settled, f"{out}/settled", f"{out}/checkpoint").awaitTermination()
    found = spark.read.schema(settling.RESULT).parquet(f"{out}/settled")
    return settling.statuses(listed, found).select("path", F.unix_millis("modificationTime").alias("ms"), "status", "partner")
