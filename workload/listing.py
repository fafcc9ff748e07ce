"""Names, listings and pairs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from filedrop.functions import formats, names
from filedrop.operators import naming, pairing, triage
from filedrop.operators.summary import run_counts
from filedrop.sources import manifest as listing
from workload import fixtures as fx
from workload.registry import query

WITH = f"with {fx.MANIFEST_SQL}"
NAME = "regexp_extract(path, '[^/]*$')"
VALID = r"(regexp_matches(filename, '^R520\d{4}\d{8}\d{6}\.gz$') or regexp_matches(filename, '^R520\d{4}\d{8}\d{6}_END$'))"
# Paths here carry no whitespace but blanks, so trim equals stripping.
READ = r"regexp_extract(trim({0}), '([^/]*)$', 1)"
READABLE = r"regexp_matches(" + READ + r", '^R520\d{{4}}\d{{8}}\d{{2}}\d{{4}}(_END|\.gz)$')"

DROPS = f"""{WITH},
files as (
  select *, {NAME} as name, case when path like '%.gz' then 'gz' else 'end' end as kind,
    case when path like '%.gz' then left({NAME}, length({NAME}) - 3)
         else left({NAME}, length({NAME}) - 4) end as base,
    replace(replace({NAME}, '.gz', ''), '_END', '') as wide_base
  from manifest
  where path not like '%/' and trim(path) <> '' and (path like '%.gz' or path like '%\\_END' escape '\\'))"""

PAIRS = f"""{DROPS},
keyed as (
  select base, max(path) filter (kind = 'gz') as gz_key, max(path) filter (kind = 'end') as end_key
  from files group by base),
pairs as (
  select k.base, k.gz_key, k.end_key, max(f.length) as gz_length
  from keyed k left join files f on f.path = k.gz_key group by all)"""


@query("basename", f"{WITH} select path, {NAME} as filename from manifest")
def basename(spark, sf):
    """Name after the last slash."""
    return fx.manifest(spark, sf).select("path", names.basename("path").alias("filename"))


@query("name_valid", f"""{WITH}
select file_key, filename, {VALID} as is_valid from (select path as file_key, {NAME} as filename from manifest)""")
def name_valid(spark, sf):
    """Name check of every key."""
    return naming.check_names(fx.manifest(spark, sf))


@query("invalid_files", f"""{WITH}
select file_key from (select path as file_key, {NAME} as filename from manifest) where not {VALID}""")
def invalid_files(spark, sf):
    """Keys that fail the name check."""
    return naming.invalid_files(fx.manifest(spark, sf))


@query("skip_dirs", f"{WITH} select path from manifest where path not like '%/' and trim(path) <> ''")
def skip_dirs(spark, sf):
    """Listing without folder keys."""
    return fx.manifest(spark, sf).filter(names.is_file_key("path")).select("path")


@query("base_key", f"{DROPS} select path, base, wide_base from files")
def base_key(spark, sf):
    """Pair key, by suffix and by removing every suffix text."""
    name = names.basename("path")
    return listing.drop_files(fx.manifest(spark, sf)).select(
        "path", names.base_key(name).alias("base"), names.base_key(name, replace_all=True).alias("wide_base")
    )


@query("file_kind", f"{DROPS} select path, kind from files")
def file_kind(spark, sf):
    """Data file or marker."""
    return listing.drop_files(fx.manifest(spark, sf)).select("path", names.file_kind("path").alias("kind"))


@query("extract_regex", f"""{WITH}
select path,
  case when {READABLE.format('path')} then substring({READ.format('path')}, 5, 4) end as store_code,
  case when {READABLE.format('path')} then substring({READ.format('path')}, 9, 8) end as transaction_date,
  case when {READABLE.format('path')} then substring({READ.format('path')}, 17, 2) end as transaction_hour
from manifest""")
def extract_regex(spark, sf):
    """Store, date and hour of well-formed names."""
    return names.with_name_parts(fx.manifest(spark, sf).select("path"))


POSITIONAL = f"""case when path like '%.gz' then split_part({NAME}, '.', 1)
  when path like '%\\_END' escape '\\' then split_part({NAME}, '_END', 1) end"""


@query("extract_positional", f"""{WITH}
select path, base_filename, substring(base_filename, 9, 8) as transaction_date,
  substring(base_filename, 17, 2) as transaction_hour
from (select path, {POSITIONAL} as base_filename from manifest)""")
def extract_positional(spark, sf):
    """Date and hour cut by position."""
    return names.with_position_parts(fx.manifest(spark, sf).select("path"))


@query("log_path", """
select event_id, 'LOGS/' || event_type || '/' || strftime(ts, '%Y%m%d%H%M%S') || '/' as log_path from events""")
def log_path(spark, sf):
    """Log folder per event type and time."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return fx.table(spark, sf, "events").select("event_id", formats.log_path("event_type", stamp).alias("log_path"))


# --- listings ---------------------------------------------------------------------------------------------------

@query("manifest_all", f"""with {fx.DROPS_SQL}
select base || '.gz' as name, false as is_zero from drops where has_gz
union all select base || '_END', true from drops where has_end""")
def manifest_all(spark, sf):
    """Every file of a real folder, zero-byte markers included."""
    found = listing.read_manifest(spark, fx.drop_folder(spark, sf))
    return found.select(names.basename("path").alias("name"), (F.col("length") == 0).alias("is_zero"))


@query("manifest_wanted", f"""with {fx.DROPS_SQL}
select base || '.gz' as name from drops where has_gz and base like 'R5200002%' and content <> 'empty'""")
def manifest_wanted(spark, sf):
    """Data files of a real folder that begin with a prefix and were delivered with bytes in them.

    Prefix, suffix, time and size are told to the listing, which reads one store's folder only. An empty delivery is a gzip
    file of 20 bytes.
    """
    found = listing.read_manifest(
        spark, fx.drop_folder(spark, sf), prefix="0002/R520", suffixes=(".gz",), since=dt.datetime(2000, 1, 1), least=21
    )
    return found.select(names.basename("path").alias("name"))


@query("manifest_suffix", f"""{DROPS}
select path, length from files where path like 'raw/resend/%' or path like 'raw/R520%'""")
def manifest_suffix(spark, sf):
    """Drop files below two key prefixes."""
    m = fx.manifest(spark, sf)
    found = listing.with_prefix_and_suffix(m, "raw/resend/").unionByName(
        listing.with_prefix_and_suffix(m, "raw/R520")
    )
    return found.select("path", "length")


RECENT = "modificationTime between timestamp '2024-01-15 12:00:00' and timestamp '2024-01-15 13:00:00'"


@query("recent_filter", f"{WITH} select path, {RECENT} as is_recent from manifest")
def recent_filter(spark, sf):
    """Recency of every key."""
    return fx.manifest(spark, sf).select("path", listing.is_recent(fx.AS_OF).alias("is_recent"))


@query("manifest_recent", f"""{DROPS}
select wide_base as base, max(path) filter (kind = 'gz') as gz_key, max(path) filter (kind = 'end') as end_key
from files where {RECENT} group by 1""")
def manifest_recent(spark, sf):
    """Recent files, paired by the wide key."""
    recent = listing.recent_files(fx.manifest(spark, sf), fx.AS_OF)
    return pairing.pair_files(recent, replace_all=True).select("base", "gz_key", "end_key")


@query("zero_size", f"{WITH} select path from manifest where path like '%.gz' and length = 0")
def zero_size(spark, sf):
    """Empty data files."""
    return listing.zero_size(fx.manifest(spark, sf)).select("path")


# --- pairs ------------------------------------------------------------------------------------------------------

@query("pair_files", f"{PAIRS} select * from pairs")
def pair_files(spark, sf):
    """Data files with their markers."""
    return pairing.pair_files(fx.manifest(spark, sf))


ORPHANS = f"""{DROPS},
lone as (
  select base, max(path) as file_key, case when kind = 'gz' then 'missing_end' else 'missing_gz' end as status
  from files f
  where not exists (select 1 from files g where g.base = f.base and g.kind <> f.kind)
  group by base, kind)"""


@query("orphans_anti", f"{ORPHANS} select * from lone")
def orphans_anti(spark, sf):
    """Files without a partner."""
    return pairing.orphans(pairing.pair_files(fx.manifest(spark, sf)))


@query("orphan_union", f"""{ORPHANS}
select file_key from lone where status = 'missing_end' union all
select file_key from lone where status = 'missing_gz'""")
def orphan_union(spark, sf):
    """Lone data files and lone markers in one list."""
    return pairing.orphan_keys(pairing.pair_files(fx.manifest(spark, sf)))


@query("pair_shape", f"""{PAIRS}
select base, gz_key, end_key,
  case when gz_key is null or end_key is null or not coalesce({READABLE.format('gz_key')}, false) then 'bad_entry'
       else 'ok' end as shape
from pairs""")
def pair_shape(spark, sf):
    """Which pair rows are complete enough to be archived."""
    triaged = triage.triage_hourly(pairing.pair_files(fx.manifest(spark, sf)))
    return pairing.check_shape(triaged).select("base", "gz_key", "end_key", "shape")


@query("run_counts", f"""{DROPS},
wide as (
  select wide_base as base, max(path) filter (kind = 'gz') as gz_key, max(path) filter (kind = 'end') as end_key
  from files group by 1)
select
  (select count(*) from manifest) as files,
  (select count(*) from (select {NAME} as filename from manifest) where not {VALID}) as invalid_files,
  (select count(*) from files) as drop_files,
  (select count(*) from wide) as pairs_found,
  (select count(*) from wide where end_key is not null and gz_key is not null and {READABLE.format('gz_key')})
    as valid_pairs""")
def counts(spark, sf):
    """Files, invalid names, pairs and valid pairs of a listing."""
    return run_counts(fx.manifest(spark, sf), replace_all=True)
