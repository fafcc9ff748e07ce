"""Inputs derived from the given tables, each in a Spark form and, where queries need it, a SQL form.

* ``manifest``: a listing with all name, size and pairing defects, from every row of ``events``.
* ``drop_folder``: real files on the shared folder, from every row of ``events``.
* ``records`` / ``record_files``: 520-byte records and gzip contents, from every row of ``lineitem``.
* ``text_files``: whole ``documents`` texts as contents, some of them damaged.
"""

from __future__ import annotations

import datetime as dt
import gzip
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from filedrop.constants import RECORD_BYTES
from filedrop.session import ensure_parallelism, new_scratch
from filedrop.sources import storage
from filedrop.sources.layout import Layout

AS_OF = dt.datetime(2024, 1, 15, 13, 0, 0, tzinfo=dt.timezone.utc)
TARGET_DATE, TARGET_HOUR = "20240115", "12"

# Explicit schemas save the inference job and read times as UTC instants.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_extendedprice double, l_returnflag string, l_shipdate timestamp",
    "documents": "doc_id bigint, text string, source string",
}

LAYOUT = Layout([
    ("orderkey", 1, 10), ("linenumber", 11, 2), ("returnflag", 13, 3), ("shipdate", 16, 8), ("price_cents", 24, 12),
])
EVENT_LAYOUT = Layout([("event", 1, 12), ("user", 13, 8), ("stamp", 21, 14), ("cents", 35, 12)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over the cores while its columns are still narrow."""
    return ensure_parallelism(spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet"))


# --- manifest ---------------------------------------------------------------------------------------------------

MANIFEST_SQL = """
named as (
  select *, cast(round(value * 100) as bigint) as cents,
    case when event_type = 'error' and value < 5 then 'R520' || lpad(cast(event_id as varchar), 8, '0')
         else (case when event_type = 'error' and value > 100 then 'X520' else 'R520' end)
              || lpad(cast(user_id as varchar), 4, '0') || strftime(ts, '%Y%m%d%H%M%S') end as base
  from events),
manifest as (
  select 'raw/' || base || '.gz' as path, ts as modificationTime,
    case when event_type = 'click' and value < 8 then 0
         when event_type = 'purchase' and value > 150 then null else cents end as length
  from named where not (event_type = 'signup' and value < 40)
  union all
  select 'raw/' || base || '_END', ts + interval 5 minutes, 0 from named
  where not (event_type = 'view' and value < 40)
  union all
  select 'raw/resend/' || base || '.gz', ts + interval 1 minute, cents + 1 from named
  where event_type = 'purchase' and value < 10
  union all
  select 'raw/' || base || '.gz ', ts, cents from named where event_type = 'error' and value >= 5 and value < 6
  union all
  select 'raw/' || base || '.gz_END', ts, 0 from named where event_type = 'error' and value >= 10 and value < 12
  union all
  select 'raw/note' || event_id || '.txt', ts, 1 from named where value < 1
  union all
  select 'raw/d' || event_id || '/', ts, 0 from named where value > 250)
"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of ``events``; each event lists one to four keys."""
    kind, value = F.col("event_type"), F.col("value")
    error = kind == "error"
    event_id, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    long_base = F.concat(
        F.when(error & (value > 100), F.lit("X520")).otherwise(F.lit("R520")),
        F.lpad(user, 4, "0"), F.date_format("ts", "yyyyMMddHHmmss"),
    )
    base = F.when(error & (value < 5), F.concat(F.lit("R520"), F.lpad(event_id, 8, "0"))).otherwise(long_base)
    named = table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "value", F.round(value * 100).cast("bigint").alias("cents"), base.alias("base")
    )
    cents = F.col("cents")

    def key(when, path, later="0 minutes", length=F.lit(0)):
        return F.when(when, F.struct(
            path.alias("path"),
            (F.col("ts") + F.expr(f"interval {later}")).alias("modificationTime"),
            length.cast("bigint").alias("length"),
        ))

    def raw(suffix, folder="raw/"):
        return F.concat(F.lit(folder), F.col("base"), F.lit(suffix))

    size = F.when((kind == "click") & (value < 8), F.lit(0)).when(~((kind == "purchase") & (value > 150)), cents)
    keys = F.array(
        key(~((kind == "signup") & (value < 40)), raw(".gz"), length=size),
        key(~((kind == "view") & (value < 40)), raw("_END"), "5 minutes"),
        key((kind == "purchase") & (value < 10), raw(".gz", "raw/resend/"), "1 minute", cents + 1),
        key(error & (value >= 5) & (value < 6), raw(".gz "), length=cents),
        key(error & (value >= 10) & (value < 12), raw(".gz_END")),
        key(value < 1, F.concat(F.lit("raw/note"), event_id, F.lit(".txt")), length=F.lit(1)),
        key(value > 250, F.concat(F.lit("raw/d"), event_id, F.lit("/"))),
    )
    return named.select(F.explode(F.array_compact(keys)).alias("k")).select("k.*")


# --- files on the shared folder ---------------------------------------------------------------------------------

# The groups below stand for one store and hour each; some deliver damaged, unpaired or misnamed files.
DROPS_SQL = """
delivered as (
  select case when event_type = 'purchase' and strftime(ts, '%H') = '07' then 'X520' else 'R520' end
      || case event_type when 'click' then '0001' when 'error' then '0002' when 'purchase' then '0003'
                         when 'signup' then '0004' when 'view' then '0005' else '0009' end
      || strftime(ts, '%Y%m%d%H') || '0000' as base,
    event_type, strftime(ts, '%H') as hh, count(*) as n
  from events group by all),
drops as (
  select base, n, hh, event_type,
    not (event_type = 'signup' and hh = '03') as has_gz,
    not (event_type = 'view' and hh = '04') as has_end,
    case when event_type = 'error' and hh = '05' then 'corrupt'
         when event_type = 'error' and hh = '06' then 'empty' else 'ok' end as content
  from delivered)
"""

_folders: dict[tuple, str] = {}


def drop_folder(spark: SparkSession, sf_dir: str, fresh: bool = False) -> str:
    """Folder with one data file and marker per event type and hour, below a folder per store.

    Made once per session unless ``fresh``.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if not fresh and key in _folders:
        return _folders[key]
    folder = new_scratch(spark, "drops")
    kind, hh = F.col("event_type"), F.date_format("ts", "HH")
    store = F.when(kind == "click", "0001").when(kind == "error", "0002").when(kind == "purchase", "0003")
    store = store.when(kind == "signup", "0004").when(kind == "view", "0005").otherwise("0009")
    prefix = F.when((kind == "purchase") & (hh == "07"), "X520").otherwise("R520")
    base = F.concat(prefix, store, F.date_format("ts", "yyyyMMddHH"), F.lit("0000"))
    content = F.when((kind == "error") & (hh == "05"), "corrupt").when((kind == "error") & (hh == "06"), "empty")
    rec = F.concat(
        F.lpad(F.col("event_id").cast("string"), 12, "0"),
        F.lpad(F.col("user_id").cast("string"), 8, "0"),
        F.date_format("ts", "yyyyMMddHHmmss"),
        F.lpad(F.round(F.col("value") * 100).cast("bigint").cast("string"), 12, "0"),
    )
    rows = table(spark, sf_dir, "events").select(
        base.alias("base"),
        content.alias("content"),
        (~((kind == "signup") & (hh == "03"))).alias("has_gz"),
        (~((kind == "view") & (hh == "04"))).alias("has_end"),
        F.rpad(rec, RECORD_BYTES, " ").alias("rec"),
    )
    written = rows.repartition("base").sortWithinPartitions("base", "rec").mapInArrow(
        _file_writer(f"{folder}/in"), "base string, n bigint"
    )
    written.write.parquet(f"{folder}/log")
    if not fresh:
        _folders[key] = f"{folder}/in"
    return f"{folder}/in"


def _file_writer(folder: str):
    def write(batches):
        row, pack, packed, n = None, None, b"", 0

        def close():
            path = f"{folder}/{row['base'][4:8]}/{row['base']}"
            if row["has_gz"]:
                data = bytes(packed + pack.flush())
                storage.write_bytes(f"{path}.gz", data[:-6] if row["content"] == "corrupt" else data)
            if row["has_end"]:
                storage.write_bytes(f"{path}_END", b"")
            return pa.RecordBatch.from_pydict({"base": [row["base"]], "n": pa.array([n], pa.int64())})

        # Rows arrive sorted by file; only the compressed bytes of the current file are kept.
        for batch in batches:
            for nxt in batch.to_pylist():
                if row is None or nxt["base"] != row["base"]:
                    if row is not None:
                        yield close()
                    row, pack, packed, n = nxt, zlib.compressobj(1, zlib.DEFLATED, 31), bytearray(), 0
                if row["content"] != "empty":
                    packed += pack.compress(nxt["rec"].encode())
                n += 1
        if row is not None:
            yield close()

    return write


# --- records ----------------------------------------------------------------------------------------------------

RECORDS_SQL = """
records as (
  select l_orderkey, l_linenumber,
    rpad(lpad(cast(l_orderkey as varchar), 10, '0') || lpad(cast(l_linenumber as varchar), 2, '0')
      || rpad(l_returnflag, 3, ' ') || strftime(l_shipdate, '%Y%m%d')
      || lpad(cast(cast(round(l_extendedprice * 100) as bigint) as varchar), 12, '0'), 520, ' ') as rec
  from lineitem)
"""
FIELDS_SQL = """
  substring(rec, 1, 10) as orderkey, substring(rec, 11, 2) as linenumber, substring(rec, 13, 3) as returnflag,
  substring(rec, 16, 8) as shipdate, substring(rec, 24, 12) as price_cents
"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rec``: one 520-byte record per lineitem."""
    fields = [
        F.lpad(F.col("l_orderkey").cast("string"), 10, "0"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        F.rpad("l_returnflag", 3, " "),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.lpad(F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"), 12, "0"),
    ]
    # Every field has its full width, so a constant tail fills the record.
    tail = F.lit(" " * (RECORD_BYTES - sum(f.length for f in LAYOUT)))
    rec = F.concat(*fields, tail).cast("binary")
    return table(spark, sf_dir, "lineitem").select(rec.alias("rec"))


def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, content``: the records packed into gzip contents, one per Arrow batch.

    Nothing is grouped, so no key, however frequent, can fill a file or a task.
    """
    return records(spark, sf_dir).mapInArrow(_pack, "path string, content binary")


def _pack(batches):
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        body = b"".join(batch.column("rec").to_pylist())
        path = f"raw/R520{part:012d}{seq:06d}.gz"
        seq += 1
        yield pa.RecordBatch.from_pydict({
            "path": [path], "content": pa.array([gzip.compress(body, 1)], pa.binary()),
        })


def member_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the records as gzip files of many members, one file per Arrow batch; members end anywhere in a record."""
    folder = new_scratch(spark, "members")
    records(spark, sf_dir).mapInArrow(_member_writer(f"{folder}/in"), "path string").write.parquet(f"{folder}/log")
    return f"{folder}/in"


def _member_writer(folder: str, member_bytes: int = 100_000):
    def write(batches):
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            body = b"".join(batch.column("rec").to_pylist())
            members = [gzip.compress(body[i:i + member_bytes], 1) for i in range(0, len(body), member_bytes)]
            path = f"{folder}/R520{part:012d}{seq:06d}.gz"
            storage.write_bytes(path, b"".join(members))
            seq += 1
            yield pa.RecordBatch.from_pydict({"path": [path]})

    return write


# --- texts ------------------------------------------------------------------------------------------------------

def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, content``: whole texts as bytes."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))


def text_files(spark: SparkSession, sf_dir: str, damage: dict[str, str]) -> DataFrame:
    """``path, content``: texts as gzip contents; ``damage`` names by ``source`` what is done to them."""
    how = F.lit("ok")
    for source, what in damage.items():
        how = F.when(F.col("source") == source, F.lit(what)).otherwise(how)
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("raw/doc"), F.col("doc_id").cast("string"), F.lit(".gz")).alias("path"),
        F.col("text").cast("binary").alias("body"),
        how.alias("how"),
    )
    return docs.mapInArrow(_pack_texts, "path string, content binary")


def _pack_texts(batches, rows: int = 256):
    # Texts are long: besides the batch itself only a slice of it is held, and nothing while the next one is read.
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield _pack_slice(batch.slice(at, rows))
        del batch


def _pack_slice(batch):
    contents = [
        _packed(body, how) for body, how in zip(batch.column("body").to_pylist(), batch.column("how").to_pylist())
    ]
    return pa.RecordBatch.from_arrays([batch.column("path"), pa.array(contents, pa.binary())], names=["path", "content"])


def _packed(body: bytes, how: str) -> bytes:
    if how == "plain":
        return body
    if how == "empty":
        return gzip.compress(b"", 1)
    packed = gzip.compress(body, 1)
    if how == "truncated":
        return packed[:-4]
    if how == "garbage":
        return packed + b"trailing"
    if how == "members":
        half = len(body) // 2
        return gzip.compress(body[:half], 1) + gzip.compress(body[half:], 1)
    return packed
