"""WARC: archives of pages, and the normaliser that cuts one gzip stream into a member per record.

``write_archives`` writes records as whole-file gzip streams, the way a careless crawler does. ``normalise`` inflates each
such stream once, from front to back, rewrites every record as a gzip member of its own, and writes a sidecar index
(``offset, length, type, record id`` per line) with which ``read_archives`` opens single records. Files stream through
blocks of ``CHUNK`` bytes, so a task's memory does not depend on the size of a file or record.

Records with equal payloads are told from a digest table before anything is written: the largest page id is the response,
the others revisit it. Digests are counted before they are shuffled, and the join that brings the verdict back has a
written table on its right, so Spark can split a payload that a third of all pages share.

Every attempt of a task writes files of its own name; the table of archives names those of the attempts that counted, so
a lost executor leaves at most files that no one reads. All files lie in the shared folder.

Defined results: null html is an empty payload, a null url gives no target line. Payloads below ``least_bytes`` are never
revisited. A missing page id is smaller than any other. Of rows that repeat both id and payload one is the response and
the others revisit that id. An empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import table, written
from filedrop.session import new_scratch
from filedrop.sources import storage

#: Bytes read or inflated at a time, and bytes of records after which a writer begins another archive.
CHUNK, ARCHIVE_BYTES = 1 << 20, 256 << 20
DATE = "2024-01-01T00:00:00Z"
# Names that the format states.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"

ARCHIVES = "archive string, index string, records bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def with_record_type(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, sha1, record_type, refers_to`` of every page."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    same = keyed.groupBy("sha1", "page_id").agg(F.count(F.lit(1)).alias("n"))
    tops = same.groupBy("sha1").agg(F.max(F.struct("page_id", "n")).alias("top"), F.sum("n").alias("all"))
    tops = written(
        tops.filter(F.col("all") > 1).select(
            "sha1", F.col("top.page_id").alias("top_id"), F.col("top.n").alias("top_n"), F.lit(True).alias("shared")
        ), "payloads",
    )
    joined = keyed.join(tops, "sha1", "left")
    on_top = F.col("page_id").eqNullSafe(F.col("top_id"))
    one = F.lit(1).alias("place")
    if tops.filter("top_n > 1").isEmpty():
        placed = joined.select("*", one)
    else:
        many = on_top & (F.coalesce("top_n", F.lit(1)) > 1)
        number = F.row_number().over(Window.partitionBy("sha1", "page_id").orderBy("url")).alias("place")
        placed = joined.filter(~many).select("*", one).unionByName(joined.filter(many).select("*", number))
    first = F.col("shared").isNull() | (F.octet_length("html") < least_bytes) | (on_top & (F.col("place") == 1))
    return placed.select(
        "page_id", "url", "html", "sha1",
        F.when(first, F.lit("response")).otherwise(F.lit("revisit")).alias("record_type"),
        F.when(~first, F.col("top_id")).alias("refers_to"),
    )


def _header_text(value: str) -> str:
    """Signs that would end a header line are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id, url, payload: bytes, sha1: str, kind: str, refers_to) -> bytes:
    """A response with its payload, or a revisit with the response's header only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _create(path: str):
    store, inner = storage.resolve(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    # The name would make the store compress the bytes once more.
    return store.open_output_stream(inner, compression=None)


def _open(path: str):
    store, inner = storage.resolve(path)
    return store.open_input_file(inner)


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``with_record_type`` rows below ``folder``, one gzip stream per file; returns ``archive, index, records``."""
    def write(batches):
        out = squeeze = path = None
        done, count, size = [], 0, 0

        def close():
            out.write(squeeze.flush())
            out.close()
            done.append((path, None, count))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path = f"{folder}/whole-{uuid.uuid4().hex}.warc.gz"
                    out, squeeze, count, size = _create(path), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                data = record_bytes(row["page_id"], row["url"], row["html"].encode(), row["sha1"], row["record_type"],
                                    row["refers_to"])
                out.write(squeeze.compress(data))
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield _archives(done)

    return written(records.mapInArrow(write, ARCHIVES), "archives")


def _archives(rows) -> pa.RecordBatch:
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema[i].type) for i in range(3)], schema=schema)


class _Inflated:
    """A gzip file of any number of members as one stream of bytes, inflated once in blocks."""

    def __init__(self, file):
        self.file, self.inflate = file, zlib.decompressobj(31)
        self.packed = self.held = b""
        self.at = 0  # what of ``held`` has been given out
        self.started = False

    def _more(self) -> bool:
        """Inflates another block; false at the end of the file."""
        while True:
            if self.inflate.eof:
                self.packed = self.packed or self.file.read(CHUNK)
                if not self.packed:
                    return False
                self.inflate = zlib.decompressobj(31)
            # Output may still be pending when all input has been taken.
            data = self.inflate.decompress(self.packed, CHUNK)
            self.packed = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if data:
                self.held, self.at = self.held[self.at :] + data, 0
                return True
            if not self.inflate.eof and not self.packed:
                self.packed = self.file.read(CHUNK)
                if not self.packed:
                    if self.started:
                        raise EOFError("gzip stream is cut off")
                    return False
                self.started = True

    def header(self) -> bytes | None:
        """Bytes up to and with the blank line that ends a record's header; none at the end of the file."""
        while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                if self.held[self.at :].strip():
                    raise EOFError("record header is cut off")
                return None
        head, self.at = self.held[self.at : end + 4], end + 4
        return head

    def blocks(self, n: int):
        """The next ``n`` bytes in pieces."""
        while n:
            if self.at == len(self.held) and not self._more():
                raise EOFError("record is cut off")
            piece = self.held[self.at : self.at + n]
            self.at += len(piece)
            n -= len(piece)
            yield piece


def parse_header(head: bytes) -> dict[str, str]:
    """Field names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _packed(member, head: bytes, blocks):
    yield member.compress(head)
    for piece in blocks:
        yield member.compress(piece)
    yield member.flush()


def _rewrite(source: str, folder: str) -> tuple[str, str, int]:
    name = f"{folder}/records-{uuid.uuid4().hex}"
    archive, index = f"{name}.warc.gz", f"{name}.idx"
    offset = count = 0
    with _open(source) as whole, _create(archive) as out, _create(index) as sidecar:
        stream = _Inflated(whole)
        while (head := stream.header()) is not None:
            fields = parse_header(head)
            member = zlib.compressobj(6, zlib.DEFLATED, 31)
            length = 0
            for packed in _packed(member, head, stream.blocks(int(fields["content-length"]) + 4)):
                out.write(packed)
                length += len(packed)
            sidecar.write(f"{offset}\t{length}\t{fields['warc-type']}\t{fields['warc-record-id']}\n".encode())
            offset, count = offset + length, count + 1
    return archive, index, count


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each whole-file archive below ``folder`` with a member per record; returns ``archive, index, records``."""
    n = archives.count()

    def run(batches):
        for batch in batches:
            for source in batch.column("archive").to_pylist():
                yield _archives([_rewrite(source, folder)])

    return written(archives.select("archive").repartition(max(n, 1)).mapInArrow(run, ARCHIVES), "normalised")


def _page(urn: str) -> int | None:
    value = urn.strip("<>").removeprefix(ID)
    return None if value == "None" else int(value)


def read_record(data: bytes) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of one member; a wrong digest is an error."""
    inflated = zlib.decompress(data, 31)
    end = inflated.index(b"\r\n\r\n") + 4
    fields = parse_header(inflated[:end])
    block = inflated[end : end + int(fields["content-length"])]
    http_end = block.index(b"\r\n\r\n") + 4
    size = int(parse_header(block[:http_end])["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        payload = block[http_end:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    refers = fields.get("warc-refers-to")
    return _page(fields["warc-record-id"]), size, digest, kind, _page(refers) if refers else None


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """Every record of normalised archives, opened through the sidecar index."""
    n = archives.count()
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["index"]) as sidecar, _open(row["archive"]) as archive:
                    rows, rest = [], b""
                    while piece := sidecar.read(CHUNK):
                        *lines, rest = (rest + piece).split(b"\n")
                        for line in lines:
                            offset, length = map(int, line.split(b"\t")[:2])
                            archive.seek(offset)
                            rows.append(read_record(archive.read(length)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
                        rows = []

    return archives.repartition(max(n, 1)).mapInArrow(run, RECORDS)


OP7_SQL = """
with hashed as (
  select page_id, url, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages
), numbered as (
  select *, row_number() over same as place, first_value(page_id) over same as top from hashed
  window same as (partition by h order by page_id desc nulls last, url)
)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (i // 4) as int), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) as int), 1)), '')
    as payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type, case when place > 1 then top end as refers_to
from numbered
"""


@query("op7_warc_normaliser", OP7_SQL)
def op7(spark, sf_dir):
    records = with_record_type(table(spark, sf_dir, "pages"))
    whole = write_archives(records, new_scratch(spark, "warc-whole"))
    return read_archives(spark, normalise(whole, new_scratch(spark, "warc")))
