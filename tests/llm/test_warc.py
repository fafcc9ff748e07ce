import base64
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest

from filedrop.llm import warc
from filedrop.session import new_scratch


def expected(rows, least=0):
    by_payload = defaultdict(list)
    for page_id, _, html in rows:
        by_payload[(html or "").encode()].append(page_id)
    out = Counter()
    for payload, ids in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for n, i in enumerate(ids):
            first = n == 0 or len(payload) < least
            out[(i, len(payload), digest, "response" if first else "revisit", None if first else ids[0])] += 1
    return out


ROWS = [(1, "u", "a"), (1, "u", "a"), (2, None, None), (3, "x\r\ny", ""), (None, "u", "a"), (None, "u", "zé"),
        (None, "u", "zé"), (9, "u", "big" * 1_500_000), (5, "z", "a"), (6, "http://é/", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (-7, "m", "neg"), (-8, "m", "neg")]


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, sha1 string")
    records = warc.with_record_type(pages, least)
    whole = warc.write_archives(records, new_scratch(spark, "w"), archive_bytes=100)
    normal = warc.normalise(whole, new_scratch(spark, "n"))
    got = Counter(tuple(r) for r in warc.read_archives(spark, normal).collect())
    assert got == expected(ROWS, least)
    assert sum(r["records"] for r in normal.collect()) == len(ROWS)


def test_members_and_index_of_one_archive(spark):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(1)
    whole = warc.write_archives(warc.with_record_type(pages).coalesce(1), new_scratch(spark, "w"))
    normal = warc.normalise(whole, new_scratch(spark, "n")).collect()
    assert len(normal) == 1
    read = lambda p: warc._open(p).read()
    old, new, index = read(whole.first()["archive"]), read(normal[0]["archive"]), read(normal[0]["index"])
    # The same bytes, one stream before, a member per record after.
    assert gzip.decompress(old) == gzip.decompress(new)
    lines = [x.split("\t") for x in index.decode().splitlines()]
    assert len(lines) == len(ROWS) and [x[2] for x in lines].count("revisit") == 6
    end = 0
    for offset, length, kind, record_id in lines:
        assert int(offset) == end
        end += int(length)
        member = gzip.decompress(new[int(offset) : end])
        assert member.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and record_id.encode() in member
    assert end == len(new)


def test_damage_is_an_error():
    record = warc.record_bytes(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None)
    packed = gzip.compress(record)
    assert warc.read_record(packed)[:2] == (1, 7)
    with pytest.raises(ValueError, match="damaged"):
        warc.read_record(gzip.compress(record.replace(b"payload", b"pAyload")))
    stream = warc._Inflated(io.BytesIO(packed[:-9]))
    with pytest.raises(EOFError):
        while stream.header() is not None:
            for _ in stream.blocks(10**6):
                pass


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    whole = warc.write_archives(warc.with_record_type(pages), new_scratch(spark, "w"))
    assert warc.read_archives(spark, warc.normalise(whole, new_scratch(spark, "n"))).count() == 0
