import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from filedrop.operators import gunzip

REC = b"x" * 520


def outcomes(spark, contents, **kw):
    rows = [(name, bytearray(c)) for name, c in contents.items()]
    df = spark.createDataFrame(rows, "path string, content binary")
    status = {r["path"]: (r["status"], r["n_records"]) for r in gunzip.file_outcomes(df, **kw).collect()}
    records = gunzip.gunzip_records(df, **kw).groupBy("path").count().collect()
    counted = {r["path"]: r["count"] for r in records}
    assert counted == {p: n for p, (_, n) in status.items() if n}
    return status


GOOD = gzip.compress(REC * 3)
FLIPPED = GOOD[:-8] + bytes([GOOD[-8] ^ 1]) + GOOD[-7:]


def test_outcomes(spark):
    got = outcomes(spark, {
        "three": GOOD,
        "tail": gzip.compress(REC * 2 + b"yy"),
        "members": gzip.compress(REC) + gzip.compress(REC * 2),
        "padded": GOOD + b"\0" * 9,
        "truncated": GOOD[:-3],
        "header": GOOD[:5],
        "garbage": GOOD + b"junk",
        "checksum": FLIPPED,
        "deflate": GOOD[:10] + b"\xff\xff\xff" + GOOD[13:],
        "plain": b"no gzip at all",
        "empty": gzip.compress(b""),
        "nothing": b"",
    })
    assert got == {
        "three": ("ok", 3), "tail": ("ok", 3), "members": ("ok", 3), "padded": ("ok", 3),
        "truncated": ("corrupt", 0), "header": ("corrupt", 0), "garbage": ("corrupt", 0),
        "checksum": ("corrupt", 0), "deflate": ("corrupt", 0), "plain": ("corrupt", 0),
        "empty": ("empty", 0), "nothing": ("empty", 0),
    }


def test_raw_fallback_takes_only_what_is_no_gzip(spark):
    got = outcomes(spark, {
        "plain": b"z" * 1000, "truncated": GOOD[:-3], "garbage": GOOD + b"junk", "three": GOOD,
    }, on_error="raw")
    assert got == {
        "plain": ("raw", 2), "truncated": ("corrupt", 0), "three": ("ok", 3),
        "garbage": ("raw", -(-len(GOOD + b"junk") // 520)),
    }


def test_long_files_are_decoded_in_pieces(spark, monkeypatch):
    """Beyond the memory limit the file is checked first and then streamed; the records are the same."""
    body = os.urandom(520 * 9000 + 17)
    monkeypatch.setattr(gunzip, "MEMORY_BYTES", 1 << 20)
    df = spark.createDataFrame(
        [("long", bytearray(gzip.compress(body, 1))), ("bad", bytearray(gzip.compress(body, 1)[:-4]))],
        "path string, content binary",
    )
    rows = gunzip.gunzip_records(df).orderBy("ord").collect()
    assert b"".join(bytes(r["rec"]) for r in rows) == body
    assert [r["ord"] for r in rows] == list(range(9001))
    status = {r["path"]: r["status"] for r in gunzip.file_outcomes(df).collect()}
    assert status == {"long": "ok", "bad": "corrupt"}


def test_tasks_open_paths_themselves(spark, tmp_path, monkeypatch):
    for i in range(5):
        (tmp_path / f"f{i}.gz").write_bytes(gzip.compress(REC * i))
    paths = [(str(tmp_path / f"f{i}.gz"), 30) for i in range(5)] + [(str(tmp_path / "gone.gz"), None)]
    monkeypatch.setattr(gunzip, "TASK_BYTES", 20)
    decoded = gunzip.decode_listed(spark.createDataFrame(paths, "path string, length bigint"))
    assert decoded.rdd.getNumPartitions() == 8
    got = {
        os.path.basename(r["drop_file"]): (r["drop_status"], r["drop_records"])
        for r in decoded.filter("drop_kind = 'outcome'").collect()
    }
    assert got == {
        "f0.gz": ("empty", 0), "f1.gz": ("ok", 1), "f2.gz": ("ok", 2), "f3.gz": ("ok", 3), "f4.gz": ("ok", 4),
        "gone.gz": ("missing", 0),
    }


def test_records_of_a_large_file_are_shared_out(spark, tmp_path, monkeypatch):
    """One file holds most records: its blocks spread over tasks, and nothing is lost or doubled."""
    big = b"".join(b"%0520d" % i for i in range(40_000))
    (tmp_path / "big.gz").write_bytes(gzip.compress(big, 1))
    (tmp_path / "small.gz").write_bytes(gzip.compress(REC))
    listing = [(str(p), p.stat().st_size) for p in tmp_path.iterdir()]
    files = spark.createDataFrame(listing, "path string, length bigint")
    monkeypatch.setattr(gunzip, "INDEX_BYTES", 10_000)
    monkeypatch.setattr(gunzip, "DEAL_BYTES", 10_000)
    decoded = gunzip.decode_listed(files, columns=("rec",))
    assert decoded.columns == ["rec"] and decoded.count() == 40_001
    per_task = [len(p) for p in decoded.rdd.glom().collect()]
    assert max(per_task) < 30_000 and sum(n > 1 for n in per_task) > 1
    both = gunzip.decode_listed(files)
    assert both.filter("drop_kind = 'outcome'").count() == 2
    assert both.filter("drop_kind = 'record'").select("drop_file", "ord").distinct().count() == 40_001


def test_members_of_one_file_are_decoded_by_several_tasks(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    inner = gzip.compress(bytes(rng.randrange(256) for _ in range(3000)))
    bodies = [bytes(rng.choices(b"abc \x1f\x8b\x08\x00", k=rng.choice([0, 1, 519, 520, 521, 3000, 9000]))) for _ in range(60)]
    # A gzip file stored in a member holds headers, checksums and all; its copy at the end of a stored block too.
    bodies[7:7] = [inner, b"x" * 100 + inner + inner[:50]]
    files = {
        "many": b"".join(gzip.compress(b, 0 if i % 3 == 0 else 6) for i, b in enumerate(bodies)),
        "single": gzip.compress(b"".join(bodies) * 3),
        "empty": gzip.compress(b"") * 900,
        "padded": gzip.compress(bodies[5] * 9, 0) + gzip.compress(bodies[-1], 0) + b"\0" * 20_000,
    }
    files["cut"] = files["many"][:-5]
    files["garbage"] = files["many"] + b"no gzip"
    files["flipped"] = files["many"][:9000] + bytes([files["many"][9000] ^ 255]) + files["many"][9001:]
    files["plain"] = bytes(20_000)
    files["inner"] = b"no gzip" * 900 + inner * 5
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    listing = [(str(tmp_path / n), len(c)) for n, c in files.items()] + [(str(tmp_path / "gone"), 50_000)]
    listed = spark.createDataFrame(listing, "path string, length bigint")
    for step, chunk, deal in ((4999, 4000, 8000), (1 << 20, 1, 1 << 30)):
        monkeypatch.setattr(gunzip, "INDEX_BYTES", 1000)
        monkeypatch.setattr(gunzip, "DEAL_BYTES", deal)
        monkeypatch.setattr(gunzip.members, "RANGE_BYTES", step)
        monkeypatch.setattr(gunzip.members, "CHUNK_BYTES", chunk)
        whole = {os.path.basename(r["path"]) for r in gunzip.members.index(listed).collect()}
        assert whole == {"many", "single", "empty"}
        for on_error in ("skip", "raw"):
            decoded = gunzip.decode_listed(listed, on_error=on_error).withColumn("task", F.spark_partition_id())
            rows = decoded.collect()
            one = gunzip.decode_files(listed, on_error=on_error).collect()
            key = lambda r: (r["drop_kind"], r["drop_file"], r["ord"], bytes(r["rec"] or b""), r["drop_status"], r["drop_records"])
            assert sorted(map(repr, map(key, rows))) == sorted(map(repr, map(key, one)))
        assert len({r["task"] for r in rows if r["drop_file"].endswith("many")}) > 3
    # Fewer columns come from the same index.
    assert gunzip.decode_listed(listed, columns=("rec",)).count() == gunzip.decode_files(listed, columns=("rec",)).count()
    assert gunzip.decode_listed(listed, columns=gunzip.OUTCOME).count() == len(listing)


def test_a_file_replaced_after_its_search_fails_the_task(spark, tmp_path):
    path = tmp_path / "a.gz"
    path.write_bytes(gzip.compress(REC) * 9)
    row = gunzip.members.index(spark.createDataFrame([(str(path), path.stat().st_size)], "path string, length bigint")).first()
    assert sum(b.num_rows for b in gunzip._stretch(row, 520, gunzip.BOTH)) == 9
    os.utime(path, (1, 1))
    with pytest.raises(OSError, match="replaced"):
        list(gunzip._stretch(row, 520, gunzip.BOTH))


def test_both_rows_come_from_one_pass(spark):
    df = spark.createDataFrame([("a", bytearray(GOOD))], "path string, content binary")
    rows = gunzip.decode_files(df).collect()
    assert [r["drop_kind"] for r in rows] == ["record"] * 3 + ["outcome"]
    with pytest.raises(ValueError):
        gunzip.decode_files(df, on_error="ignore")
    with pytest.raises(ValueError):
        gunzip.decode_files(df, columns=("ord",))


def test_a_file_replaced_between_two_reads_fails_the_task(tmp_path, monkeypatch):
    monkeypatch.setattr(gunzip, "MEMORY_BYTES", 100)
    path = tmp_path / "a.gz"
    path.write_bytes(gzip.compress(b"x" * 2000))
    versions = iter([(1, 1.0), (1, 2.0)])
    read = lambda v: list(gunzip._decode_one(str(path), lambda: open(path, "rb"), 520, "skip", gunzip.BOTH, v))
    assert sum(b.num_rows for b in read(lambda: (1, 1.0))) == 5
    with pytest.raises(OSError, match="replaced"):
        read(lambda: next(versions))


def test_listed_files_are_packed_by_bytes(spark, tmp_path, monkeypatch):
    # Four files of many records and 60 of one: the large ones are decoded by different tasks.
    sizes = [(f"big{i}.gz", 4000 + i) for i in range(4)] + [(f"s{i}.gz", 1) for i in range(60)]
    paths = []
    for name, n in sizes:
        (tmp_path / name).write_bytes(gzip.compress(b"".join(b"%06d" % i * 40 for i in range(n)), 1))
        paths.append((str(tmp_path / name), (tmp_path / name).stat().st_size))
    monkeypatch.setattr(gunzip, "FILE_BYTES", 1)
    monkeypatch.setattr(gunzip, "TASK_BYTES", max(p[1] for p in paths) // 2)
    files = spark.createDataFrame(paths, "path string, length bigint")
    found = gunzip.decode_listed(files, 240, columns=gunzip.OUTCOME).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["drop_file"].rsplit("/", 1)[1], r["drop_records"]) for r in found) == sorted(sizes)
    assert len({r["task"] for r in found if "/big" in r["drop_file"]}) == 4
