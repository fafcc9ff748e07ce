import datetime as dt
import os
import time

from pyspark.sql import functions as F

from filedrop.operators import pairing
from filedrop.sources.manifest import SCHEMA, stream_manifest
from filedrop.streaming.pairing import pair_stream, write_pairs

T0 = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def settle(spark, tmp_path, folder, **kw):
    pairs = pair_stream(spark.readStream.schema(SCHEMA).parquet(folder), **kw)
    write_pairs(pairs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.schema(pairs.schema).parquet(str(tmp_path / "out")).collect()
    return sorted((r["base"], r["status"]) for r in rows)


def test_pairs_across_runs_and_hours(spark, tmp_path):
    """A marker that comes after the hour is over still finds its data file; a late one does not."""
    folder = str(tmp_path / "in")
    feed(spark, folder, [("a.gz", at(58), 1), ("b.gz", at(0), 1), ("c_END", at(50), 0)])
    assert settle(spark, tmp_path, folder, grace="10 minutes", delay="5 minutes") == [("b", "missing_end")]
    feed(spark, folder, [("a_END", at(62), 0), ("b_END", at(90), 0)])
    got = settle(spark, tmp_path, folder, grace="10 minutes", delay="5 minutes")
    assert got == [("a", "paired"), ("b", "missing_end"), ("c", "missing_gz")]
    feed(spark, folder, [("z.gz", at(300), 1)])
    got = settle(spark, tmp_path, folder, grace="10 minutes", delay="5 minutes")
    assert got == [("a", "paired"), ("b", "missing_end"), ("b", "missing_gz"), ("c", "missing_gz")]


def test_settled_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = []
    for i in range(300):
        if i % 3:
            rows.append((f"raw/R{i}.gz", at(i), i))
        if i % 4:
            rows.append((f"raw/R{i}_END", at(i + 3), 0))
    rows.append(("raw/note.txt", at(1), 1))
    feed(spark, folder, rows)
    feed(spark, folder, [("raw/last.gz", at(10_000), 1)])
    got = settle(spark, tmp_path, folder)
    batch = pairing.pair_files(spark.createDataFrame(rows, SCHEMA))
    status = F.when(pairing.is_complete(), "paired").when(F.col("gz_key").isNull(), "missing_gz").otherwise("missing_end")
    assert got == sorted((r["base"], r["s"]) for r in batch.select("base", status.alias("s")).collect())


def drop(folder, name, seconds_ago):
    path = folder / name
    path.write_bytes(b"")
    when = time.time() - seconds_ago
    os.utime(path, (when, when))


def test_a_folder_is_followed(spark, tmp_path):
    """Zero-byte markers count, nothing is listed twice, and later files come with the next run."""
    raw = tmp_path / "raw"
    raw.mkdir()
    drop(raw, "a.gz", 7200)
    drop(raw, "a_END", 7100)
    drop(raw, "b.gz", 7000)

    def follow():
        listed = stream_manifest(spark, str(raw), settle=1).select("path", "length")
        query = listed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        rows = spark.read.schema("path string, length bigint").parquet(str(tmp_path / "out")).collect()
        return sorted(os.path.basename(r["path"]) for r in rows)

    assert follow() == ["a.gz", "a_END", "b.gz"]
    drop(raw, "b_END", 0)
    time.sleep(1.5)
    assert follow() == ["a.gz", "a_END", "b.gz", "b_END"]


def test_pairing_a_followed_folder(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    drop(raw, "a.gz", 7200)
    drop(raw, "a_END", 7100)
    drop(raw, "b.gz", 7000)
    drop(raw, "c.gz", 2)
    # The first run moves the watermark, the second gives out what it settled.
    for _ in range(2):
        pairs = pair_stream(stream_manifest(spark, str(raw), settle=1))
        write_pairs(pairs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.schema(pairs.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted((r["base"], r["status"]) for r in rows) == [("a", "paired"), ("b", "missing_end")]


def test_a_file_that_becomes_visible_late_is_found(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    drop(raw, "a.gz", 100)

    def follow():
        listed = stream_manifest(spark, str(raw), settle=1, overlap=600).select("path")
        query = listed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
        rows = spark.read.schema("path string").parquet(str(tmp_path / "out")).collect()
        return sorted(os.path.basename(r["path"]) for r in rows)

    assert follow() == ["a.gz"]
    drop(raw, "late.gz", 60)
    assert follow() == ["a.gz", "late.gz"]
    assert follow() == ["a.gz", "late.gz"]
