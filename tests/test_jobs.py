import datetime as dt
import gzip
import os
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest

from filedrop import jobs
from filedrop.operators import claims
from filedrop.session import qualify
from filedrop.sinks import tables
from filedrop.sources import storage
from filedrop.sources.layout import Layout
from workload import fixtures

LAYOUT = Layout([("n", 1, 5)])
BASES = {s: f"R520{s}20240115120000" for s in ("0001", "0002", "0003", "0004", "0005")}


def body(*ns):
    return gzip.compress(b"".join(b"%05d" % n + b" " * 515 for n in ns))


def deliver(raw):
    raw.mkdir(parents=True)
    (raw / f"{BASES['0001']}.gz").write_bytes(body(1, 2, 3))
    (raw / f"{BASES['0001']}_END").write_bytes(b"")
    (raw / f"{BASES['0002']}.gz").write_bytes(body(4))
    (raw / f"{BASES['0003']}_END").write_bytes(b"")
    (raw / f"{BASES['0004']}.gz").write_bytes(body(5)[:-3])
    (raw / f"{BASES['0004']}_END").write_bytes(b"")
    (raw / "bad name.gz").write_bytes(body(6))
    (raw / "bad name_END").write_bytes(b"")
    old = raw / f"{BASES['0005']}.gz"
    old.write_bytes(body(7))
    os.utime(old, (0, 0))


def zones(tmp_path):
    return jobs.Zones(str(tmp_path / "raw"), str(tmp_path / "TDZ"), str(tmp_path / "backup") + "/",
                      str(tmp_path / "error") + "/", str(tmp_path / "LOGS"), str(tmp_path / "work"))


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs)


def now():
    return dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=1)


def test_hourly_run(spark, tmp_path):
    deliver(tmp_path / "raw")
    z = zones(tmp_path)
    got = {(r["stage"], r["status"]): r["n"] for r in jobs.hourly_run(spark, z, LAYOUT, now()).collect()}
    assert got == {
        ("names", "invalid"): 2, ("triage", "valid"): 2, ("triage", "unparseable"): 1, ("triage", "missing_end"): 1,
        ("triage", "missing_gz"): 1, ("parse", "ok"): 1, ("parse", "corrupt"): 1, ("records", "written"): 3,
        ("move", "done"): 6, ("move", "skipped"): 2,
    }
    assert tree(tmp_path / "backup") == [f"2024/20240115/12/{BASES['0001']}{x}" for x in (".gz", "_END")]
    assert tree(tmp_path / "error") == sorted(
        f"2024/20240115/12/{n}" for n in (f"{BASES['0002']}.gz", f"{BASES['0003']}_END", f"{BASES['0004']}.gz",
                                          f"{BASES['0004']}_END"))
    assert tree(tmp_path / "raw") == sorted(["bad name.gz", "bad name_END", f"{BASES['0005']}.gz"])
    assert sorted(r["n"] for r in tables.read_records(spark, z.table, LAYOUT).collect()) == ["00001", "00002", "00003"]
    log = tables.read_audit(spark, z.audit)
    assert {r["zone"] for r in log.collect()} == {"RDZ", "TDZ", "GLOBAL"}
    assert log.filter("level = 'ERROR' and message like 'cannot be decoded%'").count() == 1

    again = {(r["stage"], r["status"]): r["n"] for r in jobs.hourly_run(spark, z, LAYOUT, now()).collect()}
    assert again[("records", "written")] == 0 and ("triage", "valid") not in again
    assert tables.read_records(spark, z.table, LAYOUT).count() == 3
    assert log.sparkSession.read.schema(log.schema).parquet(z.audit).filter("level = 'WARNING'").count() == 1


def test_archiving_failed_files_too(spark, tmp_path):
    deliver(tmp_path / "raw")
    jobs.hourly_run(spark, zones(tmp_path), LAYOUT, now(), archive_failed=True)
    assert f"2024/20240115/12/{BASES['0004']}.gz" in tree(tmp_path / "backup")


def test_targeted_run(spark, tmp_path):
    deliver(tmp_path / "raw")
    (tmp_path / "raw" / f"{BASES['0003']}.gz").write_bytes(b"not gzip")
    got = {(r["grouping"], r["value"]): tuple(r)[2:5] for r in
           jobs.targeted_run(spark, zones(tmp_path), "20240115", "12").collect()}
    assert got == {
        ("date", "20240115"): (3, 2, 3), ("hour", "12"): (3, 2, 3),
        ("date", "Unknown"): (0, 0, 1), ("hour", "Unknown"): (0, 0, 1),
    }
    assert tree(tmp_path / "backup") == sorted(
        f"year=2024/month=01/day=15/hour=12/{BASES[s]}{x}" for s in ("0001", "0003") for x in (".gz", "_END"))
    assert "bad name.gz" in tree(tmp_path / "error") and tree(tmp_path / "raw") == []


def stages(df):
    return {(r["stage"], r["status"]): r["n"] for r in df.collect()}


def test_a_repeated_run_writes_no_record_twice(spark, tmp_path):
    """The archive is blocked in the first run: records are in the table, files are still in raw."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / f"{BASES['0001']}.gz").write_bytes(body(1, 2, 3))
    (raw / f"{BASES['0001']}_END").write_bytes(b"")
    (tmp_path / "backup").write_bytes(b"a file where a folder is needed")
    first = stages(jobs.hourly_run(spark, zones(tmp_path), LAYOUT, now()))
    assert first[("records", "written")] == 3 and first[("move", "failed")] == 2
    (tmp_path / "backup").rename(tmp_path / "blocked")
    second = stages(jobs.hourly_run(spark, zones(tmp_path), LAYOUT, now()))
    assert second[("records", "written")] == 0 and second[("move", "done")] == 2
    assert tables.read_records(spark, zones(tmp_path).table, LAYOUT).count() == 3 and tree(raw) == []
    # Another version under the same name is new.
    (raw / f"{BASES['0001']}.gz").write_bytes(body(8))
    (raw / f"{BASES['0001']}_END").write_bytes(b"")
    third = stages(jobs.hourly_run(spark, zones(tmp_path), LAYOUT, now()))
    assert third[("records", "written")] == 1 and third[("move", "done")] == 2
    kept = [n for n in tree(tmp_path / "backup") if ".gz" in n]
    assert len(kept) == 2


def test_every_file_has_one_route(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "z").mkdir(parents=True)
    for folder in (raw, raw / "z"):
        (folder / f"{BASES['0001']}.gz").write_bytes(body(1) if folder == raw else body(2, 3))
        (folder / f"{BASES['0001']}_END").write_bytes(b"")
    (raw / f"{BASES['0002']}.gz").write_bytes(body(4))
    (raw / f"{BASES['0002']}.gz_END").write_bytes(b"")  # the marker of a wide pair
    odd = "R520\u0661\u0661\u0661\u06612024011512000" + "0"
    (raw / f"{odd}.gz").write_bytes(body(5))
    (raw / f"{odd}_END").write_bytes(b"")
    for i, folder in enumerate(("p", "q")):
        (raw / folder).mkdir()
        (raw / folder / f"{BASES['0003']}.gz ").write_bytes(b"x" * (3 + 4 * i))
    before = set(tree(raw))
    z = zones(tmp_path)
    jobs.hourly_run(spark, z, LAYOUT, now())
    work = [d for d in os.listdir(z.work) if d.startswith("run-")]
    routes = spark.read.parquet(f"{z.work}/{work[0]}/moves").collect()
    assert sorted(os.path.relpath(r["source"], raw) for r in routes) == sorted(before)
    by_name = {os.path.relpath(r["source"], raw): (r["status"], r["reason"]) for r in routes}
    assert by_name[f"{BASES['0001']}.gz"] == ("skipped", "superseded") == by_name[f"{BASES['0001']}_END"]
    assert by_name[f"{BASES['0002']}.gz_END"] == ("done", "archive") == by_name[f"z/{BASES['0001']}.gz"]
    # A name that can be read but fails the check is quarantined and not parsed.
    assert by_name[f"{odd}.gz"] == ("done", "invalid_name")
    assert sorted(r["n"] for r in tables.read_records(spark, z.table, LAYOUT).collect()) == ["00002", "00003", "00004"]
    sizes = sorted(os.path.getsize(tmp_path / "error" / n) for n in tree(tmp_path / "error") if BASES["0003"] in n)
    assert sizes == [3, 7]
    assert tables.read_audit(spark, z.audit).filter("message like 'another copy was taken%'").count() == 2


def test_young_files_wait_for_their_partner(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    as_of = dt.datetime.now(dt.timezone.utc)
    minutes = lambda n: (as_of.timestamp() + 60 * n,) * 2
    for name, age in ((f"{BASES['0001']}.gz", -1), (f"{BASES['0002']}.gz", -30)):
        (raw / name).write_bytes(body(1))
        os.utime(raw / name, minutes(age))
    grace = dt.timedelta(minutes=10)
    got = stages(jobs.hourly_run(spark, zones(tmp_path), LAYOUT, as_of, grace=grace))
    assert got[("triage", "waiting")] == 1 and got[("triage", "missing_end")] == 1
    assert tree(raw) == [f"{BASES['0001']}.gz"]
    (raw / f"{BASES['0001']}_END").write_bytes(b"")
    os.utime(raw / f"{BASES['0001']}_END", minutes(1))
    again = stages(jobs.hourly_run(spark, zones(tmp_path), LAYOUT, as_of + dt.timedelta(hours=1), grace=grace))
    assert again[("triage", "valid")] == 1 and again[("move", "done")] == 2 and tree(raw) == []


def test_a_failing_run_leaves_its_audit(spark, tmp_path):
    deliver(tmp_path / "raw")
    (tmp_path / "TDZ").write_bytes(b"a file where a folder is needed")
    with pytest.raises(Exception):
        jobs.hourly_run(spark, zones(tmp_path), LAYOUT, now())
    log = tables.read_audit(spark, zones(tmp_path).audit)
    assert log.filter("level = 'CRITICAL' and message like 'run failed%'").count() == 1
    assert log.filter("message like 'pair accepted%'").count() == 2
    assert log.filter("level = 'INFO' and message like 'files 9, invalid_files 2,%'").count() == 1


def test_targeted_run_by_prefix_inventory_and_audit(spark, tmp_path):
    for spelling in ("202401/", "{raw}/202401/", "file:{raw}/202401/"):
        here = tmp_path / str(len(spelling))
        raw = here / "raw" / "202401"
        raw.mkdir(parents=True)
        for name in (f"{BASES['0001']}.gz", f"{BASES['0001']}_END"):
            (raw / name).write_bytes(body(1) if name.endswith("gz") else b"")
        (here / "raw" / f"{BASES['0002']}.gz").write_bytes(body(1))
        summary = jobs.targeted_run(
            spark, zones(here), "20240115", "12", prefix=spelling.format(raw=here / "raw"), as_of=now())
        assert {tuple(r)[:4] for r in summary.collect()} == {("date", "20240115", 1, 1), ("hour", "12", 1, 1)}
        assert tree(here / "raw") == [f"{BASES['0002']}.gz"]
        log = tables.read_audit(spark, zones(here).audit)
        assert log.filter("message like 'by date 20240115, total 1%'").count() == 1
        assert log.filter("message like 'moved: %'").count() == 2
    with pytest.raises(ValueError, match="not below"):
        jobs.targeted_run(spark, zones(here), "20240115", "12", prefix="/elsewhere/", as_of=now())
    rows = [(str(here / "raw" / f"{BASES['0002']}.gz"), dt.datetime.now(), 30)]
    inventory = spark.createDataFrame(rows, "path string, modificationTime timestamp, length bigint")
    summary = jobs.targeted_run(spark, zones(here), "20240115", "12", manifest=inventory, as_of=now())
    assert {tuple(r)[2:5] for r in summary.collect()} == {(0, 0, 1)}


def test_folders_mean_what_spark_says(spark, monkeypatch):
    assert qualify(spark, "/a/b/") == "file:/a/b"
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.defaultFS", "viewfs://pool/")
    hadoop.set("fs.viewfs.mounttable.pool.linkMergeSlash", "file:///tmp")
    try:
        assert qualify(spark, "/a/b") == "viewfs://pool/a/b"
    finally:
        hadoop.set("fs.defaultFS", "file:///")
    with monkeypatch.context() as m:
        m.setattr(spark.sparkContext, "master", "yarn")
        with pytest.raises(ValueError, match="share"):
            qualify(spark, "/a/b")


def test_folders_below_the_shared_one_are_shared(spark, monkeypatch):
    """On a cluster whose shared folder is mounted, a run may work below it, and nowhere else on a machine's disk."""
    shared = spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    assert qualify(spark, f"{shared}/run/TDZ") == qualify(spark, f"file://{shared}/run/TDZ/") == f"file:{shared}/run/TDZ"
    for other in ("/a/b", f"{shared}-2/run", f"{shared}/../run"):
        with pytest.raises(ValueError, match="machine's own"):
            qualify(spark, other)



def test_copies_of_one_name_are_all_copied(spark, tmp_path):
    for i, folder in enumerate(("a", "b")):
        (tmp_path / "raw" / folder).mkdir(parents=True)
        (tmp_path / "raw" / folder / "n.gz").write_bytes(b"x" * (i + 1))
    moved = jobs.copy_files(spark, str(tmp_path / "raw"), str(tmp_path / "to"), str(tmp_path / "outcome"))
    assert [r["status"] for r in moved.collect()] == ["done", "done"]
    assert sorted(os.path.getsize(tmp_path / "to" / n) for n in tree(tmp_path / "to")) == [1, 2]


def test_usual_folders():
    z = jobs.Zones.under("s3a://b", "s3a://b/work")
    assert (z.raw, z.table, z.archive) == ("s3a://b/RDZ/Raw-Data/", "s3a://b/TDZ", "s3a://b/RDZ/backup/")
    assert (z.quarantine, z.audit) == ("s3a://b/RDZ/error-files/", "s3a://b/LOGS")


def test_copy(spark, tmp_path):
    deliver(tmp_path / "raw")
    moved = jobs.copy_files(spark, str(tmp_path / "raw"), str(tmp_path / "to"), str(tmp_path / "outcome"))
    assert {r["status"] for r in moved.collect()} == {"done"}
    assert tree(tmp_path / "to") == tree(tmp_path / "raw")


def test_whole_record_round_trip_in_both_modes(spark, tmp_path):
    text = "héllo €" + "x" * 600
    rec = text.encode()[:520]
    df = spark.createDataFrame([("p", bytearray(gzip.compress(rec)))], "path string, content binary")
    layout = Layout([("a", 1, 7), ("b", 8, 3)])
    chars = jobs.parse_batch(df, layout, now()).first()
    bytes_ = jobs.parse_batch(df, layout, now(), mode="bytes").first()
    assert (chars["a"], chars["b"]) == (text[:7], text[7:10])
    assert (bytes_["a"], bytes_["b"]) == (rec[:7].decode("utf-8", "ignore"), rec[7:10].decode("utf-8", "ignore"))


HOUR = dt.timedelta(hours=1)


def test_a_run_inside_another_leaves_its_files_alone(spark, tmp_path, monkeypatch):
    """The second run begins after the first has listed and claimed, and ends before the first parses."""
    deliver(tmp_path / "raw")
    z, inner, parse = zones(tmp_path), {}, jobs.parse_and_append

    def parse_late(*args):
        monkeypatch.setattr(jobs, "parse_and_append", parse)
        (tmp_path / "raw" / f"{BASES['0005']}.gz").write_bytes(body(7, 8))
        (tmp_path / "raw" / f"{BASES['0005']}_END").write_bytes(b"")
        inner.update(stages(jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR)))
        return parse(*args)

    monkeypatch.setattr(jobs, "parse_and_append", parse_late)
    outer = stages(jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR))
    assert inner[("triage", "claimed")] == 5 and inner[("triage", "valid")] == 1 and inner[("records", "written")] == 2
    assert outer[("records", "written")] == 3 and ("triage", "claimed") not in outer and outer[("move", "done")] == 6
    got = sorted(r["n"] for r in tables.read_records(spark, z.table, LAYOUT).collect())
    assert got == ["00001", "00002", "00003", "00007", "00008"]
    assert tree(tmp_path / "raw") == ["bad name.gz", "bad name_END"]


def test_claims_of_a_failed_run_are_given_back_and_those_of_a_dead_one_end(spark, tmp_path, monkeypatch):
    raw, z = tmp_path / "raw", zones(tmp_path)
    raw.mkdir()
    (raw / f"{BASES['0001']}.gz").write_bytes(body(1, 2, 3))
    (raw / f"{BASES['0001']}_END").write_bytes(b"")

    def broken(*args):
        raise RuntimeError("no table")

    with monkeypatch.context() as m:
        m.setattr(jobs, "parse_and_append", broken)
        with pytest.raises(RuntimeError, match="no table"):
            jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR)
    assert tree(f"{z.work}/claims") == []
    with monkeypatch.context() as m:
        m.setattr(jobs, "parse_and_append", broken)
        m.setattr(jobs, "_give_back", lambda *args: None)  # as if the process had died
        with pytest.raises(RuntimeError):
            jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR)
    dead, = tree(f"{z.work}/claims")
    assert dead.endswith(".0")
    blocked = stages(jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR))
    assert blocked[("triage", "claimed")] == 1 and blocked[("records", "written")] == 0
    os.utime(f"{z.work}/claims/{dead}", (1, 1))
    after = stages(jobs.hourly_run(spark, z, LAYOUT, now(), lease=HOUR))
    assert after[("records", "written")] == 3 and after[("move", "done")] == 2 and tree(raw) == []
    assert sorted(tree(f"{z.work}/claims")) == sorted([dead, dead[:-1] + "1"])


def test_one_of_many_gets_a_claim(spark, tmp_path):
    keys = spark.createDataFrame([(f"{i:04d}",) for i in range(300)], "key string")
    folder = str(tmp_path / "claims")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda run: {r["key"] for r in claims.claim(keys, folder, run, HOUR).collect() if r["claimed"]}, "abcd"))
    assert sum(map(len, got)) == 300 and len(set().union(*got)) == 300
    # A task that is repeated finds its own claims.
    assert {r["key"] for r in claims.claim(keys, folder, "a", HOUR).collect() if r["claimed"]} == got[0]
    assert claims.release(keys, folder, "a") == len(got[0])
    assert claims.claim(keys, folder, "b", HOUR).filter("claimed").count() == len(got[0]) + len(got[1])
    with pytest.raises(NotImplementedError):
        storage.create_new("gs://bucket/claim", b"")


def test_contents_go_to_python_few_at_a_time(spark, tmp_path, monkeypatch):
    """Whole contents: small batches while they are parsed and written, and only then; a slice of a batch is packed at once."""
    files = spark.createDataFrame([(f"raw/{i}.gz", bytearray(body(i))) for i in range(3)], "path string, content binary")
    seen, default, write = [], spark.conf.get(tables.BATCH_ROWS), jobs.append_parsed

    def append(tagged, table):
        seen.append(int(spark.conf.get(tables.BATCH_ROWS)))
        write(tagged, table)

    monkeypatch.setattr(jobs, "append_parsed", append)
    assert jobs.parse_and_append(files, LAYOUT, now(), f"{tmp_path}/t", "r")["rows"] == 3
    assert seen[0] <= 500 and spark.conf.get(tables.BATCH_ROWS) == default
    texts = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(1000)], "body": [b"x"] * 1000, "how": ["plain"] * 1000})
    packed = list(fixtures._pack_texts([texts, texts.slice(0, 0)]))
    assert max(b.num_rows for b in packed) <= 256
    assert [p for b in packed for p in b.column("path").to_pylist()] == texts.column("path").to_pylist()
