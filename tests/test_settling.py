import datetime as dt
import random

from filedrop.sources.manifest import SCHEMA
from filedrop.streaming import settling
from filedrop.streaming.settling import RESULT, settle_stream, statuses, write_settled

T0 = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
GRACE = dt.timedelta(minutes=10)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def run(spark, tmp_path, rows):
    folder = f"{tmp_path}/in"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    settled = settle_stream(spark.readStream.schema(SCHEMA).parquet(folder), GRACE)
    write_settled(settled, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    out = spark.read.schema(RESULT).parquet(f"{tmp_path}/out")
    listed = spark.read.schema(SCHEMA).parquet(folder)
    return out, sorted((r["path"], r["status"], r["partner"]) for r in statuses(listed, out).collect())


def test_every_file_leaves_once(spark, tmp_path):
    """A pair leaves when complete, a lone file at its timer, a file behind the clock as late."""
    _, got = run(spark, tmp_path, [
        ("a.gz", at(58), 1), ("b.gz", at(0), 1), ("c_END", at(50), 0), ("d.gz", at(1), 2), ("d_END", at(40), 0), ("note.txt", at(1), 1),
    ])
    assert got == [("a.gz", "waiting", None), ("b.gz", "missing_end", None), ("c_END", "waiting", None),
                   ("d.gz", "paired", "d_END"), ("d_END", "paired", "d.gz")]
    _, got = run(spark, tmp_path, [("a_END", at(62), 0), ("b_END", at(3), 0), ("e.gz", at(55), None), ("x/e.gz", at(56), 3)])
    assert got == [("a.gz", "paired", "a_END"), ("a_END", "paired", "a.gz"), ("b.gz", "missing_end", None), ("b_END", "late", None),
                   ("c_END", "missing_gz", None), ("d.gz", "paired", "d_END"), ("d_END", "paired", "d.gz"),
                   ("e.gz", "superseded", None), ("x/e.gz", "waiting", None)]
    out, got = run(spark, tmp_path, [("e_END", at(2), 0), ("z.gz", at(90), 1)])
    # A late file that somebody waits for makes a pair.
    assert ("e_END", "paired", "x/e.gz") in got and ("x/e.gz", "paired", "e_END") in got and ("z.gz", "waiting", None) in got
    assert out.count() == len(got) - 1


def test_three_runs_equal_a_model(spark, tmp_path):
    rng = random.Random(4)
    runs, files = [[], [], []], {}
    for i in range(400):
        for suffix in (".gz", "_END"):
            if rng.random() < 0.85:
                t = rng.randrange(300)
                k = min(2, max(0, t // 100 + rng.choice([0, 0, 0, 1])))
                runs[k].append((f"raw/R{i}{suffix}", at(t + rng.random() / 2), 1))
    want, waiting, clock = {}, {}, None
    for rows in runs:
        arrived = {}
        for path, time, _ in rows:
            arrived.setdefault(path.removesuffix(".gz").removesuffix("_END"), []).append((path, time))
        for base, found in arrived.items():
            found = waiting.pop(base, []) + found
            if len(found) == 2:
                want |= {path: "paired" for path, _ in found}
            elif clock is not None and found[0][1] + GRACE < clock:
                want[found[0][0]] = "late"
            else:
                waiting[base] = found
        clock = max([t for _, t, _ in rows] + [clock or T0])
        for base, [(path, time)] in list(waiting.items()):
            if time + GRACE < clock:
                want[path] = "missing_end" if path.endswith(".gz") else "missing_gz"
                del waiting[base]
        _, got = run(spark, tmp_path, rows)
        assert {p: s for p, s, _ in got} == want | {p: "waiting" for [(p, _)] in waiting.values()}
    assert {s: list(want.values()).count(s) > 5 for s in want.values()} == {
        s: True for s in ("paired", "late", "missing_end", "missing_gz")}


def test_bases_share_state_and_a_timer(spark, tmp_path, monkeypatch):
    """All bases in one group: its timer goes on from file to file, and what waits does not make a state for each base."""
    monkeypatch.setattr(settling, "BUCKETS", 1)
    _, got = run(spark, tmp_path, [(f"f{i:02}.gz", at(i), i) for i in range(40)] + [("f05_END", at(39), 0)])
    assert [s for _, s, _ in got] == ["missing_end"] * 5 + ["paired"] * 2 + ["missing_end"] * 24 + ["waiting"] * 10
    later = spark.createDataFrame([("f35_END", at(45), 0), ("x/f36.gz", at(46), 0), ("f02_END", at(2), 0)], SCHEMA)
    later.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    settled = settle_stream(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), GRACE)
    query = write_settled(settled, f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) < 10
    out = spark.read.schema(RESULT).parquet(f"{tmp_path}/out")
    got = {r["path"]: r["status"] for r in out.collect()}
    assert out.count() == len(got) and "x/f36.gz" not in got and "f37.gz" not in got
    assert [got.get(p) for p in ("f02.gz", "f02_END", "f30.gz", "f35.gz", "f35_END", "f36.gz")] == [
        "missing_end", "late", "missing_end", "paired", "paired", "superseded"]
