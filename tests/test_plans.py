import datetime as dt
import os

from filedrop.plans import apply, moves
from filedrop.sources import storage

A = "R520000120240115120000"


def test_unreadable_names_stay_unless_asked(frame):
    df = frame([(f"raw/{A}.gz",), ("raw/bad.gz",)], "file_key string")
    got = {r["source"]: tuple(r)[1:] for r in moves.quarantine_plan(df, "E/").collect()}
    assert got == {
        f"raw/{A}.gz": (f"E/2024/20240115/12/{A}.gz", "move", "quarantine"),
        "raw/bad.gz": (None, "none", "unparseable"),
    }
    flat = {r["source"]: tuple(r)[1:] for r in moves.quarantine_plan(df, "E/", flat_unreadable=True).collect()}
    assert flat["raw/bad.gz"] == ("E/bad.gz", "move", "unparseable")


def test_archive_skips_empty_keys(frame):
    df = frame([("a.gz", "", "20240115", "12"), ("b.gz", "b_END", "20240115", "12")],
               "gz_key string, end_key string, transaction_date string, transaction_hour string")
    assert sorted(r["source"] for r in moves.archive_plan(df).collect()) == ["a.gz", "b.gz", "b_END"]


def test_copy_marks_shared_destinations(frame):
    df = frame([("s/a.gz",), ("s/x/a.gz",), ("s/b.gz",), ("other/b.gz",)], "path string")
    got = {r["source"]: (r["destination"], r["action"], r["reason"]) for r in moves.copy_plan(df, "s/", "t/").collect()}
    assert got == {
        "s/a.gz": ("t/a.gz", "copy", "duplicate"), "s/x/a.gz": ("t/a.gz", "copy", "duplicate"),
        "s/b.gz": ("t/b.gz", "copy", "copy"),
    }


def test_first_plan_wins_but_none_beats_no_move(frame):
    schema = "source string, destination string, action string, reason string"
    merged = moves.merge_plans(
        frame([("a", None, "none", "one")], schema),
        frame([("a", "x", "move", "two"), ("b", "y", "move", "two")], schema),
    )
    assert {r["source"]: r["reason"] for r in merged.collect()} == {"a": "two", "b": "two"}
    both = moves.merge_plans(frame([("a", "x", "move", "one")], schema), frame([("a", "y", "move", "two")], schema))
    assert both.first()["reason"] == "one"


def test_no_two_sources_share_a_destination(frame):
    rows = [(f"raw/{i}/n.gz", "E/n.gz", "move", "") for i in range(5)] + [("raw/m", "E/m", "move", ""), ("raw/o", None, "none", "")]
    plan = moves.unique_destinations(frame(rows, "source string, destination string, action string, reason string"))
    got = {r["source"]: r["destination"] for r in plan.collect()}
    assert got["raw/0/n.gz"] == "E/n.gz" and got["raw/m"] == "E/m" and got["raw/o"] is None
    assert len({got[f"raw/{i}/n.gz"] for i in range(5)}) == 5 and len(got) == 7


def run(spark, rows, out, **kw):
    schema = "source string, destination string, action string, reason string"
    if rows and len(rows[0]) > 4:
        schema += ", length bigint, modificationTime timestamp"
    plan = spark.createDataFrame(rows, schema)
    return {r["source"]: (r["status"], r["detail"]) for r in apply.apply_plan(plan, str(out), **kw).collect()}


def test_moves_copies_and_repeats(spark, tmp_path):
    root = tmp_path / "store"
    root.mkdir()
    for name in ("a", "b", "zero"):
        (root / name).write_bytes(b"" if name == "zero" else name.encode())
    rows = [("a", "to/a", "move", ""), ("b", "to/b", "copy", ""), ("zero", "to/zero", "move", ""),
            ("gone", "to/gone", "move", ""), ("bad", None, "none", "unparseable")]
    first = run(spark, rows, tmp_path / "o1", root=str(root))
    assert first == {"a": ("done", None), "b": ("done", None), "zero": ("done", None),
                     "gone": ("failed", "source not found"), "bad": ("skipped", "unparseable")}
    assert sorted(os.listdir(root)) == ["b", "to"] and sorted(os.listdir(root / "to")) == ["a", "b", "zero"]
    # Without the listed version nothing tells whether the target is that file.
    second = run(spark, rows, tmp_path / "o2", root=str(root))
    assert second["a"] == ("failed", "source not found") and second["b"] == ("done", None)
    since = dt.datetime(2024, 1, 1)
    third = run(spark, [(*rows[0], 1, since), (*rows[2], 7, since)], tmp_path / "o3", root=str(root))
    assert third == {"a": ("done", "moved before"), "zero": ("failed", "source not found")}
    late = run(spark, [(*rows[0], 1, dt.datetime(2999, 1, 1))], tmp_path / "o4", root=str(root))
    assert late["a"] == ("failed", "source not found")
    assert (root / "to" / "a").read_bytes() == b"a"


def test_a_newer_delivery_is_kept_beside_the_archived_file(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a").write_bytes(b"old")
    (tmp_path / "a").write_bytes(b"new")
    os.utime(tmp_path / "a", (1000, 1000))
    got = run(spark, [(str(tmp_path / "a"), str(tmp_path / "t" / "a"), "move", "")], tmp_path / "o")
    assert got[str(tmp_path / "a")][0] == "done" and "a.1000000" in got[str(tmp_path / "a")][1]
    assert (tmp_path / "t" / "a").read_bytes() == b"old" and not (tmp_path / "a").exists()
    assert (tmp_path / "t" / "a.1000000").read_bytes() == b"new"
    # The same bytes again need no second copy.
    (tmp_path / "a").write_bytes(b"old")
    assert run(spark, [(str(tmp_path / "a"), str(tmp_path / "t" / "a"), "move", "")], tmp_path / "o2")[
        str(tmp_path / "a")] == ("done", None)
    assert sorted(os.listdir(tmp_path / "t")) == ["a", "a.1000000"]


def test_a_replaced_source_stays(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"longer")
    row = (str(tmp_path / "a"), str(tmp_path / "t" / "a"), "move", "", 3, dt.datetime(2024, 1, 1))
    assert run(spark, [row], tmp_path / "o")[row[0]] == ("failed", "source was replaced after it was listed")
    assert (tmp_path / "a").exists()


def test_odd_keys_are_plain_paths_and_errors_are_outcomes(spark, tmp_path):
    names = ["R520.gz ", "a b.gz", "50%20.gz", "q?x#y.gz", "ü.gz"]
    for n in names:
        (tmp_path / n).write_bytes(n.encode())
    rows = [(f"file:{tmp_path}/{n}", f"file://{tmp_path}/to/{n}", "move", "") for n in names]
    rows += [("s3x://nowhere/R520.gz ", "s3x://nowhere/b", "move", ""), ("a", None, "move", "")]
    got = run(spark, rows, tmp_path / "o", retries=1, root=str(tmp_path))
    assert [got[r[0]][0] for r in rows] == ["done"] * len(names) + ["failed", "failed"]
    assert sorted(os.listdir(tmp_path / "to")) == sorted(names)
    assert storage.resolve(f"file://{tmp_path}/a b")[1] == f"{tmp_path}/a b"


def test_the_source_stays_when_the_copy_fails(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    (tmp_path / "blocked").write_bytes(b"a file where a folder is needed")
    got = run(spark, [(str(tmp_path / "a"), str(tmp_path / "blocked" / "a"), "move", "")], tmp_path / "o", retries=2)
    assert got[str(tmp_path / "a")][0] == "failed" and (tmp_path / "a").exists()


def test_moves_are_spread_over_tasks(spark, tmp_path):
    rows = []
    for i in range(40):
        (tmp_path / f"f{i}").write_bytes(b"x")
        rows.append((str(tmp_path / f"f{i}"), str(tmp_path / "to" / f"f{i}"), "move", ""))
    assert set(run(spark, rows, tmp_path / "o").values()) == {("done", None)}
    assert len([f for f in os.listdir(tmp_path / "o") if f.endswith(".parquet")]) > 1
