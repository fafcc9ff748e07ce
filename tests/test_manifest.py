import datetime as dt
import os
import tracemalloc
import types

import pytest
from pyspark.sql import functions as F

from filedrop.sources import manifest as m
from filedrop.sources.binary import scan_binary

UTC = dt.timezone.utc
AS_OF = dt.datetime(2024, 1, 15, 13, 0, tzinfo=UTC)


def make_tree(root):
    names = ["a.gz", "a_END", "_hidden.gz", ".dot", "x/b.gz", "x/b_END", "x/y/c.gz", "z/d_END"]
    for i, name in enumerate(names):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name.endswith("_END") else b"q" * (i + 1))
    return names


def test_listing_sees_every_file_at_any_split_depth(spark, tmp_path):
    names = make_tree(tmp_path)
    for depth in (0, 1, 2, 5):
        rows = m.read_manifest(spark, str(tmp_path), depth).collect()
        assert sorted(r["path"][len(str(tmp_path)) + 1:] for r in rows) == sorted(names)
        assert {r["length"] for r in rows if r["path"].endswith("_END")} == {0}
    path = next(r for r in rows if r["path"].endswith("a.gz"))
    assert abs(path["modificationTime"].replace(tzinfo=UTC).timestamp() - os.stat(tmp_path / "a.gz").st_mtime) < 1


def test_listing_an_empty_folder(spark, tmp_path):
    assert m.read_manifest(spark, str(tmp_path)).isEmpty()


def test_listing_splits_by_folder(spark, tmp_path):
    make_tree(tmp_path)
    assert m.read_manifest(spark, f"file:{tmp_path}", 1).rdd.getNumPartitions() == 3


def test_many_folders_share_tasks(spark, tmp_path, monkeypatch):
    for i in range(12):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "f").write_bytes(b"x")
    monkeypatch.setattr(m, "MAX_LISTING_TASKS", 5)
    parts = m._folders(str(tmp_path), 1)
    assert len(parts) == 5 and len([f for p in parts for f in p.folders]) == 12
    rows = [r for p in parts for batch in m._list(p) for r in batch.column("path").to_pylist()]
    assert len(rows) == len(set(rows)) == 12


def test_a_flat_folder_is_shared_by_tasks_and_never_held(tmp_path, monkeypatch):
    (tmp_path / "sub").mkdir()
    for i in range(20_000):
        (tmp_path / f"f{i:05d}").touch()
    (tmp_path / "sub" / "g").write_bytes(b"x")
    monkeypatch.setattr(m, "FIRST_ENTRIES", 100)
    tracemalloc.start()
    parts = m._folders(str(tmp_path), 3)
    planned = tracemalloc.get_traced_memory()[1]
    assert len(parts) == m.FLAT_TASKS and planned < 1 << 20
    names, sizes = [], []
    for part in parts:
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        got = [p for p, _, _ in m._files(part)]
        assert tracemalloc.get_traced_memory()[1] - before < 1 << 20
        sizes.append(len(got))
        names += got
    tracemalloc.stop()
    assert len(names) == len(set(names)) == 20_001 and max(sizes) < 2 * 20_001 / m.FLAT_TASKS


def test_a_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="there is no folder"):
        m.read_manifest(spark, str(tmp_path / "none")).collect()


def test_what_is_wanted_reaches_the_listing(spark, tmp_path, monkeypatch):
    make_tree(tmp_path)
    os.utime(tmp_path / "x" / "b.gz", (AS_OF.timestamp(), AS_OF.timestamp()))
    home = f"{tmp_path}/"
    for given, want in [
        ({"prefix": "x/b"}, ["x/b.gz", "x/b_END"]),
        ({"prefix": f"file:{home}x"}, ["x/b.gz", "x/b_END", "x/y/c.gz"]),
        ({"prefix": "nowhere/"}, []),
        ({"prefix": "x", "suffixes": (".gz",)}, ["x/b.gz", "x/y/c.gz"]),
        ({"suffixes": ("d_END", "c.gz")}, ["x/y/c.gz", "z/d_END"]),
        ({"since": AS_OF, "until": AS_OF}, ["x/b.gz"]),
        ({"until": AS_OF - dt.timedelta(microseconds=1)}, []),
        ({"most": 0}, ["a_END", "x/b_END", "z/d_END"]),
        ({"least": 1, "most": 3}, ["_hidden.gz", "a.gz"]),
    ]:
        for depth in (0, 2):
            got = m.read_manifest(spark, str(tmp_path), depth, **given).collect()
            assert sorted(r["path"][len(home):] for r in got) == sorted(want), given
    parts = m._folders(str(tmp_path), 1, wanted=m.Wanted(f"{home}x/"))
    assert [f for p in parts for f in p.folders] == [(f"{home}x", True, (0, 1))]
    looked = []
    names = m.storage._local_entries
    monkeypatch.setattr(m.storage, "_local_entries", lambda uri, starts: (
        e._replace(stat=lambda e=e: looked.append(e.name) or e.stat()) for e in names(uri, starts)))
    part = m.Folders([(str(tmp_path), True, (0, 1))], wanted=m.Wanted(ends=("c.gz",)))
    assert [p for p, _, _ in m._files(part)] == [f"{home}x/y/c.gz"] and looked == ["c.gz"]


def test_a_store_is_read_page_by_page(monkeypatch):
    asked = []

    class Client:
        def get_paginator(self, call):
            return self

        def paginate(self, Bucket, Prefix, Delimiter):
            asked.append((Bucket, Prefix))
            keys = ["raw/", "raw/a.gz", "raw/b.gz", "raw/sub/c.gz"]
            for key in sorted(k for k in keys if k.startswith(Prefix)):
                rest = key[len(Prefix):]
                if Delimiter in rest:
                    yield {"CommonPrefixes": [{"Prefix": Prefix + rest.split(Delimiter)[0] + Delimiter}]}
                else:
                    yield {"Contents": [{"Key": key, "LastModified": AS_OF, "Size": len(key)}]}

    monkeypatch.setattr(m.storage, "boto3", types.SimpleNamespace(client=lambda service: Client()))
    every = [f for part in m._folders("s3a://bucket/raw", 1) for f in m._files(part)]
    micros = int(AS_OF.timestamp() * 1_000_000)
    assert sorted(every) == [(f"s3://bucket/raw/{k}", micros, len(f"raw/{k}")) for k in ("a.gz", "b.gz", "sub/c.gz")]
    asked.clear()
    wanted = m.Wanted("s3://bucket/raw/b")
    found = [p for part in m._folders("s3://bucket/raw", 1, wanted=wanted) for p, _, _ in m._files(part)]
    assert found == ["s3://bucket/raw/b.gz"] and set(asked) == {("bucket", "raw/b")}


def test_prefixes_are_spelled_like_listed_paths(spark, tmp_path):
    assert m.below("s3a://b/raw/", "202401/") == "s3://b/raw/202401/" == m.below("s3://b/raw", "s3n://b/raw/202401/")
    assert m.below("/raw", "") == "/raw/"
    make_tree(tmp_path)
    got = m.list_prefix(spark, f"file:{tmp_path}", "x/").collect()
    assert sorted(os.path.basename(r["path"]) for r in got) == ["b.gz", "b_END", "c.gz"]


def test_window_is_closed_at_both_ends(frame):
    second = dt.timedelta(seconds=1)
    times = [AS_OF, AS_OF - dt.timedelta(hours=1), AS_OF + second, AS_OF - dt.timedelta(hours=1) - second]
    df = frame([(f"{i}.gz", t, 1) for i, t in enumerate(times)], m.SCHEMA)
    assert sorted(r["path"] for r in m.recent_files(df, AS_OF).collect()) == ["0.gz", "1.gz"]


def test_type_suffix_and_size_filters(frame):
    rows = [("m/a.gz", AS_OF, 0), ("m/a_END", AS_OF, 0), ("m/", AS_OF, 0), ("n/b.gz", AS_OF, 5), ("m/c.txt", AS_OF, 1)]
    df = frame(rows, m.SCHEMA)
    assert m.drop_files(df).count() == 3
    assert sorted(r["path"] for r in m.with_prefix_and_suffix(df, "m/").collect()) == ["m/a.gz", "m/a_END"]
    assert [r["path"] for r in m.zero_size(df).collect()] == ["m/a.gz"]


def test_inventory_table_and_pushdown(spark, tmp_path):
    raw = spark.createDataFrame([("k.gz", "2024-01-15 12:30:00", "7")], "Key string, LastModified string, Size string")
    inventory = m.from_inventory(raw, "Key", "LastModified", "Size")
    inventory.write.parquet(str(tmp_path / "inv"))
    recent = m.recent_files(spark.read.parquet(str(tmp_path / "inv")), AS_OF)
    assert recent.count() == 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in plan and "LessThanOrEqual(modificationTime" in plan


def test_binary_scan_prunes_content_and_pushes_size(spark, tmp_path):
    make_tree(tmp_path)
    df = scan_binary(spark, [str(tmp_path / "x"), str(tmp_path / "z")])
    assert sorted(os.path.basename(r["path"]) for r in df.select("path").collect()) == ["b.gz", "c.gz"]
    plan = df.select("path").filter(F.col("length") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(length,5)" in plan and "content" not in plan.split("ReadSchema")[1]
