import datetime as dt
import gzip
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from filedrop import jobs
from filedrop.operators import audit
from filedrop.sinks import tables
from filedrop.sources.layout import Layout

LAYOUT = Layout([("n", 1, 5), ("rest", 6, 515)])
AS_OF = dt.datetime(2024, 1, 15, 5, 0, tzinfo=dt.timezone.utc)


def contents(spark):
    def rec(*ns):
        return bytearray(gzip.compress(b"".join(b"%05d" % n + b" " * 515 for n in ns)))

    rows = [("a", rec(1, 2)), ("b", rec(3)), ("bad", bytearray(b"zzz")), ("none", bytearray(gzip.compress(b"")))]
    return spark.createDataFrame(rows, "path string, content binary")


def test_hour_stays_text_and_rows_are_counted(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.append_partitioned(jobs.parse_batch(contents(spark), LAYOUT, AS_OF), root) == 3
    assert tables.append_partitioned(jobs.parse_batch(contents(spark), LAYOUT, AS_OF), root) == 3
    back = tables.read_partitioned(spark, root, LAYOUT.table_schema)
    assert back.count() == 6 and {(r["date"], r["hour"]) for r in back.collect()} == {("20240115", "05")}
    assert (tmp_path / "t" / "date=20240115" / "hour=05").is_dir()


def test_records_and_outcomes_are_written_together(spark, tmp_path):
    root = str(tmp_path / "t")
    before = spark.conf.get(tables.WRITERS)
    assert jobs.parse_and_append(contents(spark), LAYOUT, AS_OF, root, "r1") == {"rows": 3, "files": 4, "files_ok": 2}
    assert spark.conf.get(tables.WRITERS) == before
    records = tables.read_records(spark, root, LAYOUT)
    assert records.columns == ["n", "rest", "date", "hour"]
    assert sorted(r["n"] for r in records.collect()) == ["00001", "00002", "00003"]
    outcomes = tables.read_outcomes(spark, root, LAYOUT, ("20240115", "05"), "r1")
    assert {r["path"]: (r["status"], r["n_records"]) for r in outcomes.collect()} == {
        "a": ("ok", 2), "b": ("ok", 1), "bad": ("corrupt", 0), "none": ("empty", 0),
    }
    jobs.parse_and_append(contents(spark), LAYOUT, AS_OF, root, "r2")
    assert tables.read_outcomes(spark, root, LAYOUT, run="r2").count() == 4
    checked = tables.reconcile(spark, root, LAYOUT, run="r1").collect()
    assert len(checked) == 4 and all(r["matches"] for r in checked)


def test_reconciling_finds_lost_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    jobs.parse_and_append(contents(spark), LAYOUT, AS_OF, root, "r1")
    kept = tables.read_records(spark, root, LAYOUT, lineage=True).filter("n <> '00002'")
    copy = str(tmp_path / "copy")
    kept.select("*", F.lit("record").alias("drop_kind")).write.partitionBy("drop_kind", "date", "hour").parquet(copy)
    outcomes = tables.read_outcomes(spark, root, LAYOUT).select(
        F.col("path").alias("drop_file"), F.col("status").alias("drop_status"),
        F.col("n_records").alias("drop_records"), F.col("run").alias("drop_run"), "date", "hour",
        F.lit("outcome").alias("drop_kind"),
    )
    outcomes.write.mode("append").partitionBy("drop_kind", "date", "hour").parquet(copy)
    bad = [r["path"] for r in tables.reconcile(spark, copy, LAYOUT).filter(~F.col("matches")).collect()]
    assert bad == ["a"]


def test_the_write_sorts_nothing(spark):
    """Run date and hour are constants, and both row kinds stay open in a task."""
    date = jobs.parse_batch(contents(spark), LAYOUT, AS_OF)
    plan = date._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("MapInArrow") == 1


def test_an_empty_batch_writes_an_empty_table(spark, tmp_path):
    root = str(tmp_path / "t")
    counts = jobs.parse_and_append(contents(spark).filter("path = 'x'"), LAYOUT, AS_OF, root, "r1")
    assert counts == {"rows": 0, "files": 0, "files_ok": 0}
    assert tables.read_records(spark, root, LAYOUT).isEmpty()


def test_audit_log_by_zone(spark, tmp_path):
    frame = spark.range(50).select(F.col("id").cast("string").alias("k"))
    rows = [audit.audit_rows(frame, zone, AS_OF, "INFO", F.col("k")) for zone in ("RDZ", "TDZ")]
    tables.append_audit(audit.union_audit(rows), str(tmp_path / "log"))
    back = tables.read_audit(spark, str(tmp_path / "log"))
    assert back.groupBy("zone", "log_date").count().count() == 2 and back.count() == 100
    assert back.columns[:3] == ["timestamp", "level", "message"]
    assert tables.preview(back).count() == 5


def test_appends_at_the_same_time_keep_apart(spark, tmp_path):
    root = str(tmp_path / "t")

    def append(i):
        rows = spark.range(i * 1000, i * 1000 + 1000, 1, 4 + i % 3).selectExpr("id", "'20240115' as date", f"'{i % 2:02}' as hour")
        return tables.append_partitioned(rows, root)

    with ThreadPoolExecutor(6) as pool:
        assert list(pool.map(append, range(12))) == [1000] * 12
    got = tables.read_partitioned(spark, root, "id bigint, date string, hour string")
    assert got.count() == got.select("id").distinct().count() == 12_000
    assert os.listdir(f"{root}/_temporary") == []
