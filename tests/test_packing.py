import random

import pytest
from pyspark.sql import functions as F

from filedrop.operators.packing import packed, weigh


def loads(df, columns="path, length"):
    """Rows of each task, by its number."""
    found = df.withColumn("task", F.spark_partition_id()).collect()
    out = {}
    for r in found:
        out.setdefault(r["task"], []).append((r["path"], r["length"]))
    return out


@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_no_task_exceeds_its_share_and_the_largest_file(spark, tasks):
    rng = random.Random(3)
    rows = [(f"big{i}", 10_000_000 + i) for i in range(4)] + [(f"small{i}", rng.randint(0, 2000)) for i in range(1000)]
    rows += [("small1", 5)] * 50
    files = spark.createDataFrame(rows, "path string, length bigint").repartition(5)
    weight = F.col("length") + 100
    totals = weigh(files, "path", weight=weight)["weight"]
    assert sum(totals) == sum(x + 100 for _, x in rows)
    df = packed(files, "path", weight, totals, tasks)
    assert df.rdd.getNumPartitions() == tasks and df.columns == ["path", "length"]
    got = loads(df)
    assert sorted(r for part in got.values() for r in part) == sorted(rows)
    share = -(-sum(totals) // tasks)
    for part in got.values():
        own = [x + 100 for _, x in part]
        assert sum(own) <= share + max(own)
    # Large files are apart where there are tasks enough.
    if tasks == 40:
        assert max(sum(p.startswith("big") for p, _ in part) for part in got.values()) == 1
    assert {t: sorted(p) for t, p in loads(packed(files, "path", weight, totals, tasks)).items()} == {
        t: sorted(p) for t, p in got.items()}


def test_nothing_and_rows_without_weight(spark):
    none = spark.createDataFrame([], "path string, length bigint")
    totals = weigh(none, "path", weight=F.col("length"), n=F.lit(1))
    assert sum(totals["weight"]) == 0 == sum(totals["n"])
    assert packed(none, "path", F.col("length"), totals["weight"], 1).count() == 0
    rows = spark.createDataFrame([("a", 0), (None, 0), ("b", 0)], "path string, length bigint")
    totals = weigh(rows, "path", weight=F.col("length"))["weight"]
    assert packed(rows, "path", F.col("length"), totals, 3).count() == 3
