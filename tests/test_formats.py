import datetime as dt
import random
import time

from pyspark.sql import functions as F

from filedrop.functions import formats

UNITS = ["Bytes", "KB", "MB", "GB", "TB"]


def readable(n):
    """Division and rounding as plain Python does them."""
    x = n
    for unit in UNITS:
        if x < 1024:
            return f"{x:.2f} {unit}"
        x /= 1024
    return f"{x:.2f} PB"


def test_sizes_equal_python_rounding(frame):
    rng = random.Random(7)
    sizes = [0, 1, 1023, 1024, 1152, 1024**2 - 1, 1024**5, 3 * 1024**5 + 1, 10**18]
    sizes += [1024**k * j // 200 for k in range(1, 6) for j in range(1, 400)]
    sizes += [rng.randrange(0, 1 << rng.randrange(1, 60)) for _ in range(3000)]
    rows = frame([(s,) for s in sizes], "n bigint").select("n", formats.format_size("n").alias("t")).collect()
    assert [r for r in rows if r["t"] != readable(r["n"])] == []
    assert frame([(None,)], "n bigint").select(formats.format_size("n").alias("t")).first()["t"] is None


def test_elapsed_equals_gmtime(frame):
    seconds = [0, 59, 60, 3599, 3600, 86399, 86400, 123456789]
    rows = frame([(float(s) + 0.9,) for s in seconds], "s double").select(
        "s", formats.format_elapsed("s").alias("t")
    ).collect()
    assert all(r["t"] == time.strftime("%H:%M:%S", time.gmtime(r["s"])) for r in rows)


def test_slots_are_utc():
    paris = dt.timezone(dt.timedelta(hours=2))
    assert formats.run_slot(dt.datetime(2024, 1, 1, 0, 30, tzinfo=paris)) == ("20231231", "22")
    assert formats.run_slot(dt.datetime(2024, 1, 1, 5, 0)) == ("20240101", "05")


def test_paths(frame):
    row = frame([("raw/a/n.gz", "20240115", "07", "2024-01-15 07:05:09")], "p string, d string, h string, s string")
    got = row.select(
        formats.dated_destination("B/", "p", "d", "h").alias("dated"),
        formats.hive_destination("B/", "p", "d", "h").alias("hive"),
        formats.flat_destination("B/", "p").alias("flat"),
        formats.output_location("T/", "d", "h").alias("out"),
        formats.log_path(F.lit("RDZ"), "s").alias("log"),
    ).first()
    assert got["dated"] == "B/2024/20240115/07/n.gz"
    assert got["hive"] == "B/year=2024/month=01/day=15/hour=07/n.gz"
    assert got["flat"] == "B/n.gz"
    assert got["out"] == "T/date=20240115/hour=07/"
    assert got["log"] == "LOGS/RDZ/20240115070509/"
