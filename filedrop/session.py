"""Session helpers: settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Fixed value: the longest method, in bytes of bytecode, that the JVM compiles by default.
JIT_METHOD_BYTES = 8000


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators count on: run dates, hours and log times are UTC.

    A wide layout makes one long generated method, which the JVM would only interpret; beyond its limit Spark is
    told to fall back to split methods, about 1.6 times as fast for 100 fields.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_BYTES))
    return spark


def qualify(spark: SparkSession, root: str) -> str:
    """One meaning for a folder: the URI that Spark's own default file system gives it.

    A path without a scheme would otherwise be Spark's shared store in one place and each machine's own disk in another.
    Machine-local folders are refused unless the master is local, or they lie below ``spark.checkpoint.dir``: that one is
    shared, as a mounted folder if it is a ``file:`` path.
    """
    found = _with_scheme(spark, root)
    if found.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        shared = spark.conf.get("spark.checkpoint.dir", None)
        home = _with_scheme(spark, shared).rstrip("/") + "/" if shared else None
        if home is None or not (found + "/").startswith(home) or ".." in found.split("/"):
            raise ValueError(f"{root} is a folder of each machine's own; name one that all executors share")
    return found


def _with_scheme(spark: SparkSession, root: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") or "/")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="filedrop-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/filedrop/{tag}-{uuid.uuid4().hex}"


def ensure_parallelism(df, minimum: int | None = None):
    """Spread a frame with fewer partitions than cores before CPU-heavy Python work.

    At scale a scan already has more partitions than cores and this adds no shuffle.
    """
    wanted = minimum or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
