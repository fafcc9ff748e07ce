"""One job over all files against one job per file from ten threads: ``compare_per_file.py [sf_dir]``.

Both forms use the library's own job; the script checks that they write the same rows and prints the times.
"""

import os
import sys
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import bench  # noqa: E402
from filedrop import jobs  # noqa: E402
from filedrop.session import new_scratch, prepare  # noqa: E402
from filedrop.sinks.tables import materialise, read_records  # noqa: E402
from filedrop.sources.manifest import read_manifest  # noqa: E402
from workload import fixtures as fx  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = prepare(
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = bench.write_record_files(spark, sf_dir)
    listed = materialise(read_manifest(spark, folder), new_scratch(spark, "compare"))
    paths = [r["path"] for r in listed.select("path").collect()]

    def append(files, table):
        jobs.parse_and_append(files, fx.LAYOUT, fx.AS_OF, table, "r")
        return read_records(spark, table, fx.LAYOUT)

    def apart():
        # Parallel appends to one folder remove each other's temporary files, so each file gets a table of its own.
        with ThreadPoolExecutor(10) as pool:
            tables = list(pool.map(
                lambda path: append(listed.filter(F.col("path") == path), new_scratch(spark, "apart")), paths
            ))
        return tables

    jobs_by_name = {"one job": lambda: [append(listed, new_scratch(spark, "together"))], "per file": apart}
    rows = {}
    for name, run in jobs_by_name.items():
        run()
        start = time.perf_counter()
        tables = run()
        print(f"{name}: {time.perf_counter() - start:.2f} s for {len(paths)} files")
        rows[name] = sum(t.count() for t in tables)
    print("same number of rows:", len(set(rows.values())) == 1, rows)


if __name__ == "__main__":
    main()
