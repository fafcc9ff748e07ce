"""Deal rows to tasks by what they weigh, not by how many they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Groups in which running sums are made side by side; their totals are all that the driver sees.
PARTS = 256


def part_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def weigh(rows: DataFrame, key: str, **sums: Column) -> dict[str, list[int]]:
    """Each of ``sums`` added up for each of the ``PARTS`` groups of ``key``; one pass for all of them."""
    found = rows.groupBy(part_of(key).alias("_part")).agg(*(F.sum(c).cast("bigint").alias(n) for n, c in sums.items()))
    totals = {name: [0] * PARTS for name in sums}
    for r in found.collect():
        for name in sums:
            totals[name][r["_part"]] = r[name] or 0
    return totals


def packed(rows: DataFrame, key: str, weight: Column, totals: list[int], tasks: int) -> DataFrame:
    """``rows`` in ``tasks`` partitions of about equal ``weight``: none has more than its share plus one row.

    ``totals`` are the weights of :func:`weigh`. Rows are laid end to end in the order of group and key, and cut at equal
    distances. Rows of the same key and weight are alike, so a repeated task packs the same.
    """
    share = max(-(-sum(totals) // tasks), 1)
    starts = [sum(totals[:i]) for i in range(PARTS)]
    before = Window.partitionBy("_part").orderBy(key, "_weight").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumns({"_part": part_of(key), "_weight": weight})
    first = F.element_at(F.lit(starts).cast("array<bigint>"), F.col("_part") + 1) + F.coalesce(F.sum("_weight").over(before), F.lit(0))
    laid = laid.withColumn("_task", F.least(F.floor(first / share), F.lit(tasks - 1)).cast("int"))
    return laid.repartitionById(tasks, "_task").select(*rows.columns)
