"""Connected components of a table of links, by rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filedrop.llm.text import forget, written


def _flat(hang: DataFrame) -> DataFrame:
    """``node, root`` with every node below the end of its path; each step doubles what a node looks ahead."""
    while True:
        above = hang.select(F.col("node").alias("root"), F.col("root").alias("next"))
        further = written(
            hang.select("node", "root").join(above, "root").select(
                "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
            ), "hang",
        )
        forget(hang)
        hang = further
        if hang.filter("moved").isEmpty():
            return hang


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: each linked node and the smallest node it is connected to.

    In each round every node hangs below its smallest neighbour, if that is smaller; paths are followed to their ends,
    doubling; and what is left of the links are those between different ends. A node that neither hangs nor has another
    hung below it hangs in the round after, so two rounds leave at most half of the nodes: rounds, and steps within a
    round, grow with the logarithm of the nodes, for chains as for hubs. The neighbours of a hub are merged before they
    are exchanged, and the joins have two written tables, so Spark can split its rows. Without links the result is empty.
    """
    one, other = F.col(a), F.col(b)
    pairs = links.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))
    edges = written(pairs.filter("a < b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        hang = ends.groupBy("node").agg(F.min("other").alias("other"))
        hang = _flat(written(hang.select("node", F.least("node", "other").alias("root")), "hang"))
        rounds.append(hang)
        end = lambda side: hang.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        half = written(edges.join(end("a"), "a").select("a_root", "b"), "half-links")
        apart = half.join(end("b"), "b").filter("a_root <> b_root")
        left = written(
            apart.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct(), "links"
        )
        forget(edges, half)
        edges = left
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[0]
    for later in rounds[1:]:
        above = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        further = written(
            roots.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots"
        )
        forget(roots, later)
        roots = further
    return roots.select("node", "root")
