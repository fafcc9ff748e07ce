"""Bounded samples of labelled rows for fitting classifiers. Bounds are parameters; everything else reads all data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filedrop.llm.text import in_remainder


def training_labels(labels: DataFrame, label: str, mod: int, rest: int) -> DataFrame:
    """``doc_id, label`` of labelled rows outside the held-out remainder; of several labels of a document the largest."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_remainder("doc_id", mod, rest))
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, rows: int, max_bytes: int
) -> list[tuple[str, int]]:
    """At most ``rows`` pairs of text and label, of at most ``max_bytes`` of text, in the order of a hash of the id.

    Sizes are looked up first, so no more than the bound ever reaches the driver. A text larger than what is left is
    passed over.
    """
    known = training_labels(labels, label, mod, rest)
    narrow = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("size"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sized = narrow.join(known, "doc_id").groupBy("doc_id").agg(F.min("size").alias("size"))
    chosen, left = [], max_bytes
    for row in sized.orderBy(*by_hash).limit(rows).collect():
        if row["size"] <= left:
            left -= row["size"]
            chosen.append((row["doc_id"],))
    if not chosen:
        return []
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id bigint")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    picked = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.octet_length("text")).alias("text"))
    found = picked.join(known, "doc_id").select("doc_id", "text", "label").collect()
    return [(r["text"], r["label"]) for r in sorted(found, key=lambda r: r["doc_id"])]
