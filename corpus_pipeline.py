"""A corpus from raw documents to a mix: quality, near-duplicates, benchmark leaks, personal data, source weights.

Each stage takes the documents that the one before kept, with all their columns, and is written before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from filedrop.llm.decontamination import remove_leaks
from filedrop.llm.disclosure import sanitise
from filedrop.llm.mixing import mix, taken_texts
from filedrop.llm.near_duplicates import keep_first
from filedrop.llm.quality_cnn import ACCEPT, fit, with_score
from filedrop.llm.text import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on labelled rows among the stage's documents."""
    net = fit(docs, table(spark, sf_dir, "labels"))
    name = "_quality_score"
    while name in docs.columns:
        name = f"_{name}"
    return with_score(docs, net, name).filter(F.col(name) >= ACCEPT).select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def _measured(changed: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it generalised or removed; ``n_chars`` follows the text."""
    return _measured(sanitise(docs), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of the mix: a row for each whole pass over a document, and one for the blocks that are taken of it besides.

    ``text`` holds the words that are taken and no others, ``taken`` of them; ``size`` is that of the whole document,
    ``source_size, target`` are its source's. ``n_chars`` follows the text.
    """
    return _measured(taken_texts(mix(docs, keep=tuple(docs.columns), spans=True)), docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", sanitised),
    ("source_mixing", mixed),
]

#: No SQL: the first stage is a trained network.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
