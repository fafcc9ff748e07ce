"""All queries of the subpackage, entered by the modules of its operators, and the pipeline."""

import corpus_pipeline
from filedrop.llm import (  # noqa: F401
    decontamination, disclosure, hard_negatives, lattice_lm, mixing, near_duplicates, periodic_runs,
    quality_cnn, repetition, shingle_join, toxicity, url_rules, warc,
)
from filedrop.llm.registry import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
