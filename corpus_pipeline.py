"""A corpus pipeline of five stages over ``documents``; each is written as Parquet and reread.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm import bpe, mixing, passages, setjoin, toxicity
from fleetlake.llm.common import Scratch, read_table

STAGES = [
    ("toxicity", toxicity.stage),
    ("ngram_jaccard_join", setjoin.stage),
    ("substring_dedup", passages.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

ORACLE_SQL = None  # block-max votes, chaining and BPE have no SQL; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch, docs = Scratch(spark, "pipeline"), read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
