"""Documents made ready for training: a stage for each operator, from raw rows to packed sequences.

Each stage takes what its predecessor kept. All but the last return the
columns of ``documents``; the last returns token pieces with their place in
the training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm.common import table
from lodestar.llm.decontaminate import remove_documents
from lodestar.llm.exact_dedup import drop_duplicates
from lodestar.llm.jaccard_join import drop_near_duplicates
from lodestar.llm.language import keep_identified
from lodestar.llm.packing import pack
from lodestar.llm.queries import TOKENIZER
from lodestar.scratch import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are in."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_duplicates(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar texts (5-word shingles, 0.8 or more), the document with the smallest id."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return remove_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4096."""
    return pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL cannot learn the languages; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
