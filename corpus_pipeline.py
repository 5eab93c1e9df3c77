"""A training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carestar.llm.bpe import bpe_digests
from carestar.llm.common import discard, written
from carestar.llm.exact_dedup import drop_exact_copies
from carestar.llm.jaccard_join import drop_near_copies
from carestar.llm.mixing import take_mix
from carestar.llm.quality_rules import filter_quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    return filter_quality(docs, "web-1")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the smallest id."""
    return drop_near_copies(docs, words=5, threshold=(80, 100))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return take_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of a round trip."""
    return bpe_digests(docs, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing", mixing),
    ("byte-level BPE", byte_bpe),
]

# Token ids are beyond SQL; tests/llm compares run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it, and then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        last, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            discard(last)
    return STAGES[-1][1](spark, docs, sf_dir)
