"""A corpus pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``;
the last returns token ids in place of the text. Null and empty texts pass through
each stage by its own rule: the classifier scores them, line dedup and near-dedup
leave them, the mix reads them at no cost, and they encode to no token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import bpe, lines, minhash, mixing, quality
from tickhouse.llm.shared import store, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, trained on labels of these documents."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many share; n_chars follows the text."""
    return lines.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 of the five-word shingles or more."""
    return minhash.dedup(docs, limit=minhash.AT_80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each time that a document is read, in mixed order."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether they decode to its text."""
    return bpe.tokenised(docs, *bpe.rank_file())


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# A trained classifier, hash sketches and byte-pair merges are beyond SQL; the
# tests hold the stages against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
