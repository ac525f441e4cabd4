"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.llm import (
    bpe,
    html_text,
    infill,
    lines,
    minhash,
    mixing,
    pieces,
    quality,
    secrets,
    spelling,
    substrings,
    topk,
    vectors,
)
from tickhouse.llm.shared import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), *bpe.rank_file())


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.links(table(spark, sf_dir, "embeddings"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), pieces.model_file())


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_secrets, op2_topk, op3_mixing, op4_bpe, op5_vectors, op6_substrings,
              op7_quality, op8_minhash, op9_lines, op10_html, op11_pieces, op12_infill,
              op13_spelling)
}
