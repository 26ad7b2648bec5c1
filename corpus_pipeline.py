"""A training corpus from ``documents``: quality, exact copies, near copies,
mix of sources, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; all but the last return the columns of ``docs``. Between stages the rows
are written as Parquet and read again, so a lost executor never costs more
than one stage. Null and repeated rows, empty texts and empty tables are
treated as each stage's operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact_dedup, pu_quality, sentencepiece_codec, simhash_dedup, source_mixing
from ledgerline.llm.common import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return pu_quality.good_rows(docs, pu_quality.train(docs, labels))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.distinct_rows(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return simhash_dedup.representatives(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return source_mixing.mixed_rows(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return sentencepiece_codec.encode(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("SimHash near-dedup", unlike_documents),
    ("mixing sources to target weights", mixed_documents),
    ("SentencePiece encoding", encoded_documents),
]

ORACLE_SQL = None  # a classifier and a tokenizer have no SQL; tests hold brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else stored(docs, f"pipeline-{i}"), sf_dir)
    return docs
