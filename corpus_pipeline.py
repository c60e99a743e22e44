"""From raw documents to training sequences: quality rules, language, near-duplicates, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from crimestats.llm import byte_language, host_quality, ngram_join, sentence_pieces, source_mix
from crimestats.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their host's verdict reject go."""
    return host_quality.filter_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go."""
    return byte_language.filter_documents(docs, byte_language.train(byte_language.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a 5-gram Jaccard similarity of 0.8 or more, the document with the smallest id stays."""
    return ngram_join.one_per_group(docs, ngram_join.NEAR)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeated by epochs, a last fractional one by weighted sampling."""
    return source_mix.mix_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    return sentence_pieces.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding", encoding),
]

#: Two stages are trained or encode by a vocabulary: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over documents; each result is a table in the shared checkpoint folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
