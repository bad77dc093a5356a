"""A training-corpus pipeline: every stage works on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, exact_dedup, order_minhash, toxicity
from tidemark.llm.common import shared_dir, table
from tidemark.llm.piece_codec import encode_decode
from tidemark.llm.queries import PIECE_MODEL


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier rejects go.  It learns from labelled documents that are not
    held out; without labels nothing is rejected."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space the longest, then the one of smallest id, stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of smallest id stays."""
    return order_minhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of ten words of a benchmark item (or a whole shorter item) occurs go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the documents that remain."""
    return encode_decode(docs, public_tokenizers.path(PIECE_MODEL))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("piece_codec", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = shared_dir(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


#: The classifier, the sketches and the encoder have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None
