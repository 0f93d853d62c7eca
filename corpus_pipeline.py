"""Corpus pipeline: five of the training-data operators, one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return the
columns of ``documents``.  A stage sees exactly the rows that the one before it
kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlake.llm.common import stage, table
from martlake.llm.mixing import mixed_documents
from martlake.llm.near_dedup import drop_near_duplicates
from martlake.llm.pii import redact
from martlake.llm.piece_encoder import default_model, encode_documents
from martlake.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules and the isolation forest keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids of each row's text."""
    return encode_documents(docs, default_model(), ("n_tokens", "ids"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("private_data", private_data),
          ("mixing", mixing), ("encoding", encoding)]

ORACLE_SQL = None       # forests, sketches and tokenisers have no SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
