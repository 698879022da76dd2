"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from recomart.llm import bpe, mixing, secret_scan, simhash, toxicity
from recomart.llm.queries import table, vocab_path
from recomart.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain rejects go. NULL and empty texts have no feature and stay; repeated rows
    share their fate; without labels of both kinds nothing goes."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest id; texts without words (NULL, empty)
    are one group."""
    return simhash.drop_near_copies(docs, shingle=3, max_bits=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets found are masked in the text; no document goes, and all other columns keep their values (so
    ``n_chars`` still tells the length before masking). NULL texts stay NULL."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (up to three rows, or none), in the order of the queue.
    Documents without words are never taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text; NULL and empty texts have none."""
    return bpe.encode(docs, vocab_path())


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("secrets", mask_secrets),
          ("mixing", mix_sources), ("bpe", encode)]

#: SQL can express neither the classifier, the fingerprints, the credential links nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; every stage's result is written to the checkpoint folder and reread."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
