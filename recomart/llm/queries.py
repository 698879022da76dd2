"""The ``opN_<name>`` queries over the driver tables, and the DuckDB SQL of those that SQL can express.

Each query applies one operator of this subpackage to its whole table and derives
the columns of its contract."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (bpe, crosspolytope, langid, lm, maxscore, mixing, packing, periodic, secret_scan, simhash, tokenalign,
               toxicity, warc)
from .common import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocab_path(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file; every worker has the package that holds them."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crosspolytope.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.withColumnRenamed("id", "vec_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return g.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = langid.train(docs, ~F.col("held_out"))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).withColumnRenamed("id", "page_id")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    scored = lm.score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2),
                      vocab_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return scored.withColumnRenamed("id", "doc_id")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), vocab_path()).withColumnRenamed("id", "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.train(docs, labels)
    return toxicity.score(docs.select("doc_id", "text"), chain).drop("text")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocab_path("word_bpe_49k.json"), capacity=2048)
    placed = packing.pack(cut, capacity=2048)
    return placed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = tokenalign.digest(table(spark, sf_dir, "documents"), vocab_path(), vocab_path("piece_bpe_32k.model"))
    return aligned.withColumnRenamed("id", "doc_id")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic.digest(periodic.runs(docs, least=6, times=4)).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_simhash, op3_language_id, op4_warc, op5_lm_score, op6_top_k,
                                   op7_secret_scan, op8_bpe, op9_toxicity, op10_mixing, op11_best_fit_packing,
                                   op12_token_alignment, op13_periodic_runs)}

ORACLES = {"op1_embedding_dedup": crosspolytope.ORACLE, "op4_warc": warc.ORACLE, "op6_top_k": maxscore.ORACLE,
           "op10_mixing": mixing.ORACLE, "op13_periodic_runs": periodic.ORACLE}
