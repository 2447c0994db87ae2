"""Registered queries of the training-data operators (thin: production
parameters, whole tables).  Those that SQL can express have an oracle in
``oracles``; all are tested against a brute-force version in ``tests/llm``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    bpe, fingerprints, hardneg, idfiles, langid, lexical, oracles, packing, quality, rulecascade, secretscan, setjoin, topk, toxicity)
from sluice.llm.text import crc_bucket
from sluice.session import checkpoint_dir, ship_package


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def prepare(spark: SparkSession) -> None:
    """Arrow batches of bounded size, and the package on every executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.similar_sets(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.find_secrets(table(spark, sf_dir, "documents")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_bucket("doc_id", 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model, limits = langid.train(docs, crc_bucket("doc_id", 5) != 0)
    return langid.identify(docs.drop("lang"), model, limits).select(
        "doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), crc_bucket("doc_id", 4) != 2)
    return quality.score(docs, model).select(
        "doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = checkpoint_dir(spark).rstrip("/") + f"/token-files/{uuid.uuid4().hex[:12]}"
    idfiles.write_ids(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    return idfiles.read_ids(spark, folder)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", label))


def op13_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulecascade.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", *rulecascade.BASE, "base_failed", "kept")


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_jaccard_join, op3_secrets, op4_best_fit_packing, op5_bpe, op6_toxicity, op7_language_id, op8_quality, op9_token_files,
    op10_top_k, op11_lexical_search, op12_hard_negatives, op13_rule_cascade)}
ORACLE: dict[str, str] = oracles.ORACLE
