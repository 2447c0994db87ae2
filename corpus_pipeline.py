"""Corpus pipeline: quality, language, near duplicates, secrets, packing.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes every
stage's result as Parquet in the shared folder and reads it again as the next
one's documents.  All stages but the last return the columns that they got.
Models are fitted on what the stage before kept, under the folds of the
queries.  Null texts count as empty; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, packing, quality, secretscan, setjoin
from sluice.llm.queries import prepare, tokenizer_path
from sluice.llm.text import crc_bucket, fresh
from sluice.session import materialize

#: Least quality score of a document that stays (the query's bound for good).
LEAST_QUALITY = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model finds good."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, crc_bucket("doc_id", 4) != 2)
    if model is None:     # nothing to learn from: nothing to reject
        return docs
    (name,) = fresh(docs, "_quality")
    return quality.score(docs, model, name=name).filter(F.col(name) >= LEAST_QUALITY).drop(name)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know."""
    prepare(spark)
    model, limits = langid.train(docs, crc_bucket("doc_id", 5) != 0)
    if not model.languages:
        return docs
    prefix = "_" * (1 + max(len(c) for c in docs.columns))     # no column has it
    return langid.identify(docs, model, limits, prefix=prefix).filter(~F.col(f"{prefix}rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that of the smallest id."""
    prepare(spark)
    return setjoin.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    prepare(spark)
    return secretscan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document with their sequence and place."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality_classifier", quality_classifier), ("language_id", language_id), ("ngram_jaccard_join", near_duplicates),
          ("secret_scans", secret_scan), ("best_fit_packing", best_fit_packing)]

#: The stages' models, patterns and packing are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
