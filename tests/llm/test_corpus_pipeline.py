"""The pipeline stage by stage on a small table with edge rows."""

import re

import pandas as pd
import pytest

import corpus_pipeline as C
from sluice.llm import secretscan
from sluice.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    first = docs.iloc[0]
    more = pd.DataFrame([(10_001, first.text, "en", "s", 1), (10_002, None, None, None, None), (10_003, "", "en", "s", 0), (0, first.text, "en", "s", 1)], columns=docs.columns)
    both = pd.concat([docs, more], ignore_index=True)
    both["doc_id"] = both["doc_id"].astype("int64")
    both["n_chars"] = both["n_chars"].astype("Int64")
    both["_quality"] = 1
    both.to_parquet(d / "documents.parquet")
    pd.read_parquet(f"{SF}/labels.parquet").to_parquet(d / "labels.parquet")
    return str(d)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.toPandas()
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, folder), name)
        after = docs.toPandas()
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
            assert set(after["doc_id"]) <= set(before["doc_id"]) and len(after) > 0.6 * len(before)
        if name in ("quality_classifier", "language_id"):
            assert len(after) < len(before) or name == "language_id"
            assert 10_002 not in set(after["doc_id"]) or name == "quality_classifier"
        elif name == "ngram_jaccard_join":
            assert 10_001 not in set(after["doc_id"]) and (after["doc_id"] == 0).sum() == 1
            assert not after["text"].duplicated().any()
        elif name == "secret_scans":
            assert len(after) == len(before)
            assert not any(secretscan.base_spans(re.sub(r"\[SECRET\]", " ", t)) for t in after["text"] if t)
            assert (after["n_chars"] == after["text"].str.len()).all()
        elif name == "best_fit_packing":
            assert set(after["doc_id"]) == set(before["doc_id"])
            assert after.groupby("sequence_id")["length"].sum().max() <= 2048
        before = after


def test_empty_documents_pass_through(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
