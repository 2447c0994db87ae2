"""Sinks, the JSON indent helper and the log-file choice."""

import datetime as dt
import json
import os

import pytest

from sluice.functions.udfs import json_indent
from sluice.operators import logs as L
from sluice.sources import sinks

from conftest import rows

T = dt.datetime


def test_write_results_and_raise(spark, scratch):
    df = spark.createDataFrame([("r1", "PASS"), ("r2", "FAIL")], "rule_key string, verdict string")
    path = os.path.join(scratch, "verdicts")
    sinks.write_results(df, path)
    assert {"_SUCCESS", "rule_key=r1", "rule_key=r2"} <= set(os.listdir(path))
    assert rows(spark.read.parquet(path), "rule_key", "verdict") == [("r1", "PASS"), ("r2", "FAIL")]
    with pytest.raises(sinks.ValidationFailed, match="1 check"):
        sinks.raise_if_failed(df)
    sinks.raise_if_failed(df.where("verdict = 'PASS'"))


def test_json_indent(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [1]}',), ("{bad",), ("text",), (None,)], "v string")
    got = [r["j"] for r in df.select(json_indent("v").alias("j")).collect()]
    assert got == [json.dumps({"b": 1, "a": [1]}, indent=2), "{bad", "text", None]


def test_newest_log_files(spark):
    listing = spark.createDataFrame([
        ("logs/output.logs", 10, T(2024, 1, 5)),              # generic, dir 0, pattern 2
        ("logs/run-r1.log", 10, T(2024, 1, 1)),               # run r1, dir 0, pattern 0
        ("logs/run-r2.log", 0, T(2024, 1, 9)),                # empty: never chosen
        ("results/run-r2.log", 10, T(2024, 1, 2)),            # run r2 in dir 1: dir 0 generic wins
        ("logs/output1.log", 10, T(2024, 1, 7)),              # generic, dir 0, pattern 1 (newer, earlier pattern)
    ], "path string, size long, modified_at timestamp")
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run_id string")
    got = rows(L.newest_log_files(listing, runs, ["logs", "results"], ["*{run_id}*", "output*.log", "output.logs"],
                                  r"run-(r\d+)"), "run_id", "path")
    assert got == [("r1", "logs/run-r1.log"), ("r2", "logs/output1.log"), ("r3", "logs/output1.log")]


def test_materialized_tables_can_be_released(spark):
    import os

    from sluice.session import _tables_folder, materialize, release_tables

    df = materialize(spark.range(5), "five")
    folder = _tables_folder(spark).replace("file:", "")
    assert df.count() == 5 and os.listdir(folder)
    release_tables(spark)
    assert not os.path.exists(folder)
