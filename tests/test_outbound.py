"""Outbound files: header drift on real CSV files, identity matching, value
policies, row counts and id overlap."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import outbound as O
from sluice.rules import rules_frame

from conftest import rows
from test_candidates import rule

COLS = ["PracticeID", "TaxIDNumber", "BillingLocationID", "DataSource"]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("outbound") / "out" / "practice"
    d.mkdir(parents=True)
    w = lambda name, data: (d / name).write_bytes(data)
    w("a_part1.csv", "﻿PracticeID,TaxIDNumber,BillingLocationID,DataSource\n"
      "00012,8.41E+08,0034,auto\n99,1,2,manual\n".encode())
    w("a_part2.csv", b" billinglocationid ,DATASOURCE,PracticeID,TaxIDNumber\n34,manual,12,x\n7,AUTO,5,b\xff\n")
    w("a_part3.csv", b"PracticeID,BillingLocationID\n5,7\n")      # no DataSource column
    w("a_part4.csv", b"")                                             # empty file
    return str(d)


def test_read_outbound_resolves_headers_per_file(spark, files):
    df = O.read_outbound(spark, files, COLS)
    got = rows(df.select(F.substring_index("file_path", "/", -1).alias("f"), *COLS,
                         F.array_join("missing_columns", ",").alias("m")))
    assert got == [
        ("a_part1.csv", "00012", "8.41E+08", "0034", "auto", ""),
        ("a_part1.csv", "99", "1", "2", "manual", ""),
        ("a_part2.csv", "12", "x", "34", "manual", ""),
        ("a_part2.csv", "5", "b�", "7", "AUTO", ""),
        ("a_part3.csv", "5", None, "7", None, "TaxIDNumber,DataSource"),
    ]


def test_header_only_files_count_as_checked(spark, files, tmp_path):
    import shutil
    d = tmp_path / "out" / "practice"
    d.mkdir(parents=True)
    for f in os.listdir(files):
        shutil.copy(os.path.join(files, f), d / f)
    (d / "a_part5.csv").write_bytes(b"PracticeID,BillingLocationID,DataSource\n")      # header only
    rows_df, files_df = O.read_outbound_files(spark, str(d), COLS)
    got = rows(files_df.select(F.substring_index("file_path", "/", -1).alias("f"),
                               F.array_join("missing_columns", ",").alias("m")))
    assert got == [("a_part1.csv", ""), ("a_part2.csv", ""), ("a_part3.csv", "TaxIDNumber,DataSource"),
                   ("a_part5.csv", "TaxIDNumber")]
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "outbound_prefix": "out/practice/"})
    relabel = F.concat(F.lit("s3://bkt/out/practice/"), F.substring_index("file_path", "/", -1))
    m = O.match_outbound(_cands(spark), rows_df.withColumn("file_path", relabel), [r], rules_frame(spark, [r]), "bkt",
                         files=files_df.withColumn("file_path", relabel)).first()
    assert m["n_files_checked"] == 4


def test_odd_names_quoted_headers_and_line_breaks(spark, tmp_path):
    d = tmp_path / "odd names"
    d.mkdir()
    for name in ("a b.csv", "a[1].csv", "a{x}+y.csv", "a%20c.csv"):
        (d / name).write_text('"Practice,ID","Data Source"\r\n12,"auto\nmatic"\r\n"1,3",x\r\n')
    got = rows(O.read_outbound(spark, str(d), ["practice,id", "Data Source", "Missing"]).select(
        F.substring_index("file_path", "/", -1).alias("f"), "row_no", "practice,id", "Data Source", F.array_join("missing_columns", ";").alias("m")))
    assert got == [(f, n, a, b, "Missing") for f in sorted(["a b.csv", "a[1].csv", "a{x}+y.csv", "a%20c.csv"])
                   for n, a, b in ((1, "12", "auto\nmatic"), (2, "1,3", "x"))]


def test_local_files_stand_for_a_bucket(spark, files):
    root = os.path.dirname(os.path.dirname(files))
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "outbound_prefix": "out/practice/"})
    df = O.rule_files(O.read_outbound(spark, files, COLS), rules_frame(spark, [r]), "bkt", root=root)
    assert df.count() == 5 and {x["rule_key"] for x in df.collect()} == {"k"}


def _cands(spark):
    return spark.createDataFrame([("k", 12, 34), ("k", 5, 7), ("k", 1, 1)],
                                 "rule_key string, PracticeID long, LocationID long")


def test_match_any_vs_all(spark, files):
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "outbound_prefix": "out/practice/", "outbound_expected_value": "Auto"})
    rules = rules_frame(spark, [r])
    ob = O.read_outbound(spark, files, COLS).withColumn(
        "file_path", F.concat(F.lit("s3://bkt/out/practice/"), F.substring_index("file_path", "/", -1)))
    any_ = {(x["PracticeID"], x["LocationID"]): x for x in
            O.match_outbound(_cands(spark), ob, [r], rules, "bkt", "any").collect()}
    # (12, 34) is in part1 (zero-padded) with auto and in part2 with manual.
    assert any_[("12", "34")]["files_matched"] == 2 and any_[("12", "34")]["n_files_checked"] == 3
    assert any_[("12", "34")]["verdict"] == "FAIL" and any_[("12", "34")]["reason"] == "unexpected value in a matched file"
    # (5, 7) is in part2 (AUTO) and in part3, which lacks the value column.
    assert any_[("5", "7")]["reason"] == "value column missing from a matched file"
    assert any_[("1", "1")]["reason"] == "record not found in any outbound file"
    one_file = ob.where(~F.col("file_path").endswith("part2.csv"))
    a = {(x["PracticeID"]): x for x in O.match_outbound(_cands(spark), one_file, [r], rules, "bkt", "any").collect()}
    assert a["12"]["verdict"] == "PASS"
    b = {(x["PracticeID"]): x for x in O.match_outbound(_cands(spark), one_file, [r], rules, "bkt", "all").collect()}
    assert b["12"]["verdict"] == "PASS" and b["12"]["value_all"] is True
    with pytest.raises(ValueError):
        O.match_outbound(_cands(spark), ob, [r], rules, "bkt", "some")


def test_first_rows_and_row_reconciliation(spark):
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "outbound_prefix": "o/"})
    rules = rules_frame(spark, [r])
    ob = spark.createDataFrame([(f"s3://b/o/f{i % 2}.csv", i, "r1", "12", "34", "auto") for i in range(9)],
                               "file_path string, row_no long, run_id string, PracticeID string, "
                               "BillingLocationID string, DataSource string")
    cands = spark.createDataFrame([("k", 12, 34)], "rule_key string, PracticeID long, LocationID long")
    first = rows(O.first_matching_rows(cands, ob, [r], rules, "b", 3), "file_path", "rank", "row_no")
    assert first == [("s3://b/o/f0.csv", 1, 0), ("s3://b/o/f0.csv", 2, 2), ("s3://b/o/f0.csv", 3, 4),
                     ("s3://b/o/f1.csv", 1, 1), ("s3://b/o/f1.csv", 2, 3), ("s3://b/o/f1.csv", 3, 5)]
    rep = spark.createDataFrame([("r1", 9), ("r2", 1), ("r3", None)], "run_id string, records_to_s3 long")
    got = rows(O.reconcile_rows(ob, rep), "run_id", "file_rows", "reported_rows", "verdict")
    assert got == [("r1", 9, 9, "PASS"), ("r2", 0, 1, "FAIL"), ("r3", 0, None, "SKIPPED")]
    assert rows(O.reconcile_rows(ob, rep, enforce=False), "run_id", "verdict")[1] == ("r2", "WARN")


def test_each_run_answers_for_its_own_files(spark):
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "outbound_prefix": "o/", "outbound_expected_value": "auto"})
    rules = rules_frame(spark, [r])
    ob = spark.createDataFrame([("s3://b/o/f1.csv", 1, "12", "34", "auto"), ("s3://b/o/f2.csv", 1, "12", "34", "manual"),
                                ("s3://b/o/f2.csv", 2, "7", "8", "auto")],
                               "file_path string, row_no long, PracticeID string, BillingLocationID string, DataSource string"
                               ).withColumn("missing_columns", F.array().cast("array<string>"))
    own = spark.createDataFrame([("k", "A", "s3://b/o/f1.csv"), ("k", "B", "s3://b/o/f2.csv")], "rule_key string, file_set string, file_path string")
    cands = spark.createDataFrame([("k", "A", 12, 34), ("k", "B", 12, 34), ("k", "A", 7, 8), ("k", "B", 7, 8), ("k", "C", 7, 8)],
                                  "rule_key string, file_set string, PracticeID long, LocationID long")
    got = rows(O.match_outbound(cands, ob, [r], rules, "b", own=own), "file_set", "PracticeID", "n_files_checked", "verdict", "reason")
    assert got == [("A", "12", 1, "PASS", None), ("A", "7", 1, "FAIL", "record not found in any outbound file"),
                   ("B", "12", 1, "FAIL", "unexpected value in a matched file"), ("B", "7", 1, "PASS", None),
                   ("C", "7", 0, "FAIL", "no outbound files were checked")]


def test_id_overlap(spark):
    src = spark.createDataFrame([("001",), ("2",), ("3",), ("3",)], "id string")
    out = spark.createDataFrame([("1",), ("2",), ("4",), ("5",)], "id string")
    r = O.id_overlap(src, out).first()
    assert (r["n_source"], r["n_output"], r["n_common"]) == (3, 4, 2)
    assert (r["overlap_pct_text"], r["diff_pct_text"], r["status"]) == ("66.7%", "33.3%", "FAIL")
    same = O.id_overlap(src, src).first()
    assert (same["overlap_pct_text"], same["status"]) == ("100.0%", "PASS")


def test_first_rows_read_the_orders_once(spark):
    """The final plan works on the stored relevant rows, not on the view again."""
    from sluice.plans import driver

    plan = driver.q_outbound_first3(spark, "/root/testdata/sf0.001")
    assert not [f for f in plan.inputFiles() if "/orders.parquet" in f or "/lineitem.parquet" in f]
