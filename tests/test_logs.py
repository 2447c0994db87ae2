"""Run-log reading, source choice, parsing and verdicts."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import logs as L
from sluice.rules import rules_frame

from conftest import rows
from test_candidates import rule

CAPS_DDL = ("run_id string, source string, file_name string, modified_at timestamp, line_no long, "
            "message string, declared_stream string")
U1 = "11111111-2222-3333-4444-555555555555"
U2 = "aaaaaaaa-2222-3333-4444-555555555555"


def caps(spark, lines):
    return spark.createDataFrame([(r, s, f, None, i, m, d) for i, (r, s, f, m, d) in enumerate(lines)], CAPS_DDL)


def test_read_log_files_lossy_utf8(spark, scratch):
    p = os.path.join(scratch, "output-jr_1.log")
    with open(p, "wb") as fh:
        fh.write(b"INFO start\nbad \xff byte\nChunk 1 written to s3://b/k/x.csv\n")
    df = L.read_log_files(spark, p, run_id_pattern=r"(jr_\d+)")
    got = [r["message"] for r in df.orderBy("line_no").collect()]
    assert got == ["INFO start", "bad � byte", "Chunk 1 written to s3://b/k/x.csv"]
    assert df.select("run_id").distinct().first()["run_id"] == "jr_1"


def test_events_to_captures_splits_multiline(spark):
    ev = spark.createDataFrame([("r1", 1, "a\nb"), ("r1", 2, "c")], "run_id string, line_no long, message string")
    got = [r["message"] for r in L.events_to_captures(ev).orderBy("line_no").collect()]
    assert got == ["a", "b", "c"]


def test_line_order_holds_in_late_partitions(spark):
    # ids of partition 1,100 and up are beyond 2^43; order must not be arithmetic on them
    ev = spark.range(3000, numPartitions=1200).selectExpr("'r1' AS run_id", "concat('m', id, '\\nsecond') AS message")
    got = [r["message"] for r in L.events_to_captures(ev).orderBy("line_no").collect()]
    assert got == [x for k in range(3000) for x in (f"m{k}", "second")]


def test_newest_log_file_fits_the_whole_pattern(spark):
    import datetime as dt

    listing = spark.createDataFrame([("/d/junk-jr_1.tmp", 5, dt.datetime(2024, 1, 9)), ("/d/output-jr_1-a.log", 5, dt.datetime(2024, 1, 2)),
                                     ("/d/output-jr_1-b.log", 5, dt.datetime(2024, 1, 2)), ("/d/output-jrX1-c.log", 5, dt.datetime(2024, 1, 5))],
                                    "path string, size long, modified_at timestamp")
    runs = spark.createDataFrame([("jr_1",), ("jr_2",)], "run_id string")
    got = rows(L.newest_log_files(listing, runs, ["/d"], ["output-{run_id}-*.log"], r"(jr.\d+)"), "run_id", "path")
    assert got == [("jr_1", "/d/output-jr_1-b.log"), ("jr_2", None)]


def test_log_verdict_scans_the_lines_twice(spark):
    import contextlib
    import io

    c = caps(spark, [("r1", "api", None, "AppliedRule=15 rule_count=3", None)])
    summary, facts = picked(c)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        L.run_report(summary, facts).explain()
    assert "Expand" not in out.getvalue()


def test_pick_source_order_and_ownership(spark):
    chunk = "Chunk 1 written to s3://b/out/x.csv"
    c = caps(spark, [
        ("r1", "api", None, "no sentinel", None),
        ("r1", "manager", None, chunk, None),                       # used; text lacks run id
        ("r2", "api", None, chunk + " r2", None),
        ("r3", "file", "r3.log", chunk, None),                       # file name proves ownership
        ("r4", "file", "x.log", chunk, "r5"),                        # declared stream mismatch
        ("r5", "file", "y.log", chunk, "r5"),
    ])
    got = rows(L.pick_source(L.log_summary(c)), "run_id", "source", "run_verified", "failures", "state")
    assert got == [
        ("r1", "manager", False, "api: no completion line", "OK"),
        ("r2", "api", True, "", "OK"),
        ("r3", "file", True, "api: no lines; manager: no lines", "OK"),
        ("r4", None, False, "api: no lines; manager: no lines; file: declared stream 'r5' is not run 'r4'", "FAIL"),
        ("r5", "file", True, "api: no lines; manager: no lines", "OK"),
    ]
    only_file = rows(L.pick_source(L.log_summary(c), mode="file"), "run_id", "source", "failures")
    assert [r for r in only_file if r[0] == "r1"] == [("r1", None, "file: no lines")]
    with pytest.raises(ValueError):
        L.pick_source(L.log_summary(c), mode="cloud")


def picked(captures):
    """(summary, facts) of the chosen sources."""
    summary, facts = L.scan_logs(captures)
    picks = L.pick_source(summary)
    return L.picked(summary, picks), L.picked(facts, picks)


def test_parse_report_artifacts_and_verdict(spark):
    lines = [
        ("r1", "api", None, "AppliedRule=rule-15 rule_count=2", None),
        ("r1", "api", None, "AppliedRule=15 rule_count=3", None),                # the last count wins, whatever the spelling
        ("r1", "api", None, "AppliedRule=15 done", None),                        # a line without a count leaves it
        ("r1", "api", None, "records_to_s3=5", None),
        ("r1", "api", None, f"Chunk 1 written to s3://out/out/practice/p_{U1}_1.csv", None),
        ("r1", "api", None, f"Chunk 1 written to s3://out/out/practice/p_{U1}_1.csv", None),   # repeated
        ("r1", "api", None, f"Chunk 2 written to s3://out/out/practice/p_{U1}_2.csv", None),
        ("r1", "api", None, "ERROR something broke", None),
        ("r2", "api", None, "AppliedRule=15 rule_count=0", None),
        ("r2", "api", None, f"Chunk 1 written to s3://out/out/practice/p_{U1}.csv", None),
        ("r2", "api", None, f"Chunk 2 written to s3://out//out/practice/p_{U2}.csv", None),
        ("r3", "api", None, "AppliedRule=15 rule_count=4", None),
        ("r3", "api", None, "records_to_s3=4", None),
        ("r3", "api", None, f"Chunk 1 written to s3://other/out/practice/p_{U1}.csv", None),
    ]
    summary, facts = picked(caps(spark, lines))
    rep = {r["run_id"]: r for r in L.run_report(summary, facts).collect()}
    assert (rep["r1"]["records_to_s3"], rep["r1"]["total_chunks"], rep["r1"]["n_artifacts"],
            rep["r1"]["error_lines"]) == (5, 3, 2, 1)
    assert rep["r1"]["first_error"] == "ERROR something broke"
    rc = rows(L.rule_counts(facts), "run_id", "applied_rule", "rule_count")
    assert ("r1", "rule-15", 2) in rc and ("r1", "15", 3) in rc
    arts = rows(L.log_artifacts(facts), "run_id", "chunk", "filename", "process_id")
    assert ("r1", 1, f"p_{U1}_1.csv", U1) in arts and len([a for a in arts if a[0] == "r1"]) == 2

    rl = [rule("r15")]
    rules = rules_frame(spark, rl)
    runs = spark.createDataFrame([("r1", "practice", "SUCCEEDED", None), ("r2", "practice", "SUCCEEDED", None),
                                  ("r3", "practice", "SUCCEEDED", None)],
                                 "run_id string, flow_name string, state string, started_at timestamp")
    ents = L.artifacts_by_rule(L.log_artifacts(facts), runs, rules.withColumn(
        "outbound_prefix", F.lit("out/practice/")), "out")
    pid = L.process_id_check(ents, runs, rules)
    v = rows(L.log_verdict(spark, runs, L.run_report(summary, facts), L.rule_counts(facts), pid, rules, rl),
             "run_id", "verdict", "reason")
    assert v == [("r1", "PASS", None), ("r2", "FAIL", "rule_count below 1"),
                 ("r3", "FAIL", "artifact bucket is not the configured bucket")]

    counts = spark.createDataFrame([("r15", 3)], "rule_key string, candidate_count long")
    strict = rows(L.reconcile_counts(spark, runs, L.rule_counts(facts), counts, rules, rl, enforce=True),
                  "run_id", "log_count", "verdict")
    assert strict == [("r1", 3, "PASS"), ("r2", 0, "FAIL"), ("r3", 4, "FAIL")]
    lax = rows(L.reconcile_counts(spark, runs, L.rule_counts(facts), counts, rules, rl, enforce=False),
               "run_id", "verdict")
    assert lax[2] == ("r3", "WARN")
    delta = rows(L.reconcile_counts(spark, runs, L.rule_counts(facts), counts, rules, rl, full_scan=False),
                 "run_id", "verdict")
    assert delta[2] == ("r3", "SKIPPED")


def test_process_ids_must_be_unique(spark):
    lines = [("r1", "api", None, f"Chunk 1 written to s3://out/o/p_{U1}.csv", None),
             ("r1", "api", None, f"Chunk 2 written to s3://out/o/p_{U2}.csv", None),
             ("r2", "api", None, "Chunk 1 written to s3://out/o/p_batch.csv", None)]
    _, facts = picked(caps(spark, lines))
    rl = [rule("k")]
    rules = rules_frame(spark, rl).withColumn("outbound_prefix", F.lit("o/"))
    runs = spark.createDataFrame([("r1", "practice"), ("r2", "practice"), ("r3", "practice")],
                                 "run_id string, flow_name string").withColumn("state", F.lit("SUCCEEDED")) \
        .withColumn("started_at", F.lit(None).cast("timestamp"))
    pid = rows(L.process_id_check(L.artifacts_by_rule(L.log_artifacts(facts), runs, rules, "out"), runs, rules),
               "run_id", "n_process_ids", "reason")
    assert pid == [("r1", 2, "more than one process UUID"), ("r2", 0, "no process UUID in the output file names"),
                   ("r3", 0, "no output file under the rule prefix")]


def test_incremental_watermark(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-02-01 00:00:00",)], "t string") \
        .select(F.to_timestamp("t").alias("t"))
    assert L.incremental(df, "t", "9999-12-31").count() == 2
    assert L.incremental(df, "t", "2024-01-15 00:00:00").count() == 1


def test_picking_a_source_sorts_no_lines(spark):
    """Lines are counted by hashing; only the counts may be sorted."""
    from sluice.operators import logs as lg

    lines = spark.createDataFrame(
        [("jr_1", "file", "f.log", k, "Chunk 1 written to s3://b/k", name) for k, name in enumerate(["jr_2", " jr_1 ", "jr_0", None, "jr_2"])]
        + [("jr_1", "api", None, 9, "ERROR b", None), ("jr_1", "api", None, 3, "ERROR a", None), (None, "api", None, 1, "x", None)],
        "run_id string, source string, file_name string, line_no long, message string, declared_stream string")
    summary = lg.log_summary(lines)
    got = {(r["run_id"], r["source"]): r.asDict() for r in summary.collect()}
    assert {k: (v["n_lines"], v["wrong_stream"], v["stream_ok"], v["first_error"], v["total_chunks"], v["error_lines"]) for k, v in got.items()} == {
        ("jr_1", "file"): (5, "jr_0", True, None, 5, 0), ("jr_1", "api"): (2, None, False, "ERROR a", 0, 2), (None, "api"): (1, None, False, None, 0, 0)}
    plan = lg.pick_source(summary)._jdf.queryExecution().executedPlan().toString()
    assert plan.rfind("SortAggregate") < plan.rfind("HashAggregate")      # the lines themselves go into a hashed one
