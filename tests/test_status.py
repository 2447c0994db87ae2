"""Split validation, error enrichment and terminal state on literal rows."""

import pytest

from sluice.operators import status as S

from conftest import rows

STATUS_DDL = ("id long, process_id string, sub_process_name string, status string, entity_name string, "
              "business_value string, error string, payload_response_id string, notes string")


@pytest.fixture(scope="module")
def data(spark):
    status = spark.createDataFrame([
        (1, "p1", "A", " completed ", "practice", "v1", None, None, None),
        (2, "p1", "B", "COMPLETED", "practice", "v1", None, None, None),
        (3, "p2", "A", "Failed", "practice", "v2", " Schema-Validation-Error ", "10", "n"),
        (4, "p2", "B", "error", "practice", "v2", "timeout", None, None),
        (5, "p2", "C", None, "practice", "v2", None, None, None),
        (6, "p2", "D", "SUCCESS", "practice", "v2", None, None, None),
        (7, "p3", "A", "FAILED", "practice", "v3", "SCHEMA-VALIDATION-ERROR", "11", None),
        (8, "p3", None, "FAILED", "practice", "v3", "schema-validation-error", "12", None),
        (9, "p3", "A", "FAILED", "practice", "v3", "schema-validation-error", None, None),
        (10, "p3", "A", "FAILED", "practice", "v3", "schema-validation-error", "13", None),
        (11, "p3", "A", "FAILED", "practice", "v3", "schema-validation-error", "14", None),
        (12, "p3", "B", "FAILED", "practice", "v3", "  ", None, None),
        (13, "p3", "C", "In-Progress", "practice", "v3", None, None, None),
    ], STATUS_DDL)
    payloads = spark.createDataFrame([
        ("10", '{"b": 1, "a": "x"}'), ("11", "{not json"), ("12", ""), ("14", "plain reason"), ("14", "z later")],
        "payload_response_id string, response string")
    splits = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3"), (4, "p9"), (5, "p1")],
                                   "position long, split_process_id string")
    return status, payloads, splits


def test_split_results(spark, data):
    status, _, splits = data
    got = rows(S.split_results(splits, status), "position", "split_process_id", "total_sub_processes",
               "completed", "errored", "stuck", "status", "reason")
    assert got == [
        (1, "p1", 2, 2, 0, 0, "PASS", None),
        (2, "p2", 4, 0, 2, 2, "FAIL", None),      # null and SUCCESS are stuck here
        (3, "p3", 7, 0, 6, 1, "FAIL", None),
        (4, "p9", 0, 0, 0, 0, "FAIL", "No records in process_status"),
        (5, "p1", 2, 2, 0, 0, "PASS", None),      # a split listed twice counts twice
    ]


def test_split_totals_and_empty_list(spark, data):
    status, _, splits = data
    t = S.split_totals(S.split_results(splits, status)).first().asDict()
    assert (t["total_splits"], t["splits_passed"], t["splits_failed"], t["total_sub_processes"],
            t["total_errored"], t["total_stuck"], t["overall_status"]) == (5, 2, 3, 15, 8, 3, "FAIL")
    empty = spark.createDataFrame([], "position long, split_process_id string")
    e = S.split_totals(S.split_results(empty, status)).first()
    assert (e["total_splits"], e["overall_status"]) == (0, "PASS")


def test_error_details_outcomes(spark, data):
    status, payloads, splits = data
    d = {r["id"]: r for r in S.error_details(splits, status, payloads).collect()}
    assert d[3]["error_type"] == "schema-validation-error" and d[3]["detailed_reason"] == '{"a":"x","b":1}'
    assert d[4]["error_type"] == "timeout" and d[4]["detailed_reason"] == "timeout"
    assert d[7]["detailed_reason"] == "{not json"
    assert d[8]["detailed_reason"] == "(response field is empty)" and d[8]["sub_process"] == "unknown"
    assert d[9]["detailed_reason"] == "(no payload_response_id available)"
    assert d[10]["detailed_reason"] == "(no payload_response record for id=13)"
    assert d[11]["detailed_reason"] == "plain reason"       # duplicate ids: smallest response wins
    assert d[12]["error_type"] == "unknown" and d[12]["detailed_reason"] == "(error field is empty)"


def test_failure_breakdown_counts_and_first_seen(spark, data):
    status, payloads, splits = data
    fb = S.failure_breakdown(S.error_details(splits, status, payloads))
    b = [tuple(r) for r in fb.select("error_type", "occurrences", "first_position", "sample_sub_process").collect()]
    # ordered: most frequent first, ties in first-seen order
    assert b == [("schema-validation-error", 6, 2, "A"), ("timeout", 1, 2, "B"), ("unknown", 1, 3, "B")]


def test_stuck_details_first_n(spark, data):
    status, _, splits = data
    got = rows(S.stuck_details(splits, status, n=1), "position", "rank", "sub_process", "status")
    assert got == [(2, 1, "C", "(null)"), (3, 1, "C", "In-Progress")]


def test_terminal_state_policy(spark):
    st = spark.createDataFrame([
        (1, "a", "Data-Loader-File", "SUCCESS", "x", "v", None, None, None),
        (2, "b", "Data-Loader-File", "Completed", "x", "v", None, None, None),
        (3, "b", "File-Record", "IN-PROGRESS", "x", "v", None, None, None),
        (4, "c", "File-Record", "Completed", "x", "v", None, None, None),
        (5, "d", "Data-Loader-File", "Queued", "x", "v", None, None, None),
        (6, "e", "Data-Loader-File", "Completed", "x", "v", None, None, None),
        (7, "e", "File-Record", "error", "x", "v", "boom", None, None),
    ], STATUS_DDL)
    got = rows(S.terminal_state(st), "process_id", "verdict", "reason")
    assert got == [("a", "PASS", None), ("b", "FAIL", "still IN-PROGRESS"),
                   ("c", "FAIL", "no Data-Loader-File row"), ("d", "FAIL", "loader did not complete"),
                   ("e", "FAIL", "status rows report errors")]


def test_consolidated_verdict(spark, data):
    status, _, splits = data
    totals = S.split_totals(S.split_results(splits, status))
    v = S.consolidated_verdict(totals).first()
    assert v["verdict"] == "FAIL"
    assert v["message"] == "validation FAILED:\n  3/5 split(s) FAILED - 8 errored, 3 stuck sub-process(es)."
    ok = S.split_totals(S.split_results(splits.where("position = 1"), status))
    assert S.consolidated_verdict(ok).first()["verdict"] == "PASS"


def test_reason_preview_keeps_first_20_lines(spark):
    status = spark.createDataFrame([(1, "p", "A", "FAILED", "x", "v", "schema-validation-error", "9", None)], STATUS_DDL)
    payloads = spark.createDataFrame([("9", "\n".join(f"line {i}" for i in range(25)))],
                                     "payload_response_id string, response string")
    splits = spark.createDataFrame([(1, "p")], "position long, split_process_id string")
    r = S.error_details(splits, status, payloads).first()
    assert r["detailed_reason"].count("\n") == 24
    assert r["reason_preview"] == "\n".join(f"line {i}" for i in range(20))


def test_terminal_state_by_process_and_business_value(spark):
    st = spark.createDataFrame([
        (1, "a", "Data-Loader-File", "Completed", "x", "v1", None, None, None),
        (2, "a", "Data-Loader-File", "FAILED", "x", "v2", "boom", None, None)], STATUS_DDL)
    only_v1 = spark.createDataFrame([("a", "v1")], "process_id string, business_value string")
    assert rows(S.terminal_state(st, process_ids=only_v1), "process_id", "verdict") == [("a", "PASS")]
    by_pid = spark.createDataFrame([("a",)], "process_id string")
    assert rows(S.terminal_state(st, process_ids=by_pid), "process_id", "verdict") == [("a", "FAIL")]
