"""The driver bindings reach the branches of the operators: the verdicts and
reasons that the registered queries yield at sf0.01 (from their oracles, which
``test_entry`` holds equal to the engine)."""

import os

import duckdb
import pytest

from sluice.plans import driver

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events benchmark".split()

REACHED = {
    "stage_verdict": ("first_failed_stage", {"candidate", "job", "run_log", "outbound_file", "outbound_content", "dataloader"}),
    "practitioner_stage_verdict": ("first_failed_stage", {None, "job", "run_log", "outbound_file", "outbound_content", "dataloader"}),
    "artifact_state": ("state", {"ok", "not found", "0 bytes", "stale"}),
    "outbound_expected_any": ("reason", {None, "no outbound files were checked", "record not found in any outbound file",
                                         "unexpected value in a matched file"}),
    "outbound_first3": ("rank", {1, 2}),
    "terminal_state": ("reason", {None, "status rows report errors", "still IN-PROGRESS", "no Data-Loader-File row", "loader did not complete"}),
    "stream_terminal": ("verdict", {"PASS", "FAIL"}),
    "stream_flag": ("verdict", {"PASS", "FAIL"}),
    "stream_log_done": ("verdict", {"COMPLETE", "FAIL"}),
    "final_state": ("verdict", {"PASS", "FAIL"}),
    "rule_count_recon": ("verdict", {"PASS", "FAIL"}),
    "payload_rule_echo": ("reason", {None, "payload empty", "rule not echoed in payload", "flag column not named in payload", "batch-level process row"}),
    "before_after_summary": ("verdict", {"PASS", "FAIL", "WARN"}),
    "outbound_file_match": ("reason", {None, "identity column missing from a checked file", "record not found in any outbound file"}),
    "outbound_file_rows": ("missing", {"", "TaxIDNumber", "BillingLocationID"}),
    "stream_objects": ("verdict", {"FOUND", "MISSING"}),
    "final_state_conflicts": ("split_part(reason, ':', 1)", {None, "final rows differ in InDirectory"}),
    "artifact_longest_prefix": ("rule_key", {"practice_f_z", "practice_f_ar"}),
    "log_file_pick": ("source", {"api", "manager", "file"}),
    "split_status": ("status", {"PASS", "FAIL"}),
    "code_audit": ("n_not_code < n_values", {True}),
}


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(SF):
        pytest.skip("driver tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(REACHED))
def test_reasons_occur(duck, name):
    column, wanted = REACHED[name]
    got = {r[0] for r in duck.execute(f"SELECT DISTINCT {column} FROM ({driver.ORACLE[name]})").fetchall()}
    assert wanted <= got, got


def test_any_and_all_differ(duck):
    a, b = (duck.execute(f"SELECT count(*) FROM ({driver.ORACLE[n]}) WHERE verdict = 'PASS'").fetchone()[0]
            for n in ("outbound_expected_any", "outbound_expected_all"))
    assert a > b


def test_a_record_sits_in_two_runs_and_a_run_is_skipped(duck):
    rows = duck.execute(f"SELECT rule_key, LocationID, count(DISTINCT run_id) FROM ({driver.O_STAGE_VERDICT}) GROUP BY ALL").fetchall()
    assert max(r[2] for r in rows) >= 2
    states = {r[0] for r in duck.execute(f"SELECT DISTINCT reason FROM ({driver.O_STAGE_VERDICT})").fetchall()}
    assert "no object found by prefix search" in states
