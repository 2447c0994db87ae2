"""Inventory checks, object search, final state, before/after and payload echo."""

import datetime as dt

from pyspark.sql import functions as F

from sluice.operators import artifacts as A
from sluice.operators import finalstate as FS
from sluice.rules import rules_frame

from conftest import rows
from test_candidates import rule

T = dt.datetime


def test_check_artifacts_states(spark):
    arts = spark.createDataFrame([("r1", "k", 1, "b", "a.csv"), ("r1", "k", 2, "b", "gone.csv"),
                                  ("r1", "k", 3, "b", "empty.csv"), ("r1", "k", 4, "b", "old.csv"),
                                  ("r2", "k", 1, "b", "old.csv")],
                                 "run_id string, rule_key string, position long, bucket string, key string")
    inv = spark.createDataFrame([("b", "a.csv", 10, T(2024, 1, 2)), ("b", "empty.csv", 0, T(2024, 1, 2)),
                                 ("b", "old.csv", 5, T(2023, 12, 31))],
                                "bucket string, key string, size long, last_modified timestamp")
    runs = spark.createDataFrame([("r1", T(2024, 1, 1)), ("r2", T(2024, 1, 1))], "run_id string, started_at timestamp")
    picks = spark.createDataFrame([("r1", True), ("r2", False)], "run_id string, run_verified boolean")
    got = rows(A.check_artifacts(arts, inv, runs, picks), "run_id", "key", "state", "verdict")
    assert got == [("r1", "a.csv", "ok", "PASS"), ("r1", "empty.csv", "0 bytes", "FAIL"),
                   ("r1", "gone.csv", "not found", "FAIL"), ("r1", "old.csv", "stale", "WARN"),
                   ("r2", "old.csv", "stale", "FAIL")]
    strict = rows(A.check_artifacts(arts, inv, runs, picks, enforce_freshness=True), "run_id", "key", "verdict")
    assert ("r1", "old.csv", "FAIL") in strict


def test_search_objects_matches_startswith(spark):
    keys = ["out/p/a.csv", "/out/p/b.csv", "out/p/sub/c.csv", "out/px/d.csv", "out/p/e.txt", "x/out/p/f.csv",
            "out/p/old.csv"]
    inv = spark.createDataFrame([("b", k, 1, T(2024, 1, 5) if k != "out/p/old.csv" else T(2023, 1, 1)) for k in keys],
                                "bucket string, key string, size long, last_modified timestamp")
    targets = spark.createDataFrame([("s1", "b", "/out/p", T(2024, 1, 1)), ("s2", "b", "out", T(2024, 1, 1)),
                                     ("s3", "other", "out/p/", T(2024, 1, 1))],
                                    "search_id string, target_bucket string, prefix string, since timestamp")
    got = rows(A.matching_objects(inv, targets), "search_id", "key")
    brute = sorted((sid, k) for sid, pre in (("s1", "out/p/"), ("s2", "out/")) for k in keys
                   if k.lstrip("/").startswith(pre) and k.endswith(".csv") and k != "out/p/old.csv")
    assert got == brute
    contents = spark.createDataFrame([("b", "out/p/a.csv", "12")], "bucket string, key string, value string")
    t2 = targets.withColumn("must_contain", F.lit("12"))
    assert rows(A.matching_objects(inv, t2, contents=contents), "search_id", "key") == [
        ("s1", "out/p/a.csv"), ("s2", "out/p/a.csv")]


def test_search_takes_the_first_object(spark):
    inv = spark.createDataFrame([("b", "out/p/a.csv", 1, T(2024, 1, 2)), ("b", "out/p/b.csv", 2, T(2024, 1, 3)),
                                 ("b", "out/p/a0.csv", 3, T(2024, 1, 3)), ("b", "out/p/x.txt", 4, T(2024, 1, 1))],
                                "bucket string, key string, size long, last_modified timestamp")
    targets = spark.createDataFrame([("s1", "b", "out/p", T(2024, 1, 1)), ("s2", "b", "out/p/", T(2024, 1, 3)), ("s3", "b", "out/p", T(2024, 1, 4)),
                                     ("s4", "b", "", T(2024, 1, 2)), ("s5", "c", "out/p", T(2024, 1, 1))],
                                    "search_id string, target_bucket string, prefix string, since timestamp")
    assert rows(A.search_objects(inv, targets), "search_id", "key", "size") == [
        ("s1", "out/p/a.csv", 1), ("s2", "out/p/a0.csv", 3), ("s4", "out/p/a.csv", 1)]
    held = spark.createDataFrame([("b", "out/p/b.csv", "12")], "bucket string, key string, value string")
    assert rows(A.search_objects(inv, targets.withColumn("must_contain", F.lit("12")), contents=held), "search_id", "key") == [
        ("s1", "out/p/b.csv"), ("s2", "out/p/b.csv"), ("s4", "out/p/b.csv")]


def test_prefix_join_is_startswith(spark):
    """Nested, doubled and many prefixes of any depth, none declared beforehand."""
    keys = ["out/p/a.csv", "/out/p/b.csv", "out/p//c.csv", "out/p/q/r/d.csv", "e.csv", "outer/f.csv"]
    inv = spark.createDataFrame([("b", k) for k in keys], "bucket string, key string")
    prefixes = ["", "out/", "out/p/", "out/p//", "out/p/q/r/", "o/"] + [f"dir{k}/" for k in range(40)]
    targets = spark.createDataFrame([("b", p) for p in prefixes], "target_bucket string, prefix string")
    got = rows(A.under_prefix_join(inv, targets), "prefix", "key")
    assert got == sorted((p, k) for p in prefixes for k in keys if k.lstrip("/").startswith(p))


def test_final_state(spark):
    r = rule("k")
    practices = spark.createDataFrame([(1, "t", "N")], "PracticeID long, TaxIDNumber string, Archived string")
    after = spark.createDataFrame([(10, 1, "x", " n ", 5, "N"), (11, 1, "x", None, 5, "N"), (12, 1, "x", "Y", 5, "N"),
                                   (13, 1, "x", "N", 5, "Y")],
                                  "LocationID long, PracticeID long, NationalProviderID string, InDirectory string, "
                                  "LocationTypeID long, Archived string")
    types = spark.createDataFrame([(5, "Billing", 1, "Y")],
                                  "PracticeTypeID long, PracticeTypeName string, StatusSetID long, Archived string")
    state = FS.final_state_rows(practices, after, types)
    cands = spark.createDataFrame([("k", 10), ("k", 11), ("k", 12), ("k", 13)], "rule_key string, LocationID long")
    got = rows(FS.final_state(spark, cands, state, [r]), "LocationID", "found", "actual_value", "verdict")
    assert got == [("10", True, "N", "PASS"), ("11", True, "NULL", "FAIL"), ("12", True, "Y", "FAIL"),
                   ("13", False, None, "FAIL")]


def test_before_after(spark):
    before = spark.createDataFrame([(1, 100, 7, "Y"), (2, 100, 8, " y"), (3, 200, 9, "N")],
                                   "PractitionerLocationRecID long, PractitionerID long, LocationID long, InDirectory string")
    after = spark.createDataFrame([(1, 100, 7, "n", "DataLoader"), (2, 100, 8, "N", None), (4, 100, 9, "N", "x"),
                                   (3, 200, 9, "Y", "bob")],
                                  "PractitionerLocationRecID long, PractitionerID long, LocationID long, "
                                  "InDirectory string, AuditUser string")
    rws = FS.before_after_rows(before, after, "InDirectory", ("N",))
    assert rows(rws, "PractitionerLocationRecID", "before_flag", "after_flag", "offender") == [
        (1, "Y", "N", False), (2, "Y", "N", False), (3, "N", "Y", True), (4, "—", "N", False)]
    summ = rows(FS.before_after_summary(before, rws, "dataloader"), "PractitionerID", "n_visible_before",
                "n_baseline", "n_offenders", "attributed", "verdict")
    assert summ == [(100, 2, 2, 0, True, "PASS"), (200, 0, 1, 1, False, "FAIL")]


def test_payload_echo(spark):
    r = rule("k")
    rl = [r]
    status = spark.createDataFrame([
        ("p1", "practice", "v1", "1"), ("p1", "practice", "v1", "1"), ("p1", "practice", "v2", "2"),
        ("p2", "practice", "v3", "3"), ("p3", "practice", "v4", None)],
        "process_id string, entity_name string, business_value string, payload_response_id string")
    payloads = spark.createDataFrame([("1", "AppliedRule=rule-15 InDirectory=N", "{}"), ("2", "x", None),
                                      ("3", "", "AppliedRule=15")],
                                     "payload_response_id string, payload string, response string")
    targets = spark.createDataFrame([("p1", "v2"), ("p2", "v9"), ("p3", "v4")], "process_id string, expected_value string")
    got = rows(FS.payload_echo(spark, status, payloads, targets, rl, rules_frame(spark, rl),
                               r"AppliedRule\s*[=:]\s*([A-Za-z0-9_-]+)"),
               "process_id", "n_payloads", "rule_echoed", "flag_mentioned", "identity_confirmed", "verdict")
    assert got == [("p1", 2, True, True, True, "PASS"), ("p2", 1, True, False, False, "FAIL"),
                   ("p3", 0, False, False, True, "FAIL")]


def test_search_over_time_slots_equals_a_plain_walk(spark, monkeypatch):
    import datetime as dt
    import random

    monkeypatch.setattr(A, "SEARCH_SLOTS", 9)
    rng = random.Random(3)
    t = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=k)
    objects = [("b", f"out/{rng.choice('pq')}/f{k}.csv", k, t(rng.choice([5, 7, 7, 300, rng.randint(0, 100_000)]))) for k in range(300)]
    searches = [(f"s{k}", "b", rng.choice(["out/", "out/p/", "/out/q/", "none/"]), t(rng.choice([0, 7, 8, 299, rng.randint(0, 120_000)]))) for k in range(120)]
    inv = spark.createDataFrame(objects, "bucket string, key string, size long, last_modified timestamp")
    asked = spark.createDataFrame(searches, "search_id string, target_bucket string, prefix string, since timestamp")
    want = []
    for sid, b, prefix, since in searches:
        fit = sorted((at, key, size) for _, key, size, at in objects if key.startswith(prefix.lstrip("/")) and at >= since)
        want += [(sid, b, fit[0][1], fit[0][2])] if fit else []
    assert rows(A.search_objects(inv, asked), "search_id", "bucket", "key", "size") == sorted(want)
    assert A.search_objects(inv.limit(0), asked).count() == 0


def test_state_rows_of_one_key_count_once_or_conflict(spark):
    r = rule("k")
    r = r.__class__(**{**r.__dict__, "final_key_columns": ("LocationID",), "final_column": "InDirectory", "final_expected_values": ("N",)})
    cands = spark.createDataFrame([("k", 1), ("k", 2), ("k", 3), ("k", 4)], "rule_key string, LocationID long")
    state = spark.createDataFrame([(1, "N"), (1, "Y"), (2, "N"), (2, " n"), (3, ""), (3, None)], "LocationID long, InDirectory string")
    got = rows(FS.final_state(spark, cands, state, [r]), "LocationID", "actual_value", "verdict", "reason")
    assert got == [("1", None, "FAIL", "final rows differ in InDirectory: N .. Y"), ("2", "N", "PASS", None),
                   ("3", "NULL", "FAIL", "expected InDirectory in ['N'], found NULL"), ("4", None, "FAIL", "final row not found")]
