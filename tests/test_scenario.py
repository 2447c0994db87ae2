"""Scenario: the stage graph on literal frames, and rules of two entities in one run."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from sluice.operators import scenario as S
from sluice.plans import driver as D

from conftest import rows

SF = "/root/testdata/sf0.001"


def _frame(spark, key, data):
    return spark.createDataFrame(data, f"{key} string, verdict string, reason string")


def test_stages_follow_their_prerequisites(spark):
    recs = spark.createDataFrame([("a", "x", 1), ("b", "y", 0), ("c", None, 1), ("d", "z", 1), ("e", "x", 1)], "rec string, proc string, good int")
    ok = F.col("good") == 1
    stages = [
        S.Stage("first", verdict=F.when(ok, "PASS").otherwise("FAIL"), reason=F.when(~ok, F.lit("bad"))),
        S.Stage("side", (), _frame(spark, "rec", [("a", "PASS", None), ("b", "WARN", "late"), ("c", "PASS", None), ("d", "FAIL", "broken")]), ["rec"]),
        S.Stage("by_process", ["first"], _frame(spark, "proc", [("x", "WARN", "slow"), ("y", "PASS", None)]), ["proc"],
                absent=F.when(F.col("proc").isNull(), F.lit("no process")).otherwise(F.lit("unknown process"))),
        S.Stage("last", ["side", "by_process"], verdict=F.lit("PASS"), reason=F.lit(None).cast("string")),
    ]
    got = rows(S.run_stages(recs, stages).select("rec", "first", "side", "by_process", "last", "first_failed_stage", "reason", "verdict"))
    assert got == [
        ("a", "PASS", "PASS", "WARN", "PASS", None, None, "WARN"),
        ("b", "FAIL", "WARN", "SKIPPED", "SKIPPED", "first", "bad", "FAIL"),
        ("c", "PASS", "PASS", "FAIL", "SKIPPED", "by_process", "no process", "FAIL"),
        ("d", "PASS", "FAIL", "FAIL", "SKIPPED", "side", "broken", "FAIL"),
        ("e", "PASS", "FAIL", "WARN", "SKIPPED", "side", "no result", "FAIL"),
    ]


def test_stage_graph_is_checked(spark):
    recs = spark.createDataFrame([("a",)], "rec string")
    one = S.Stage("one", verdict=F.lit("PASS"), reason=F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="waits for two"):
        S.run_stages(recs, [S.Stage("one", ["two"], verdict=F.lit("PASS"), reason=F.lit("x"))])
    with pytest.raises(ValueError, match="taken"):
        S.run_stages(recs, [one, one])
    assert S.run_stages(recs.limit(0), [one]).count() == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_rules_of_two_entities_run_together(spark):
    """Both entities in one call give the rows of each alone (by their oracles)."""
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events benchmark".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")

    def alone(name, columns, keys):
        found = con.execute(f"SELECT {', '.join(columns)} FROM ({D.ORACLE[name]}) WHERE rule_key IN ({', '.join(repr(k) for k in keys)})").fetchall()
        return sorted((tuple(None if v is None else str(v) for v in r) for r in found), key=lambda t: tuple(v or "" for v in t))

    c = D.catalog(spark, SF)
    both = c["outbound_rows"].unionByName(c["practitioner_outbound_rows"].withColumn("row_no", -F.col("row_no")), allowMissingColumns=True)
    inputs = S.ScenarioInputs(
        D.directory(spark, SF), c["runs"], c["run_log_captures"], c["object_inventory"],
        both.withColumn("missing_columns", F.array().cast("array<string>")), c["process_status"],
        {"": D.fs.final_state_rows(c["practices"], c["practice_locations_after"], c["practice_types"]),
         "practitioner": D.fs.entity_state_rows(c["practitioners_after"])})
    practice = [r for r in D.DRIVER_RULES if r.entity_type == "practice"]
    assert [len(x) for x in S._shapes([*practice, *D.PRACTITIONER_RULES])] == [len(practice), 1]
    got = S.suppression_scenario(spark, inputs, [*practice, *D.PRACTITIONER_RULES], D.AS_OF, D.OUTBOUND_BUCKET, enforce_counts=False)
    assert got.columns[:6] == ["rule_key", "PracticeID", "LocationID", "NationalProviderID", "PractitionerID", "run_id"]
    got = got.cache()
    rest = ["run_id", *S.STAGES, "first_failed_stage", "reason", "verdict"]
    columns = ["rule_key", "PracticeID", "LocationID", *rest]
    assert rows(got.where("PractitionerID IS NULL").select(*columns)) == alone("stage_verdict", columns, [r.key for r in practice])
    columns = ["rule_key", "NationalProviderID", "PractitionerID", *rest]
    assert rows(got.where("PractitionerID IS NOT NULL").select(*columns)) == alone("practitioner_stage_verdict", columns, [r.key for r in D.PRACTITIONER_RULES])
