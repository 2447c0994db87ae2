"""Candidate selection, counts and preconditions on a hand-made directory."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators import candidates as C
from sluice.rules import RuleRegistry, SuppressionRule

from conftest import rows

AS_OF = "2024-06-01"
T = dt.datetime


def rule(key, trigger="Y", field="Claim Hold Reason", values=("00001", "00002"), rule_id=15):
    return SuppressionRule(
        key=key, rule_id=rule_id, description="", flow_name="practice", entity_type="practice",
        trigger_field="InDirectory", trigger_value=trigger, udf_field_name=field, qualifying_udf_values=values,
        candidate_identity_columns=("PracticeID", "LocationID", "TaxIDNumber"),
        outbound_identity_map=(("PracticeID", "PracticeID"), ("LocationID", "BillingLocationID")),
        outbound_search_field="PracticeID", outbound_column="DataSource", outbound_expected_value="auto",
        outbound_prefix="out/practice/", status_business_value_field="TaxIDNumber",
        final_key_columns=("LocationID",), final_column="InDirectory", final_expected_values=("N",))


@pytest.fixture(scope="module")
def directory(spark):
    mk = spark.createDataFrame
    practices = mk([("P1", "111", "N"), ("P2", None, "N"), ("P3", "333", "Y")],
                   "PracticeID string, TaxIDNumber string, Archived string")
    locations = mk([
        ("L1", "P1", "0001", "Y", "T1", "N"),   # qualifies through two attributes
        ("L2", "P1", "0002", "Y", "T1", "N"),   # only a future-dated attribute
        ("L3", "P2", None, "Y", "T1", "N"),     # null tax id on its practice
        ("L4", "P1", "0004", "Y", "T1", "Y"),   # archived location
        ("L5", "P3", "0005", "Y", "T1", "N"),   # archived practice
        ("L6", "P1", "0006", "N", "T1", "N"),   # trigger flag not set
        ("L7", "P1", "0007", "Y", "T2", "N"),   # non-service location type
        ("L8", "P1", "0008", "Y", "T1", "N"),   # attribute defined for another table
        ("L9", "P1", "0009", "Y", "T1", "N"),   # attribute ended the day before
    ], "LocationID string, PracticeID string, NationalProviderID string, InDirectory string, "
       "LocationTypeID string, Archived string")
    uf = mk([
        ("U1", "L1", "D1", "00001", T(2020, 1, 1), None, "N"),
        ("U2", "L1", "D1", "00002", T(2020, 1, 1), T(2024, 6, 1, 23, 0), "N"),  # DateTo on the as-of date
        ("U3", "L2", "D1", "00001", T(2024, 6, 2), None, "N"),                  # future start
        ("U4", "L3", "D1", "00002", T(2020, 1, 1), None, "N"),
        ("U5", "L4", "D1", "00001", T(2020, 1, 1), None, "N"),
        ("U6", "L5", "D1", "00001", T(2020, 1, 1), None, "N"),
        ("U7", "L6", "D1", "00001", T(2020, 1, 1), None, "N"),
        ("U8", "L7", "D1", "00001", T(2020, 1, 1), None, "N"),
        ("U9", "L8", "D2", "00001", T(2020, 1, 1), None, "N"),
        ("U10", "L9", "D1", "00001", T(2020, 1, 1), T(2024, 5, 31), "N"),
        ("U11", "L1", "D1", "00003", T(2020, 1, 1), None, "N"),                  # not a qualifying code
        ("U12", "L1", "D1", "00001", None, None, "N"),                           # null start excludes
        ("U13", "L1", "D1", "00001", T(2020, 1, 1), None, "Y"),                  # archived attribute
    ], "UserFieldRecID string, ParentRecID string, UserDefinedFieldID string, Value string, "
       "DateFrom timestamp, DateTo timestamp, Archived string")
    udf = mk([("D1", "Claim Hold Reason", "R1", "N"), ("D2", "Claim Hold Reason", "R2", "N")],
             "UserDefinedFieldID string, FieldName string, RecordTypeID string, Archived string")
    rt = mk([("R1", "PracticeLocations", "N"), ("R2", "Practitioners", "N")],
            "RecordTypeID string, TableName string, Archived string")
    pt = mk([("T1", "Service", "S1", "N"), ("T2", "Billing", "S1", "N")],
            "PracticeTypeID string, PracticeTypeName string, StatusSetID string, Archived string")
    ss = mk([("S1", "Location Types")], "StatusSetID string, StatusSetName string")
    return {"practices": practices, "practice_locations": locations, "user_fields": uf,
            "user_defined_fields": udf, "record_types": rt, "practice_types": pt, "status_sets": ss}


RULES = [rule("r1"), rule("r_none", values=("99999",), rule_id=16)]


def test_qualifying_rows_follow_every_filter(spark, directory):
    q = C.qualifying_for(spark, directory, RULES, AS_OF)
    assert rows(q, "rule_key", "LocationID", "UserFieldRecID") == [
        ("r1", "L1", "U1"), ("r1", "L1", "U2"), ("r1", "L3", "U4")]
    null_tax = q.where(F.col("LocationID") == "L3").first()
    assert null_tax["TaxIDNumber"] == "" and null_tax["NationalProviderID"] == ""


def test_counts_are_distinct_and_empty_rules_report_zero(spark, directory):
    got = rows(C.candidate_counts(spark, directory, RULES, AS_OF), "rule_key", "candidate_count")
    assert got == [("r1", 2), ("r_none", 0)]


def test_top_n_orders_and_limits_per_rule(spark, directory):
    top = C.candidates(spark, directory, RULES, AS_OF, top_n=2)
    assert rows(top, "rule_key", "rank", "LocationID", "UserFieldRecID") == [
        ("r1", 1, "L1", "U1"), ("r1", 2, "L1", "U2")]
    with pytest.raises(ValueError):
        C.candidates(spark, directory, RULES, AS_OF, top_n=0)
    with pytest.raises(ValueError):
        C.candidates(spark, directory, RULES, AS_OF, top_n=1001)


def test_preconditions_fail_blank_identity(spark, directory):
    q = C.qualifying_for(spark, directory, RULES, AS_OF)
    chk = C.check_preconditions(spark, q, RULES)
    got = rows(chk.select("LocationID", "passed", F.array_join("failed_checks", ",").alias("f")))
    assert got == [("L1", True, ""), ("L1", True, ""), ("L3", False, "identity:TaxIDNumber")]


def test_preconditions_catch_trigger_and_value(spark):
    cands = spark.createDataFrame([("r1", "P1", "L1", "T", " n ", " 00009 ")],
                                  "rule_key string, PracticeID string, LocationID string, TaxIDNumber string, "
                                  "InDirectory string, QualifyingValue string")
    got = C.check_preconditions(spark, cands, [rule("r1")]).first()
    assert list(got["failed_checks"]) == ["trigger", "qualifying_value"]


def test_code_audit(spark, directory):
    got = rows(C.code_audit(directory), "FieldName", "n_values", "n_distinct", "n_not_code")
    assert got == [("Claim Hold Reason", 12, 3, 0)]


def test_registry():
    reg = RuleRegistry([rule("a"), rule("b")])
    assert reg.get("a").key == "a"
    with pytest.raises(KeyError, match="registered: a, b"):
        reg.get("zzz")
    with pytest.raises(ValueError):
        reg.add(rule("c", values=()))
    assert rule("a").rule_ids_accepted == {"15", "rule-15", "rule_15", "prac-15", "practice-15", "facility-15"}


def test_collation_option(spark, directory):
    """H8: with a case- and trailing-blank-insensitive collation, differently
    spelled names and flags still match; the default stays exact."""
    d = dict(directory)
    d["user_defined_fields"] = directory["user_defined_fields"].withColumn(
        "FieldName", F.when(F.col("UserDefinedFieldID") == "D1", F.lit("claim hold REASON  ")).otherwise(F.col("FieldName")))
    d["practice_locations"] = directory["practice_locations"].withColumn(
        "InDirectory", F.when(F.col("LocationID") == "L1", F.lit("y")).otherwise(F.col("InDirectory")))
    exact = rows(C.candidate_counts(spark, d, RULES, AS_OF), "rule_key", "candidate_count")
    assert exact == [("r1", 0), ("r_none", 0)]
    loose = rows(C.candidate_counts(spark, d, RULES, AS_OF, collation="UTF8_LCASE_RTRIM"), "rule_key", "candidate_count")
    assert loose == [("r1", 2), ("r_none", 0)]


def test_the_library_rules_run_unfiltered(spark, directory):
    """Both registered rules at once: practice locations and practitioners."""
    from sluice.operators import finalstate as FS
    from sluice.rules import DIRECTORY_RULES

    mk = spark.createDataFrame
    tables = dict(directory)
    tables["practitioners"] = mk([("N1", "npi1", "Y", "N"), ("N2", "npi2", "N", "N"), ("N3", None, "Y", "N"), ("N4", "npi4", "Y", "Y")],
                                 "PractitionerID string, NationalProviderID string, ActiveMilitaryOrReserve string, Archived string")
    tables["record_types"] = tables["record_types"].unionByName(mk([("RX", "Practitioners", "N")], "RecordTypeID string, TableName string, Archived string"),
                                                                allowMissingColumns=True)
    tables["user_defined_fields"] = tables["user_defined_fields"].unionByName(
        mk([("DX", "Claim Hold Reason", "RX", "N")], "UserDefinedFieldID string, FieldName string, RecordTypeID string, Archived string"), allowMissingColumns=True)
    tables["user_fields"] = tables["user_fields"].unionByName(mk(
        [("X1", "N1", "DX", "00009", T(2020, 1, 1), None, "N"), ("X2", "N1", "DX", "00001", T(2020, 1, 1), None, "N"), ("X3", "N2", "DX", "00001", T(2020, 1, 1), None, "N"),
         ("X4", "N3", "DX", "00004", T(2020, 1, 1), None, "N"), ("X5", "N4", "DX", "00001", T(2020, 1, 1), None, "N"), ("X6", "N3", "DX", "00001", T(2025, 1, 1), None, "N")],
        "UserFieldRecID string, ParentRecID string, UserDefinedFieldID string, Value string, DateFrom timestamp, DateTo timestamp, Archived string"))
    rules = list(DIRECTORY_RULES)
    counts = {r["rule_key"]: r["candidate_count"] for r in C.candidate_counts(spark, tables, rules, AS_OF).collect()}
    bound = next(r for r in rules if r.entity_type == "practitioner")
    assert len(counts) == len(rules) and counts[bound.key] == 1
    top = C.candidates(spark, tables, rules, AS_OF).where(F.col("rule_key") == bound.key)
    assert rows(top, "PractitionerID", "NationalProviderID", "UserFieldRecID", "rank") == [("N1", "npi1", "X1", 1), ("N1", "npi1", "X2", 2)]
    after = mk([("N1", " n ", "N")], "PractitionerID string, ActiveMilitaryOrReserve string, Archived string")
    found = C.qualifying_entity(spark, tables, C.BINDINGS["practitioner"], [bound], AS_OF)
    assert rows(FS.final_state(spark, found, FS.entity_state_rows(after), [bound]), "PractitionerID", "verdict") == [("N1", "PASS")]


def test_an_empty_value_list_is_an_error(spark, directory):
    with pytest.raises(ValueError):
        C.candidate_counts(spark, directory, [rule("k", values=())], AS_OF)
