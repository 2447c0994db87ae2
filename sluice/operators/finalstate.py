"""Final-state and payload checks (JOIN-2/7/8/10/11, AGG-12/14, RECON-6/7/8).

Each check is a join of the selected records with a state table by key,
followed by per-record or per-entity aggregation; the reference's one-row
lookups per candidate become one shuffle each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.exprs import flag, text_norm, text_of
from sluice.rules import rule_alias_frame

MISSING_BASELINE = "—"


def final_state_rows(practices: DataFrame, locations_after: DataFrame, practice_types: DataFrame) -> DataFrame:
    """JOIN-2: the location state after the load; the type join has no
    archive or name filter."""
    p = practices.where(F.col("Archived") == "N").select(
        "PracticeID", "TaxIDNumber", F.col("Archived").alias("PracticeArchived"))
    loc = locations_after.where(F.col("Archived") == "N")
    pt = practice_types.select(F.col("PracticeTypeID").alias("LocationTypeID"),
                               F.col("PracticeTypeName").alias("LocationTypeName"))
    keep = [c for c in ("ModifiedBy",) if c in loc.columns]
    return (loc.join(p, "PracticeID").join(pt, "LocationTypeID")
            .select("PracticeID", F.coalesce("TaxIDNumber", F.lit("")).alias("TaxIDNumber"), "LocationID",
                    F.coalesce("NationalProviderID", F.lit("")).alias("NationalProviderID"),
                    F.coalesce("InDirectory", F.lit("")).alias("InDirectory"), "LocationTypeID", "LocationTypeName",
                    "PracticeArchived", F.col("Archived").alias("PracticeLocationArchived"), *keep))


def entity_state_rows(after: DataFrame) -> DataFrame:
    """The live rows of a bound entity's own table after the load."""
    return after.where(F.col("Archived") == "N")


def final_state(spark: SparkSession, candidates: DataFrame, state: DataFrame, rule_list) -> DataFrame:
    """JOIN-7 + RECON-6, one row per (rule, record): the state row is found by
    the rule's key columns and its final column (strip, upper) is one of the
    expected values; a blank value is reported as NULL.  State rows of one key
    that agree count once; rows that differ fail with their values' range."""
    out = None
    groups: dict[tuple, list] = {}
    for r in rule_list:
        groups.setdefault((r.final_key_columns, r.final_column, tuple(r.final_expected_values)), []).append(r)
    for (keys, col, expected), rs in groups.items():
        c = candidates.where(F.col("rule_key").isin([r.key for r in rs])).select("rule_key", *keys).distinct()
        value = flag(F.col(col))
        s = state.select(*keys, F.when(value == "", "NULL").otherwise(value).alias("_v")).groupBy(*keys).agg(
            F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.lit(True).alias("_found"))
        j = c.join(s, list(keys), "left")
        found = F.coalesce("_found", F.lit(False))
        one = F.col("_low") == F.col("_high")
        exp = [str(v).strip().upper() for v in expected]
        reason = (F.when(~found, F.lit("final row not found"))
                  .when(~one, F.concat(F.lit(f"final rows differ in {col}: "), "_low", F.lit(" .. "), "_high"))
                  .when(~F.col("_low").isin([e or "NULL" for e in exp]), F.concat(F.lit(f"expected {col} in {sorted(exp)}, found "), "_low")))
        part = j.select("rule_key", *[F.col(k).cast("string").alias(k) for k in keys],
                        found.alias("found"), F.when(found & one, F.col("_low")).alias("actual_value"),
                        F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("verdict"), reason.alias("reason"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def before_after_rows(before: DataFrame, after: DataFrame, flag_col: str, expected_values) -> DataFrame:
    """JOIN-8: after-rows drive; the baseline flag shows '—' when missing;
    an after row is an offender when its flag is not expected."""
    exp = [str(v).strip().upper() for v in expected_values]
    b = before.select("PractitionerLocationRecID", flag(F.col(flag_col)).alias("before_flag"))
    j = after.join(b, "PractitionerLocationRecID", "left")
    after_flag = flag(F.col(flag_col))
    return j.select("PractitionerID", "PractitionerLocationRecID", "LocationID",
                    F.coalesce("before_flag", F.lit(MISSING_BASELINE)).alias("before_flag"),
                    after_flag.alias("after_flag"), (~after_flag.isin(exp)).alias("offender"),
                    F.coalesce(F.col("AuditUser"), F.lit("")).alias("audit_user"))


def before_after_summary(before: DataFrame, after_rows: DataFrame, modified_by: str,
                         enforce_modified_by: bool = False) -> DataFrame:
    """RECON-7 + AGG-12/14 per practitioner: baseline k visible of n, after
    rows, offenders, and whether any audit user names the loader."""
    base = before.groupBy("PractitionerID").agg(
        F.count(F.lit(1)).alias("n_baseline"),
        F.count_if(flag(F.col("InDirectory")) == "Y").alias("n_visible_before"))
    aft = after_rows.groupBy("PractitionerID").agg(
        F.count(F.lit(1)).alias("n_after"), F.count_if("offender").alias("n_offenders"),
        F.coalesce(F.bool_or(F.lower("audit_user").contains(modified_by.lower())), F.lit(False)).alias("attributed"))
    j = base.join(aft, "PractitionerID", "full")
    nb, nv, na = (F.coalesce(c, F.lit(0)).cast("long") for c in ("n_baseline", "n_visible_before", "n_after"))
    no = F.coalesce("n_offenders", F.lit(0)).cast("long")
    attributed = F.coalesce("attributed", F.lit(False))
    reason = (F.when(nb == 0, F.lit("no baseline locations"))
              .when(nv == 0, F.lit("no location visible before"))
              .when(na == 0, F.lit("no active locations after"))
              .when(no > 0, F.lit("flag not suppressed"))
              .when(~attributed, F.lit(f"change not attributed to '{modified_by}'")))
    bad = F.when(reason.isNull(), "PASS").when(
        ~attributed & (no == 0) & (na > 0) & (nv > 0), F.lit("FAIL" if enforce_modified_by else "WARN")).otherwise("FAIL")
    return j.select("PractitionerID", nb.alias("n_baseline"), nv.alias("n_visible_before"), na.alias("n_after"),
                    no.alias("n_offenders"), attributed.alias("attributed"), bad.alias("verdict"), reason.alias("reason"))


def payload_echo(spark: SparkSession, status: DataFrame, payloads: DataFrame, targets: DataFrame, rule_list,
                 rules: DataFrame, rule_pattern: str) -> DataFrame:
    """RECON-8 + JOIN-10/11 per (target process, rule of its entity).

    Payload ids of the process's rows (distinct, non-blank) are looked up;
    every payload must be non-empty (else FAIL); the rule id echoed in payload
    or response and the flag column named in them only warn; the expected
    entity id missing from the rows' business values warns ("batch-level
    row").  ``rule_pattern`` extracts rule tokens (group 1)."""
    rows = status.join(targets.select("process_id").distinct(), "process_id", "left_semi")
    ids = (rows.select("process_id", F.btrim(F.col("payload_response_id").cast("string")).alias("payload_response_id"))
           .where(F.coalesce(F.col("payload_response_id"), F.lit("")) != "").distinct())
    pl = payloads.groupBy("payload_response_id").agg(
        F.min_by(F.struct("payload", "response"), F.coalesce("payload", F.lit(""))).alias("_p"))
    # each payload is read once, down to what the rules ask of it; its text goes no further
    text = F.concat_ws("\n", F.coalesce("_p.payload", F.lit("")), F.coalesce("_p.response", F.lit("")))
    names = sorted({r.final_column.lower() for r in rule_list})
    read = pl.select("payload_response_id", (F.coalesce(F.col("_p.payload"), F.lit("")) != "").alias("present"),
                     F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(rule_pattern), 1), F.lower)).alias("tokens"),
                     F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.lower(text).contains(n)).alias("named"))
    aliases = rule_alias_frame(spark, rule_list).select("rule_key", F.lower("alias").alias("token")).distinct()
    echoed = (read.select("payload_response_id", F.explode("tokens").alias("token")).join(aliases, "token")
              .groupBy("payload_response_id").agg(F.collect_set("rule_key").alias("echoed")))
    facts = read.drop("tokens").join(echoed, "payload_response_id", "left")
    per_payload = ids.join(facts, "payload_response_id", "left")
    flags = spark.createDataFrame([(r.key, r.final_column.lower()) for r in rule_list], "rule_key string, flag string")
    rr = rules.select("rule_key", "entity_type").join(flags, "rule_key")
    ent = rows.select("process_id", "entity_name").distinct()
    pr = ent.join(rr, F.lower(ent["entity_name"]) == F.lower(rr["entity_type"])).select("process_id", "rule_key", "flag")
    pp = pr.join(per_payload, "process_id", "left")
    agg = pp.groupBy("process_id", "rule_key").agg(
        F.count("payload_response_id").alias("n_payloads"),
        F.count_if(F.col("payload_response_id").isNotNull() & ~F.coalesce("present", F.lit(False))).alias("n_empty"),
        F.coalesce(F.bool_or(F.array_contains("echoed", F.col("rule_key"))), F.lit(False)).alias("rule_echoed"),
        F.coalesce(F.bool_or(F.array_contains("named", F.col("flag"))), F.lit(False)).alias("flag_mentioned"))
    bv = (rows.select("process_id", F.btrim(F.coalesce(F.col("business_value").cast("string"), F.lit(""))).alias("bv"))
          .distinct())
    guard = (targets.select("process_id", F.btrim("expected_value").alias("bv")).distinct()
             .join(bv.withColumn("_hit", F.lit(True)), ["process_id", "bv"], "left")
             .groupBy("process_id").agg(F.coalesce(F.bool_and(F.coalesce("_hit", F.lit(False))), F.lit(False))
                                        .alias("identity_confirmed")))
    out = agg.join(guard, "process_id", "left")
    reason = (F.when(F.col("n_payloads") == 0, F.lit("no payload_response_id"))
              .when(F.col("n_empty") > 0, F.lit("payload empty"))
              .when(~F.col("rule_echoed"), F.lit("rule not echoed in payload"))
              .when(~F.col("flag_mentioned"), F.lit("flag column not named in payload"))
              .when(~F.coalesce("identity_confirmed", F.lit(False)), F.lit("batch-level process row")))
    verdict = (F.when(reason.isNull(), "PASS")
               .when((F.col("n_payloads") == 0) | (F.col("n_empty") > 0), "FAIL").otherwise("WARN"))
    return out.select("process_id", "rule_key", F.col("n_payloads").cast("long").alias("n_payloads"),
                      F.col("n_empty").cast("long").alias("n_empty"), "rule_echoed", "flag_mentioned",
                      F.coalesce("identity_confirmed", F.lit(False)).alias("identity_confirmed"),
                      verdict.alias("verdict"), reason.alias("reason"))
