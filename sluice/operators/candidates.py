"""Candidate selection for all rules at once.

Input tables use the directory schema (FIXTURES.md): practices,
practice_locations, user_fields, user_defined_fields, record_types,
practice_types, status_sets.  One shared ``qualifying`` plan feeds both the
top-n candidate list and the distinct counts (RULE-2).

Plan shape, biggest table first: the attribute rows (EAV, the largest table)
are cut by a broadcast semi-join with the (rule, qualifying value) table and
by the effective-date filter before anything shuffles; definitions and lookups
are joined next; locations and practices last.  Only the rule tables carry a
broadcast hint (their size is the registry's); every other join side is left
to the planner and AQE, which broadcast only what they measured as small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.exprs import active_on, text_of
from sluice.rules import rule_values_frame

# ── fixed values: the lookup names the candidate query binds ──────────────
RECORD_TABLE_NAME = "PracticeLocations"
LOCATION_TYPE_NAME = "Service"
STATUS_SET_NAME = "Location Types"

CANDIDATE_COLUMNS = [
    "PracticeID", "TaxIDNumber", "LocationID", "NationalProviderID", "InDirectory", "LocationTypeID",
    "ParentRecID", "UserFieldRecID", "UserDefinedFieldID", "FieldName", "QualifyingValue",
    "DateFrom", "DateTo", "LocationTypeName",
]
CANDIDATE_ORDER = ["PracticeID", "LocationID", "UserFieldRecID"]


@dataclass(frozen=True)
class EntityBinding:
    """Where an entity other than the practice location lives: its table, its
    key (the attributes' parent), the record type of its attributes, and the
    further columns that its rules identify it by."""
    entity: str
    table: str
    key: str
    record_table: str
    columns: tuple[str, ...]


# ── fixed values: the entities with a table of their own ──────────────────
BINDINGS = {b.entity: b for b in (EntityBinding("practitioner", "practitioners", "PractitionerID", "Practitioners", ("NationalProviderID",)),)}


def _bound(rule) -> EntityBinding | None:
    """The binding of a rule that does not work on practice locations."""
    b = BINDINGS.get(rule.entity_type)
    return b if b is not None and b.key in rule.candidate_identity_columns else None


def _c(col, collation: str | None):
    """H8: string comparisons under an optional collation (e.g.
    ``UTF8_LCASE_RTRIM`` for a case- and trailing-blank-insensitive source)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.collate(col, collation) if collation else col


def _live(df: DataFrame, collation: str | None = None) -> DataFrame:
    """FLT-3: soft-deleted rows never take part."""
    return df.where(_c("Archived", collation) == "N")


def qualifying(tables: dict[str, DataFrame], rule_values: DataFrame, as_of: str,
               trigger_fields: list[str] | None = None, values: list[str] | None = None,
               fields: list[str] | None = None, trigger_values: list[str] | None = None,
               collation: str | None = None) -> DataFrame:
    """JOIN-1 + FLT-1..4 + PRJ-3 for every rule: one row per qualifying attribute.

    ``rule_values`` has (rule_key, udf_field_name, trigger_value, qualifying_value).
    ``values`` / ``fields`` are the distinct qualifying codes and attribute
    names of the registry (known on the driver): as literal IN lists they
    reach the parquet scans as pushed filters before any join.
    ``trigger_fields`` names the location columns rules trigger on (default
    ``InDirectory``); the flag is compared exactly, as the source query does.
    """
    trigger_fields = trigger_fields or ["InDirectory"]
    rv = rule_values
    k = lambda c: _c(c, collation)

    uf = _live(tables["user_fields"], collation).where(active_on("DateFrom", "DateTo", as_of))
    uf = (uf.where(k("Value").isin(values)) if values is not None else
          uf.join(rv.select(F.col("qualifying_value").alias("Value")).distinct(), "Value", "left_semi"))
    uf = uf.select("UserFieldRecID", "ParentRecID", "UserDefinedFieldID", "Value", "DateFrom", "DateTo")

    rt = (_live(tables["record_types"], collation).where(k("TableName") == RECORD_TABLE_NAME)
          .select("RecordTypeID"))
    udf = _live(tables["user_defined_fields"], collation)
    udf = (udf.where(k("FieldName").isin(fields)) if fields is not None else
           udf.join(rv.select(F.col("udf_field_name").alias("FieldName")).distinct(), "FieldName", "left_semi"))
    udf = udf.join(rt, "RecordTypeID", "left_semi").select("UserDefinedFieldID", "FieldName")

    ua = uf.join(udf, "UserDefinedFieldID")
    rvr = rv.select("rule_key", F.col("udf_field_name").alias("_rf"), "trigger_value",
                    F.col("qualifying_value").alias("_rv"), *[c for c in rv.columns if c == "trigger_field"])
    if collation:
        attrs = ua.join(rvr, (k(ua["FieldName"]) == rvr["_rf"]) & (k(ua["Value"]) == rvr["_rv"])).drop("_rf", "_rv")
    else:
        attrs = ua.join(rvr, (ua["FieldName"] == rvr["_rf"]) & (ua["Value"] == rvr["_rv"])).drop("_rf", "_rv")

    ss = tables["status_sets"].where(k("StatusSetName") == STATUS_SET_NAME).select("StatusSetID")
    pt = (_live(tables["practice_types"], collation).where(k("PracticeTypeName") == LOCATION_TYPE_NAME)
          .join(ss, "StatusSetID", "left_semi")
          .select(F.col("PracticeTypeID").alias("LocationTypeID"),
                  F.col("PracticeTypeName").alias("LocationTypeName")))

    locs = _live(tables["practice_locations"], collation)
    if trigger_values is not None and len(trigger_fields) == 1:
        locs = locs.where(k(trigger_fields[0]).isin(trigger_values))   # raw column: reaches the scan
    locs = (locs.select("LocationID", "PracticeID", "NationalProviderID", "InDirectory", "LocationTypeID",
                        *[f for f in trigger_fields if f != "InDirectory"])
            .join(pt, "LocationTypeID"))
    practices = _live(tables["practices"], collation).select("PracticeID", "TaxIDNumber")

    trig = (k(trigger_fields[0]) if len(trigger_fields) == 1 else
            F.coalesce(*[F.when(F.col("trigger_field") == f, k(f)) for f in trigger_fields]))
    joined = (attrs.join(locs, attrs["ParentRecID"] == locs["LocationID"])
              .where(trig == F.col("trigger_value"))
              .join(practices, "PracticeID"))
    return joined.select(
        "rule_key", "PracticeID",
        F.coalesce("TaxIDNumber", F.lit("")).alias("TaxIDNumber"),
        "LocationID",
        F.coalesce("NationalProviderID", F.lit("")).alias("NationalProviderID"),
        F.coalesce("InDirectory", F.lit("")).alias("InDirectory"),
        "LocationTypeID", "ParentRecID", "UserFieldRecID", "UserDefinedFieldID", "FieldName",
        F.coalesce("Value", F.lit("")).alias("QualifyingValue"),
        "DateFrom", "DateTo", "LocationTypeName",
    )


def qualifying_for(spark: SparkSession, tables, rules, as_of: str, collation: str | None = None) -> DataFrame:
    rules = list(rules)
    for r in rules:
        if not r.qualifying_udf_values:
            raise ValueError(f"rule {r.key} has no qualifying values: its IN list would be empty")
    fields = sorted({r.trigger_field for r in rules})
    rv = rule_values_frame(spark, rules)
    if len(fields) > 1:
        trig = spark.createDataFrame([(r.key, r.trigger_field) for r in rules], "rule_key string, trigger_field string")
        rv = rv.join(F.broadcast(trig), "rule_key")
    return qualifying(tables, rv, as_of, fields,
                      values=sorted({v for r in rules for v in r.qualifying_udf_values}),
                      fields=sorted({r.udf_field_name for r in rules}),
                      trigger_values=sorted({r.trigger_value for r in rules}), collation=collation)


def entity_columns(binding: EntityBinding, trigger_fields) -> list[str]:
    return [binding.key, *binding.columns, *trigger_fields, "UserFieldRecID", "UserDefinedFieldID", "FieldName", "QualifyingValue", "DateFrom", "DateTo"]


def qualifying_entity(spark: SparkSession, tables: dict[str, DataFrame], binding: EntityBinding, rules, as_of: str,
                      collation: str | None = None) -> DataFrame:
    """JOIN-1 for an entity with a table of its own: live rows whose trigger
    column has the rule's value and that hold a qualifying attribute in
    effect.  The attribute rows are cut first, as for practice locations."""
    rules = list(rules)
    for r in rules:
        if not r.qualifying_udf_values:
            raise ValueError(f"rule {r.key} has no qualifying values: its IN list would be empty")
    k = lambda c: _c(c, collation)
    triggers = sorted({r.trigger_field for r in rules})
    wanted = spark.createDataFrame([(r.key, r.trigger_field, r.trigger_value, r.udf_field_name, v) for r in rules for v in r.qualifying_udf_values],
                                   "rule_key string, trigger_field string, trigger_value string, _rf string, _rv string")
    kinds = _live(tables["record_types"], collation).where(k("TableName") == binding.record_table).select("RecordTypeID")
    fields = (_live(tables["user_defined_fields"], collation).where(k("FieldName").isin(sorted({r.udf_field_name for r in rules})))
              .join(kinds, "RecordTypeID", "left_semi").select("UserDefinedFieldID", "FieldName"))
    values = (_live(tables["user_fields"], collation).where(active_on("DateFrom", "DateTo", as_of))
              .where(k("Value").isin(sorted({v for r in rules for v in r.qualifying_udf_values})))
              .select("UserFieldRecID", F.col("ParentRecID").alias(binding.key), "UserDefinedFieldID", "Value", "DateFrom", "DateTo"))
    attrs = values.join(fields, "UserDefinedFieldID").join(wanted, (k("FieldName") == F.col("_rf")) & (k("Value") == F.col("_rv")))
    rows = (_live(tables[binding.table], collation)
            .select(binding.key, *binding.columns, *triggers))
    hit = F.coalesce(*[F.when(F.col("trigger_field") == t, k(t) == F.col("trigger_value")) for t in triggers])
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return (attrs.join(rows, binding.key).where(hit)
            .select("rule_key", binding.key, *[blank(c) for c in (*binding.columns, *triggers)], "UserFieldRecID", "UserDefinedFieldID", "FieldName",
                    F.coalesce("Value", F.lit("")).alias("QualifyingValue"), "DateFrom", "DateTo"))


def _by_binding(rules) -> tuple[list, dict[EntityBinding, list]]:
    """(rules on practice locations, rules of each bound entity)."""
    own: dict[EntityBinding, list] = {}
    rest = []
    for r in rules:
        b = _bound(r)
        own.setdefault(b, []).append(r) if b else rest.append(r)
    return rest, own


def candidates(spark: SparkSession, tables, rules, as_of: str, top_n: int = 5,
               collation: str | None = None) -> DataFrame:
    """ORD-1 + SET-1: ``DISTINCT TOP n`` per rule, ordered by practice,
    location and attribute row (remaining columns break ties).  Rules of a
    bound entity are ordered by its key; columns that a rule's entity lacks are null."""
    if not 1 <= top_n <= 1000:
        raise ValueError("top_n must be between 1 and 1000")
    rules, bound = _by_binding(rules)
    out = None
    for b, own in bound.items():
        found = qualifying_entity(spark, tables, b, own, as_of, collation).distinct()
        order = [b.key, "UserFieldRecID", *[c for c in found.columns if c not in (b.key, "UserFieldRecID", "rule_key")]]
        w = Window.partitionBy("rule_key").orderBy(*[F.col(c).asc_nulls_first() for c in order])
        part = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if not rules:
        return out
    mine = _location_candidates(spark, tables, rules, as_of, top_n, collation)
    return mine if out is None else mine.unionByName(out, allowMissingColumns=True)


def _location_candidates(spark: SparkSession, tables, rules, as_of: str, top_n: int, collation: str | None) -> DataFrame:
    q = qualifying_for(spark, tables, rules, as_of, collation).distinct()
    order = CANDIDATE_ORDER + [c for c in CANDIDATE_COLUMNS if c not in CANDIDATE_ORDER]
    w = Window.partitionBy("rule_key").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return q.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def candidate_counts(spark: SparkSession, tables, rules, as_of: str, collation: str | None = None) -> DataFrame:
    """AGG-1: distinct locations (of a bound entity: distinct keys) per rule;
    rules without any candidate report 0."""
    rest, bound = _by_binding(rules)
    out = counts_of(spark, qualifying_for(spark, tables, rest, as_of, collation), rest) if rest else None
    for b, own in bound.items():
        part = counts_of(spark, qualifying_entity(spark, tables, b, own, as_of, collation), own, b.key)
        out = part if out is None else out.unionByName(part)
    return out


def counts_of(spark: SparkSession, found: DataFrame, rules, key: str = "LocationID") -> DataFrame:
    """The counts of ``candidate_counts`` from the qualifying rows themselves."""
    rules = list(rules)
    counts = found.groupBy("rule_key").agg(F.countDistinct(key).alias("candidate_count"))
    keys = F.broadcast(spark.createDataFrame([(r.key, r.rule_id) for r in rules], "rule_key string, rule_id int"))
    return (keys.join(counts, "rule_key", "left")
            .select("rule_key", "rule_id", F.coalesce("candidate_count", F.lit(0)).cast("long").alias("candidate_count")))


def check_preconditions(spark: SparkSession, cands: DataFrame, rules) -> DataFrame:
    """RULE-1: trigger, qualifying value and identity checks per candidate row.

    ``failed_checks`` lists the failed checks in order: ``trigger``,
    ``qualifying_value`` and ``identity:<column>`` per blank identity column.
    A blank id counts as missing (EXP-1: null, '' and numeric 0 alike).
    """
    rules = list(rules)
    info = F.broadcast(spark.createDataFrame(
        [(r.key, r.trigger_field, r.trigger_value, list(r.qualifying_udf_values)) for r in rules],
        "rule_key string, trigger_field string, trigger_value string, qualifying array<string>"))
    df = cands.join(info, "rule_key")
    trigger_cols = sorted({r.trigger_field for r in rules})
    actual = F.coalesce(*[F.when(F.col("trigger_field") == f, text_of(cands, f)) for f in trigger_cols])
    checks = [
        F.when(F.upper(actual) != F.upper(F.btrim(F.col("trigger_value"))), F.lit("trigger")),
        F.when(~F.array_contains("qualifying", text_of(cands, "QualifyingValue")), F.lit("qualifying_value")),
    ]
    identity_cols = []
    for r in rules:
        for c in r.candidate_identity_columns:
            if c not in identity_cols:
                identity_cols.append(c)
    by_rule = {r.key: set(r.candidate_identity_columns) for r in rules}
    for c in identity_cols:
        needed = [k for k, cols in by_rule.items() if c in cols]
        checks.append(F.when(F.col("rule_key").isin(needed) & (text_of(cands, c) == ""), F.lit(f"identity:{c}")))
    failed = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("failed_checks", failed).withColumn("passed", F.size("failed_checks") == 0)


def code_audit(tables: dict[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """AGG-15 over the whole attribute table: per attribute name, how many
    values, how many distinct, how many are not 5-digit codes."""
    uf = _live(tables["user_fields"])
    if as_of:
        uf = uf.where(active_on("DateFrom", "DateTo", as_of))
    udf = _live(tables["user_defined_fields"]).select("UserDefinedFieldID", "FieldName")
    # the attribute table is cut to one row per (definition, value) before it meets the names
    values = uf.groupBy("UserDefinedFieldID", F.coalesce("Value", F.lit("")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return (values.join(udf, "UserDefinedFieldID").groupBy("FieldName", "v").agg(F.sum("n").alias("n"))
            .groupBy("FieldName").agg(
                F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_distinct"),
                F.coalesce(F.sum(F.when(~F.col("v").rlike("^[0-9]{5}$"), F.col("n"))), F.lit(0)).alias("n_not_code")))
