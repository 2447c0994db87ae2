"""Registered queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
SQL over the driver's tables computing the same answer independently (only
the input views in ``driver_views`` are shared text).  Output columns are
aliased identically on both sides; timestamps leave as text; counts as
BIGINT.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.exprs import canon_id, process_uuid, text_norm
from sluice.operators import candidates as cand
from sluice.operators import increments as inc
from sluice.rules import SuppressionRule
from sluice.session import materialize, scratch_folder
from sluice.sources.catalog import Catalog, oracle_with
from sluice.sources.driver_views import ALL_VIEWS, AS_OF

DIRECTORY_TABLES = ["practices", "practitioners", "practice_locations", "user_fields", "user_defined_fields",
                    "record_types", "practice_types", "status_sets"]


def _rule(key, rule_id, flow, trigger, field, values, prefix, expected="directory-auto"):
    return SuppressionRule(
        key=key, rule_id=rule_id, description=f"{flow} rule {rule_id}", flow_name=flow, entity_type=flow,
        trigger_field="InDirectory", trigger_value=trigger, udf_field_name=field,
        qualifying_udf_values=tuple(values),
        candidate_identity_columns=("PracticeID", "LocationID", "TaxIDNumber"),
        outbound_identity_map=(("PracticeID", "PracticeID"), ("LocationID", "BillingLocationID")),
        outbound_search_field="PracticeID", outbound_column="DataSource", outbound_expected_value=expected,
        outbound_prefix=prefix, status_business_value_field="TaxIDNumber",
        final_key_columns=("LocationID",), final_column="InDirectory", final_expected_values=("N",),
        expected_modified_by="dataloader",
    )


# ── fixed values: the rules evaluated against the driver binding ──────────
# Two rules share id 15 and differ by flow (H11); one rule selects nothing.
DRIVER_RULES = [
    _rule("practice_f_ar", 15, "practice", "F", "ECONOMY", ("A", "R"), "outbound/practice_update/"),
    _rule("practitioner_o_n", 15, "practitioner", "O", "STANDARD", ("N",), "outbound/practitioner_update/"),
    _rule("practice_f_z", 7, "practice", "F", "ECONOMY", ("Z",), "outbound/practice_update/"),
]


# The registered practitioner rule's shape (its own trigger, key and final
# column), with codes that the driver's attribute table holds.
PRACTITIONER_RULES = [SuppressionRule(
    key="practitioner_military", rule_id=15, description="practitioner binding", flow_name="practitioner", entity_type="practitioner",
    trigger_field="ActiveMilitaryOrReserve", trigger_value="Y", udf_field_name="PROMO", qualifying_udf_values=("A", "R", "00003"),
    candidate_identity_columns=("PractitionerID", "NationalProviderID"),
    outbound_identity_map=(("NationalProviderID", "NationalProviderID"),), outbound_search_field="NationalProviderID",
    outbound_column="ActiveMilitaryOrReserve", outbound_expected_value="N", outbound_prefix="outbound/practitioner_update/",
    status_business_value_field="NationalProviderID", final_key_columns=("PractitionerID",),
    final_column="ActiveMilitaryOrReserve", final_expected_values=("N",))]


_CATALOGS: dict[tuple, Catalog] = {}


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """One catalog per (application, folder): view SQL is parsed once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CATALOGS:
        _CATALOGS[key] = Catalog(spark, sf_dir, ALL_VIEWS)
    return _CATALOGS[key]


def directory(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = catalog(spark, sf_dir)
    return {n: c[n] for n in DIRECTORY_TABLES}


def _ts_text(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss").alias(c)


def _sql_ts_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def _sql_values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


RULE_VALUES_SQL = _sql_values(
    [(r.key, r.udf_field_name, r.trigger_value, v) for r in DRIVER_RULES for v in r.qualifying_udf_values],
    ["rule_key", "udf_field_name", "trigger_value", "qualifying_value"])
RULES_SQL = _sql_values([(r.key, r.rule_id, r.flow_name, r.outbound_prefix) for r in DRIVER_RULES],
                        ["rule_key", "rule_id", "flow_name", "outbound_prefix"])

# ── candidates ────────────────────────────────────────────────────────────
_QUALIFYING_SQL = f"""
location_kinds AS (
  SELECT t.PracticeTypeID, t.PracticeTypeName
  FROM (SELECT * FROM practice_types WHERE Archived = 'N' AND PracticeTypeName = 'Service') t
  WHERE EXISTS (SELECT 1 FROM status_sets s WHERE s.StatusSetName = 'Location Types' AND s.StatusSetID = t.StatusSetID)),
location_fields AS (
  SELECT d.UserDefinedFieldID, d.FieldName
  FROM (SELECT * FROM user_defined_fields WHERE Archived = 'N') d
  WHERE d.RecordTypeID IN (SELECT RecordTypeID FROM record_types WHERE Archived = 'N' AND TableName = 'PracticeLocations')),
field_values AS (
  SELECT * FROM user_fields
  WHERE Archived = 'N' AND DateFrom IS NOT NULL
    AND DATE '{AS_OF}' >= CAST(DateFrom AS DATE)
    AND DATE '{AS_OF}' <= COALESCE(CAST(DateTo AS DATE), DATE '{AS_OF}')),
wanted AS (SELECT * FROM {RULE_VALUES_SQL}),
attributes AS (
  SELECT wanted.rule_key, wanted.trigger_value, v.*, f.FieldName
  FROM wanted, field_values v, location_fields f
  WHERE f.UserDefinedFieldID = v.UserDefinedFieldID
    AND wanted.udf_field_name = f.FieldName AND wanted.qualifying_value = v.Value),
places AS (
  SELECT l.*, k.PracticeTypeName, o.TaxIDNumber
  FROM (SELECT * FROM practice_locations WHERE Archived = 'N') l, location_kinds k,
       (SELECT PracticeID, TaxIDNumber FROM practices WHERE Archived = 'N') o
  WHERE k.PracticeTypeID = l.LocationTypeID AND o.PracticeID = l.PracticeID),
qualifying AS (
  SELECT a.rule_key, l.PracticeID, COALESCE(l.TaxIDNumber, '') AS TaxIDNumber, l.LocationID,
         COALESCE(l.NationalProviderID, '') AS NationalProviderID, COALESCE(l.InDirectory, '') AS InDirectory,
         l.LocationTypeID, a.ParentRecID, a.UserFieldRecID, a.UserDefinedFieldID, a.FieldName,
         COALESCE(a.Value, '') AS QualifyingValue, a.DateFrom, a.DateTo, l.PracticeTypeName AS LocationTypeName
  FROM attributes a, places l
  WHERE l.LocationID = a.ParentRecID AND l.InDirectory = a.trigger_value
)"""


def _with(*views: str, extra: str = "") -> str:
    w = oracle_with(ALL_VIEWS, list(views))
    if extra:
        w = (w.rstrip("\n") + ",\n" + extra + "\n") if w else "WITH " + extra + "\n"
    return w


def q_candidates_topn(spark, sf_dir, top_n: int = 5):
    df = cand.candidates(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF, top_n)
    return df.select("rule_key", "rank", *[c for c in cand.CANDIDATE_COLUMNS if c not in ("DateFrom", "DateTo")],
                     _ts_text("DateFrom"), _ts_text("DateTo"))


_TOPN_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in
                        cand.CANDIDATE_ORDER + [c for c in cand.CANDIDATE_COLUMNS if c not in cand.CANDIDATE_ORDER])
O_CANDIDATES_TOPN = _with(*DIRECTORY_TABLES, extra=_QUALIFYING_SQL) + f"""
SELECT rule_key, rank, PracticeID, TaxIDNumber, LocationID, NationalProviderID, InDirectory, LocationTypeID,
       ParentRecID, UserFieldRecID, UserDefinedFieldID, FieldName, QualifyingValue, LocationTypeName,
       {_sql_ts_text('DateFrom')}, {_sql_ts_text('DateTo')}
FROM (SELECT d.*, CAST(row_number() OVER (PARTITION BY rule_key ORDER BY {_TOPN_ORDER}) AS INT) AS rank
      FROM (SELECT DISTINCT * FROM qualifying) d) x
WHERE rank <= 5"""


def q_candidate_counts(spark, sf_dir):
    return cand.candidate_counts(spark, directory(spark, sf_dir), [*DRIVER_RULES, *PRACTITIONER_RULES], AS_OF)


_PRACTITIONER = PRACTITIONER_RULES[0]
_PRACTITIONER_SQL = f"""
practitioner_fields AS (
  SELECT d.UserDefinedFieldID, d.FieldName FROM user_defined_fields d
  WHERE d.Archived = 'N' AND d.FieldName = '{_PRACTITIONER.udf_field_name}'
    AND EXISTS (SELECT 1 FROM record_types t WHERE t.RecordTypeID = d.RecordTypeID AND t.Archived = 'N' AND t.TableName = 'Practitioners')),
pract AS (
  SELECT '{_PRACTITIONER.key}' AS rule_key, p.PractitionerID, COALESCE(p.NationalProviderID, '') AS NationalProviderID,
         p.ActiveMilitaryOrReserve, v.UserFieldRecID, f.UserDefinedFieldID, f.FieldName, v.Value AS QualifyingValue, v.DateFrom, v.DateTo
  FROM practitioners p, field_values v, practitioner_fields f
  WHERE p.Archived = 'N' AND p.ActiveMilitaryOrReserve = 'Y' AND v.ParentRecID = p.PractitionerID
    AND v.UserDefinedFieldID = f.UserDefinedFieldID AND v.Value IN ({", ".join(f"'{v}'" for v in _PRACTITIONER.qualifying_udf_values)}))"""


def q_practitioner_candidates(spark, sf_dir):
    df = cand.candidates(spark, directory(spark, sf_dir), PRACTITIONER_RULES, AS_OF, 5)
    return df.select(*[c for c in df.columns if c not in ("DateFrom", "DateTo")], _ts_text("DateFrom"), _ts_text("DateTo"))


O_PRACTITIONER_CANDIDATES = _with(*DIRECTORY_TABLES, extra=_QUALIFYING_SQL + "," + _PRACTITIONER_SQL) + f"""
SELECT rule_key, PractitionerID, NationalProviderID, ActiveMilitaryOrReserve, UserFieldRecID, UserDefinedFieldID, FieldName,
       QualifyingValue, CAST(rank AS INT) AS rank, {_sql_ts_text('DateFrom')}, {_sql_ts_text('DateTo')}
FROM (SELECT *, row_number() OVER (PARTITION BY rule_key ORDER BY PractitionerID, UserFieldRecID) AS rank FROM (SELECT DISTINCT * FROM pract) d) x
WHERE rank <= 5"""


def q_practitioner_final_state(spark, sf_dir):
    from sluice.operators import finalstate

    c = catalog(spark, sf_dir)
    found = cand.qualifying_entity(spark, directory(spark, sf_dir), cand.BINDINGS["practitioner"], PRACTITIONER_RULES, AS_OF)
    return finalstate.final_state(spark, found, finalstate.entity_state_rows(c["practitioners_after"]), PRACTITIONER_RULES)


O_PRACTITIONER_FINAL_STATE = _with(*DIRECTORY_TABLES, "practitioners_after", extra=_QUALIFYING_SQL + "," + _PRACTITIONER_SQL) + """
SELECT rule_key, CAST(PractitionerID AS VARCHAR) AS PractitionerID, found,
       CASE WHEN found THEN COALESCE(NULLIF(v, ''), 'NULL') END AS actual_value,
       CASE WHEN found AND v = 'N' THEN 'PASS' ELSE 'FAIL' END AS verdict,
       CASE WHEN NOT found THEN 'final row not found'
            WHEN v <> 'N' THEN 'expected ActiveMilitaryOrReserve in [''N''], found ' || COALESCE(NULLIF(v, ''), 'NULL') END AS reason
FROM (SELECT c.rule_key, c.PractitionerID, a.PractitionerID IS NOT NULL AS found, upper(trim(COALESCE(a.ActiveMilitaryOrReserve, ''))) AS v
      FROM (SELECT DISTINCT rule_key, PractitionerID FROM pract) c
      LEFT JOIN (SELECT * FROM practitioners_after WHERE Archived = 'N') a ON a.PractitionerID = c.PractitionerID) x"""


O_CANDIDATE_COUNTS = _with(*DIRECTORY_TABLES, extra=_QUALIFYING_SQL + "," + _PRACTITIONER_SQL) + f"""
SELECT r.rule_key, CAST(r.rule_id AS INT) AS rule_id,
       CAST(COALESCE((SELECT COUNT(DISTINCT q.LocationID) FROM qualifying q WHERE q.rule_key = r.rule_key), 0) AS BIGINT)
         AS candidate_count
FROM {RULES_SQL} r
UNION ALL
SELECT '{_PRACTITIONER.key}', 15, (SELECT CAST(count(DISTINCT PractitionerID) AS BIGINT) FROM pract)"""


def q_candidate_preconditions(spark, sf_dir):
    c = cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF)
    checked = cand.check_preconditions(spark, c, DRIVER_RULES)
    return checked.select("rule_key", "LocationID", "UserFieldRecID", "passed",
                          F.array_join("failed_checks", ",").alias("failed_checks"))


O_CANDIDATE_PRECONDITIONS = _with(*DIRECTORY_TABLES, extra=_QUALIFYING_SQL) + """
SELECT rule_key, LocationID, UserFieldRecID, failed_checks = '' AS passed, failed_checks
FROM (
  SELECT rule_key, LocationID, UserFieldRecID,
         concat_ws(',',
           CASE WHEN CAST(PracticeID AS VARCHAR) IN ('0') OR PracticeID IS NULL THEN 'identity:PracticeID' END,
           CASE WHEN LocationID = 0 OR LocationID IS NULL THEN 'identity:LocationID' END,
           CASE WHEN trim(COALESCE(TaxIDNumber, '')) = '' THEN 'identity:TaxIDNumber' END) AS failed_checks
  FROM qualifying) x"""


def q_code_audit(spark, sf_dir):
    return cand.code_audit(directory(spark, sf_dir), AS_OF)


O_CODE_AUDIT = _with("user_fields", "user_defined_fields") + f"""
SELECT udf.FieldName,
       CAST(count(*) AS BIGINT) AS n_values,
       CAST(count(DISTINCT COALESCE(uf.Value, '')) AS BIGINT) AS n_distinct,
       CAST(count(*) FILTER (WHERE NOT regexp_full_match(COALESCE(uf.Value, ''), '[0-9]{{5}}')) AS BIGINT) AS n_not_code
FROM user_fields uf JOIN user_defined_fields udf
  ON udf.UserDefinedFieldID = uf.UserDefinedFieldID AND udf.Archived = 'N'
WHERE uf.Archived = 'N'
  AND CAST(uf.DateFrom AS DATE) <= DATE '{AS_OF}'
  AND (uf.DateTo IS NULL OR CAST(uf.DateTo AS DATE) >= DATE '{AS_OF}')
GROUP BY udf.FieldName"""


QUERIES = {
    "candidates_topn": q_candidates_topn,
    "candidate_counts": q_candidate_counts,
    "practitioner_candidates": q_practitioner_candidates,
    "practitioner_final_state": q_practitioner_final_state,
    "candidate_preconditions": q_candidate_preconditions,
    "code_audit": q_code_audit,
}

ORACLE = {
    "candidates_topn": O_CANDIDATES_TOPN,
    "candidate_counts": O_CANDIDATE_COUNTS,
    "practitioner_candidates": O_PRACTITIONER_CANDIDATES,
    "practitioner_final_state": O_PRACTITIONER_FINAL_STATE,
    "candidate_preconditions": O_CANDIDATE_PRECONDITIONS,
    "code_audit": O_CODE_AUDIT,
}


# ── process status ────────────────────────────────────────────────────────
from sluice.operators import status as st  # noqa: E402


def _status_inputs(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return c["splits"], c["process_status"], c["payload_response"]


def q_split_status(spark, sf_dir):
    splits, status, _ = _status_inputs(spark, sf_dir)
    return st.split_results(splits, status)


_SPLIT_SQL = """
cls AS (SELECT process_id, upper(trim(COALESCE(status, ''))) AS s FROM process_status),
cnt AS (SELECT process_id, count(*) AS total,
               count(*) FILTER (WHERE s = 'COMPLETED') AS completed,
               count(*) FILTER (WHERE s IN ('FAILED', 'ERROR')) AS errored,
               count(*) FILTER (WHERE s NOT IN ('COMPLETED', 'FAILED', 'ERROR')) AS stuck
        FROM cls GROUP BY process_id),
split_res AS (
  SELECT sp.position, sp.split_process_id,
         CAST(COALESCE(total, 0) AS BIGINT) AS total_sub_processes,
         CAST(COALESCE(completed, 0) AS BIGINT) AS completed,
         CAST(COALESCE(errored, 0) AS BIGINT) AS errored,
         CAST(COALESCE(stuck, 0) AS BIGINT) AS stuck,
         CASE WHEN COALESCE(total, 0) > 0 AND COALESCE(errored, 0) = 0 AND COALESCE(stuck, 0) = 0
              THEN 'PASS' ELSE 'FAIL' END AS status,
         CASE WHEN COALESCE(total, 0) = 0 THEN 'No records in process_status' END AS reason
  FROM splits sp LEFT JOIN cnt ON cnt.process_id = sp.split_process_id)"""

O_SPLIT_STATUS = _with("splits", "process_status", extra=_SPLIT_SQL) + "SELECT * FROM split_res"

_TOTALS_SQL = """
totals AS (
  SELECT CAST(count(*) AS BIGINT) AS total_splits,
         CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS splits_passed,
         CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS splits_failed,
         CAST(COALESCE(sum(total_sub_processes), 0) AS BIGINT) AS total_sub_processes,
         CAST(COALESCE(sum(completed), 0) AS BIGINT) AS total_completed,
         CAST(COALESCE(sum(errored), 0) AS BIGINT) AS total_errored,
         CAST(COALESCE(sum(stuck), 0) AS BIGINT) AS total_stuck
  FROM split_res)"""


def q_split_totals(spark, sf_dir):
    return st.split_totals(q_split_status(spark, sf_dir))


O_SPLIT_TOTALS = _with("splits", "process_status", extra=_SPLIT_SQL + "," + _TOTALS_SQL) + """
SELECT *, CASE WHEN splits_failed = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM totals"""


def q_error_details(spark, sf_dir):
    splits, status, payloads = _status_inputs(spark, sf_dir)
    return st.error_details(splits, status, payloads)


_ERRORS_SQL = """
e AS (
  SELECT sp.position, sp.split_process_id, ps.id, ps.sub_process_name, ps.business_value, ps.status, ps.notes,
         trim(COALESCE(ps.error, '')) AS err, COALESCE(ps.payload_response_id, '') AS pr
  FROM process_status ps JOIN splits sp ON sp.split_process_id = ps.process_id
  WHERE upper(trim(COALESCE(ps.status, ''))) IN ('FAILED', 'ERROR')),
pl AS (SELECT payload_response_id, arg_min(response, COALESCE(response, '')) AS response
       FROM payload_response GROUP BY payload_response_id),
details AS (
  SELECT e.position, e.split_process_id, e.id,
         COALESCE(NULLIF(e.sub_process_name, ''), 'unknown') AS sub_process,
         e.sub_process_name,
         COALESCE(e.business_value, '') AS business_value,
         trim(COALESCE(e.status, '')) AS status,
         CASE WHEN lower(e.err) = 'schema-validation-error' THEN 'schema-validation-error'
              ELSE COALESCE(NULLIF(e.err, ''), 'unknown') END AS error_type,
         e.err AS raw_error,
         CASE WHEN lower(e.err) <> 'schema-validation-error' THEN COALESCE(NULLIF(e.err, ''), '(error field is empty)')
              WHEN e.pr = '' THEN '(no payload_response_id available)'
              WHEN pl.payload_response_id IS NULL THEN '(no payload_response record for id=' || e.pr || ')'
              WHEN COALESCE(pl.response, '') = '' THEN '(response field is empty)'
              WHEN (trim(pl.response) LIKE '{%' OR trim(pl.response) LIKE '[%') AND json_valid(pl.response)
                   THEN CAST(json(pl.response) AS VARCHAR)
              ELSE pl.response END AS detailed_reason,
         e.pr AS payload_response_id,
         COALESCE(e.notes, '') AS notes
  FROM e LEFT JOIN pl ON lower(e.err) = 'schema-validation-error' AND e.pr <> '' AND pl.payload_response_id = e.pr)"""

O_ERROR_DETAILS = _with("splits", "process_status", "payload_response", extra=_ERRORS_SQL) + """
SELECT *, left(array_to_string(list_slice(string_split_regex(detailed_reason, '\r?\n'), 1, 20), chr(10)), 2000) AS reason_preview
FROM details"""


def q_failure_breakdown(spark, sf_dir):
    return st.failure_breakdown(q_error_details(spark, sf_dir))


O_FAILURE_BREAKDOWN = _with("splits", "process_status", "payload_response", extra=_ERRORS_SQL) + """
SELECT error_type, occurrences, first_position, sample_sub_process, sample_business_value, sample_reason
FROM (
  SELECT error_type, CAST(count(*) OVER (PARTITION BY error_type) AS BIGINT) AS occurrences,
         position AS first_position, sub_process AS sample_sub_process, business_value AS sample_business_value,
         left(detailed_reason, 300) AS sample_reason,
         row_number() OVER (PARTITION BY error_type ORDER BY position, sub_process_name NULLS LAST, id) AS rn
  FROM details) x
WHERE rn = 1"""


def q_stuck_top10(spark, sf_dir):
    splits, status, _ = _status_inputs(spark, sf_dir)
    return st.stuck_details(splits, status, 10)


O_STUCK_TOP10 = _with("splits", "process_status") + """
SELECT position, split_process_id, CAST(rank AS INT) AS rank, id, sub_process, business_value, status
FROM (
  SELECT sp.position, sp.split_process_id, ps.id,
         COALESCE(NULLIF(ps.sub_process_name, ''), 'unknown') AS sub_process,
         COALESCE(ps.business_value, '') AS business_value,
         COALESCE(NULLIF(trim(COALESCE(ps.status, '')), ''), '(null)') AS status,
         row_number() OVER (PARTITION BY sp.position, sp.split_process_id
                            ORDER BY ps.sub_process_name ASC NULLS LAST, ps.id) AS rank
  FROM process_status ps JOIN splits sp ON sp.split_process_id = ps.process_id
  WHERE upper(trim(COALESCE(ps.status, ''))) NOT IN ('COMPLETED', 'FAILED', 'ERROR')) x
WHERE rank <= 10"""


def q_terminal_state(spark, sf_dir):
    _, status, _ = _status_inputs(spark, sf_dir)
    return st.terminal_state(status)


O_TERMINAL_STATE = _with("process_status", extra="""
errs AS (
  SELECT process_id, string_agg(e || ' (' || CAST(n AS VARCHAR) || ')', '; ' ORDER BY place) AS errors
  FROM (SELECT *, row_number() OVER (PARTITION BY process_id ORDER BY n DESC, e) AS place
        FROM (SELECT process_id, COALESCE(NULLIF(trim(COALESCE(error, '')), ''), upper(trim(COALESCE(status, '')))) AS e, count(*) AS n
              FROM process_status WHERE upper(trim(COALESCE(status, ''))) IN ('FAILED', 'ERROR') GROUP BY ALL) g) r
  WHERE place <= 5 GROUP BY process_id)""") + """
SELECT b.*, COALESCE(errs.errors, '') AS errors, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (
  SELECT *, CASE WHEN n_errors > 0 THEN 'status rows report errors'
                 WHEN n_in_progress > 0 THEN 'still IN-PROGRESS'
                 WHEN n_loader = 0 THEN 'no Data-Loader-File row'
                 WHEN NOT loader_done THEN 'loader did not complete' END AS reason
  FROM (
    SELECT process_id,
           CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE s IN ('FAILED', 'ERROR')) AS BIGINT) AS n_errors,
           CAST(count(*) FILTER (WHERE s = 'IN-PROGRESS') AS BIGINT) AS n_in_progress,
           CAST(count(*) FILTER (WHERE sub_process_name = 'Data-Loader-File') AS BIGINT) AS n_loader,
           CAST(count(*) FILTER (WHERE sub_process_name = 'File-Record') AS BIGINT) AS n_record,
           COALESCE(bool_or(sub_process_name = 'Data-Loader-File' AND s IN ('COMPLETED', 'SUCCESS')), false)
             AS loader_done,
           COALESCE(array_to_string(list_sort(list(DISTINCT s) FILTER (WHERE sub_process_name = 'Data-Loader-File')), ','), '')
             AS loader_statuses,
           COALESCE(array_to_string(list_sort(list(DISTINCT s) FILTER (WHERE sub_process_name = 'File-Record')), ','), '')
             AS record_statuses
    FROM (SELECT *, upper(trim(COALESCE(status, ''))) AS s FROM process_status) t
    GROUP BY process_id) a) b LEFT JOIN errs ON errs.process_id = b.process_id"""


def _half_time(status):
    """The middle of the status rows' time span, to the second."""
    low, high = status.agg(F.min(F.unix_timestamp("updated_at")), F.max(F.unix_timestamp("updated_at"))).first()
    return dt.datetime.fromtimestamp((low + high) // 2, dt.timezone.utc).replace(tzinfo=None), dt.datetime.fromtimestamp(high + 1, dt.timezone.utc).replace(tzinfo=None)


def q_split_status_incremental(spark, sf_dir):
    """Two delta runs, the second one repeated: the same answer as the full scan."""
    splits, status, _ = _status_inputs(spark, sf_dir)
    folder = scratch_folder(spark, "totals")
    for until in (*_half_time(status), _half_time(status)[1]):
        counters = inc.split_counters(spark, folder).advance(status, "updated_at", st.process_counters, until)
    return st.split_results(splits, counters=counters)

QUERIES.update({
    "split_status": q_split_status,
    "split_totals": q_split_totals,
    "error_details": q_error_details,
    "failure_breakdown": q_failure_breakdown,
    "stuck_top10": q_stuck_top10,
    "terminal_state": q_terminal_state,
    "split_status_incremental": q_split_status_incremental,
})
ORACLE.update({
    "split_status": O_SPLIT_STATUS,
    "split_totals": O_SPLIT_TOTALS,
    "error_details": O_ERROR_DETAILS,
    "failure_breakdown": O_FAILURE_BREAKDOWN,
    "stuck_top10": O_STUCK_TOP10,
    "terminal_state": O_TERMINAL_STATE,
    "split_status_incremental": O_SPLIT_STATUS,
})


# ── run logs ──────────────────────────────────────────────────────────────
from sluice.operators import logs as lg  # noqa: E402
from sluice.rules import rules_frame  # noqa: E402
from sluice.sources import files, sinks  # noqa: E402

OUTBOUND_BUCKET = "outbound-bucket"
C = lg.DEFAULT_CONTRACT


def _logs(spark, sf_dir):
    """(runs, picks, picked summary, picked facts): two passes over the lines."""
    c = catalog(spark, sf_dir)
    summary, facts = lg.scan_logs(c["run_log_captures"], C)
    picks = lg.pick_source(summary)
    return c["runs"], picks, lg.picked(summary, picks), lg.picked(facts, picks)


def _artifacts(runs, facts, rules):
    return lg.artifacts_by_rule(lg.log_artifacts(facts, C), runs, rules, OUTBOUND_BUCKET)


def q_log_source_pick(spark, sf_dir):
    return _logs(spark, sf_dir)[1]


# The ``file`` source as real log files: an early copy that lacks every second
# line and, for two runs of three, a later whole one, both in the first folder;
# the newest copies lie in the second folder, which counts only where the first has none.
LOG_FOLDERS = ("primary", "archive")
_RUN_NO = "CAST(substr(run_id, 4) AS INT)"
_LOG_COPIES = (("primary", "1", f"line_no % 2 = 0 AND {_RUN_NO} % 5 <> 4"), ("primary", "2", f"{_RUN_NO} % 3 <> 0 AND {_RUN_NO} % 5 <> 4"), ("archive", "3", "true"))
_NEWEST_COPY = f"({_RUN_NO} % 5 = 4 OR {_RUN_NO} % 3 <> 0 OR line_no % 2 = 0)"


def _log_files(spark, lines):
    """Write the copies one after the other; their listing with logical paths."""
    folder = scratch_folder(spark, "log-files")
    for where, copy, some in _LOG_COPIES:
        name = F.concat(F.lit("output-"), "run_id", F.lit(f"-{copy}.log"))
        (lines.where(some).select(F.lit(where).alias("folder"), name.alias("name"), "line_no", F.col("message").alias("value"))
         .repartition("name").sortWithinPartitions("folder", "name", "line_no").drop("line_no")
         .write.mode("append").partitionBy("folder", "name").text(folder))
    listing = files.list_files(spark, folder)
    part = lambda c: F.regexp_extract("path", f"/{c}=([^/]*)/", 1)
    plain = ~F.substring_index("path", "/", -1).rlike("^[._]")      # no checksum or commit files
    return (listing.where((part("name") != "") & plain)
            .select(F.col("path").alias("stored"), F.concat_ws("/", part("folder"), part("name")).alias("path"), "size", "modified_at"))


def q_log_file_pick(spark, sf_dir):
    """The choice among sources when ``file`` is each run's newest log file on disk."""
    captures = catalog(spark, sf_dir)["run_log_captures"]
    listing = _log_files(spark, captures.where(F.col("source") == "file"))
    found = lg.newest_log_captures(listing, captures.select("run_id").distinct(), list(LOG_FOLDERS), ["output-{run_id}-*.log"], r"(jr_[0-9]+)")
    line_no = F.struct(F.lit(0).cast("long").alias("seq"), F.col("line_no").cast("long").alias("pos"))
    others = captures.where(F.col("source") != "file").withColumn("line_no", line_no)
    return lg.pick_source(lg.log_summary(others.unionByName(found), C))


def q_log_report(spark, sf_dir):
    return lg.run_report(*_logs(spark, sf_dir)[2:])


def q_log_rule_counts(spark, sf_dir):
    return lg.rule_counts(_logs(spark, sf_dir)[3]).drop("value_line")


def q_artifact_by_rule(spark, sf_dir):
    runs, _, _, facts = _logs(spark, sf_dir)
    return _artifacts(runs, facts, rules_frame(spark, DRIVER_RULES))


def _nested_rules(spark):
    """The registry with one rule's prefix around the others'."""
    prefix = F.when(F.col("rule_key") == "practice_f_z", "outbound/").otherwise(F.col("outbound_prefix"))
    return rules_frame(spark, DRIVER_RULES).withColumn("outbound_prefix", prefix)


def q_artifact_longest_prefix(spark, sf_dir):
    runs, _, _, facts = _logs(spark, sf_dir)
    return _artifacts(runs, facts, _nested_rules(spark))


def q_process_id_unique(spark, sf_dir):
    runs, _, _, facts = _logs(spark, sf_dir)
    rules = rules_frame(spark, DRIVER_RULES)
    return lg.process_id_check(_artifacts(runs, facts, rules), runs, rules)


def q_result_tables(spark, sf_dir):
    """A verdict table written by rule and run, one run's part written again, and read back."""
    verdicts = materialize(q_process_id_unique(spark, sf_dir), "verdicts")
    path = scratch_folder(spark, "results")
    sinks.write_results(verdicts, path, ("rule_key", "run_id"))
    sinks.write_results(verdicts.where("run_id < 'jr_020'"), path, ("rule_key", "run_id"))
    return spark.read.parquet(path).select(*verdicts.columns)


def q_log_verdict(spark, sf_dir):
    runs, _, summary, facts = _logs(spark, sf_dir)
    rules = rules_frame(spark, DRIVER_RULES)
    pid = lg.process_id_check(_artifacts(runs, facts, rules), runs, rules)
    return lg.log_verdict(spark, runs, lg.run_report(summary, facts), lg.rule_counts(facts), pid, rules, DRIVER_RULES)


def q_rule_count_recon(spark, sf_dir):
    runs, _, _, facts = _logs(spark, sf_dir)
    counts = cand.candidate_counts(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF)
    return lg.reconcile_counts(spark, runs, lg.rule_counts(facts), counts, rules_frame(spark, DRIVER_RULES), DRIVER_RULES, enforce=True)


def _re(p: str) -> str:
    return p.replace("'", "''")


_ALIASES_SQL = _sql_values([(r.key, a) for r in DRIVER_RULES for a in sorted(r.rule_ids_accepted)],
                           ["rule_key", "alias"])
_LOG_SQL = f"""
h AS (
  SELECT run_id, source, count(*) AS n_lines,
         COALESCE(bool_or(regexp_matches(message, '{_re(C.sentinel)}')), false) AS has_sentinel,
         COALESCE(bool_or(contains(message, run_id)), false) AS text_has_run,
         COALESCE(bool_or(contains(message, run_id) OR contains(file_name, run_id)), false) AS mentions_run,
         min(CASE WHEN declared_stream IS NOT NULL AND trim(declared_stream) <> trim(run_id) THEN declared_stream END)
           AS wrong_stream,
         COALESCE(bool_or(trim(declared_stream) = trim(run_id)), false) AS stream_ok
  FROM run_log_captures GROUP BY run_id, source),
h2 AS (
  SELECT run_id, source, CASE source WHEN 'api' THEN 1 WHEN 'manager' THEN 2 WHEN 'file' THEN 3 END AS rk, n_lines,
         CASE WHEN source = 'api' THEN true WHEN source = 'manager' THEN text_has_run
              WHEN stream_ok THEN true ELSE mentions_run END AS verified,
         CASE WHEN n_lines = 0 THEN 'no lines'
              WHEN NOT has_sentinel THEN 'no completion line'
              WHEN source = 'file' AND wrong_stream IS NOT NULL
                   THEN 'declared stream ''' || wrong_stream || ''' is not run ''' || run_id || '''' END AS failure
  FROM h),
pk AS (SELECT run_id, min(rk) FILTER (WHERE failure IS NULL) AS picked FROM h2 GROUP BY run_id),
picks AS (
  SELECT pk.run_id, h2.source, COALESCE(h2.verified, false) AS run_verified,
         CAST(COALESCE(h2.n_lines, 0) AS BIGINT) AS n_lines,
         COALESCE((SELECT string_agg(x.source || ': ' || x.failure, '; ' ORDER BY x.rk) FROM h2 x
                   WHERE x.run_id = pk.run_id AND x.failure IS NOT NULL AND (pk.picked IS NULL OR x.rk < pk.picked)), '')
           AS failures,
         CASE WHEN pk.picked IS NULL THEN 'FAIL' ELSE 'OK' END AS state
  FROM pk LEFT JOIN h2 ON h2.run_id = pk.run_id AND h2.rk = pk.picked),
parsed AS (
  SELECT c.run_id, c.line_no, c.message,
         NULLIF(regexp_extract(message, '{_re(C.applied_rule)}', 1), '') AS applied_rule,
         TRY_CAST(NULLIF(regexp_extract(message, '{_re(C.rule_count)}', 1), '') AS BIGINT) AS rule_count,
         TRY_CAST(NULLIF(regexp_extract(message, '{_re(C.records)}', 1), '') AS BIGINT) AS records,
         TRY_CAST(NULLIF(regexp_extract(message, '{_re(C.chunk)}', 1), '') AS INT) AS chunk,
         NULLIF(regexp_extract(message, '{_re(C.chunk)}', 2), '') AS bucket,
         NULLIF(regexp_extract(message, '{_re(C.chunk)}', 3), '') AS key,
         regexp_matches(message, '{_re(C.error)}') AS is_error,
         regexp_matches(message, '{_re(C.sentinel)}') AS is_sentinel
  FROM run_log_captures c JOIN picks p ON p.run_id = c.run_id AND p.source = c.source AND p.state = 'OK'),
rc AS (SELECT run_id, applied_rule, arg_max(rule_count, line_no) FILTER (WHERE rule_count IS NOT NULL) AS rule_count,
              max(line_no) FILTER (WHERE rule_count IS NOT NULL) AS value_line, CAST(count(*) AS BIGINT) AS n_reports
       FROM parsed WHERE applied_rule IS NOT NULL GROUP BY run_id, applied_rule),
report AS (
  SELECT run_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(records) AS BIGINT) AS records_to_s3,
         CAST(count(chunk) AS BIGINT) AS total_chunks,
         CAST(count(DISTINCT CASE WHEN key IS NOT NULL THEN bucket || chr(1) || key END) AS BIGINT) AS n_artifacts,
         CAST(count(DISTINCT applied_rule) AS BIGINT) AS n_rules,
         CAST(count(*) FILTER (WHERE is_error) AS BIGINT) AS error_lines,
         arg_min(left(message, 160), CASE WHEN is_error THEN line_no END) AS first_error,
         COALESCE(bool_or(is_sentinel), false) AS has_sentinel
  FROM parsed GROUP BY run_id),
arts AS (
  SELECT run_id, bucket, key, min(line_no) AS position, arg_min(chunk, line_no) AS chunk,
         string_split(key, '/')[-1] AS filename,
         NULLIF(regexp_extract(string_split(key, '/')[-1], '{_re(C.process_id_in_filename)}', 0), '') AS process_id
  FROM parsed WHERE key IS NOT NULL GROUP BY run_id, bucket, key),
rr AS (SELECT r.run_id, u.rule_key, u.rule_id, u.outbound_prefix AS prefix
       FROM runs r JOIN {RULES_SQL} u ON u.flow_name = r.flow_name),
ent AS (
  SELECT a.run_id, rr.rule_key, a.position, a.chunk, a.bucket, a.key, a.filename, a.process_id,
         a.bucket = '{OUTBOUND_BUCKET}' AS bucket_ok, starts_with(a.key, rr.prefix) AS prefix_ok
  FROM arts a JOIN rr ON rr.run_id = a.run_id
  WHERE starts_with(ltrim(a.key, '/'), rr.prefix)),
pidg AS (
  SELECT run_id, rule_key, count(*) AS n_files, count(DISTINCT process_id) AS n_pids,
         min(process_id) AS min_pid, max(process_id) AS max_pid,
         bool_and(bucket_ok) AS bucket_ok, bool_and(prefix_ok) AS prefix_ok
  FROM ent GROUP BY run_id, rule_key),
pid AS (
  SELECT rr.run_id, rr.rule_key, CAST(COALESCE(n_files, 0) AS BIGINT) AS n_files,
         CAST(COALESCE(n_pids, 0) AS BIGINT) AS n_process_ids,
         CASE WHEN n_pids = 1 THEN min_pid END AS process_id,
         CASE WHEN n_pids > 1 THEN min_pid || ' .. ' || max_pid END AS process_id_range,
         COALESCE(g.bucket_ok, true) AS bucket_ok, COALESCE(g.prefix_ok, true) AS prefix_ok,
         CASE WHEN COALESCE(n_files, 0) = 0 THEN 'no output file under the rule prefix'
              WHEN COALESCE(n_pids, 0) = 0 THEN 'no process UUID in the output file names'
              WHEN n_pids > 1 THEN 'more than one process UUID' END AS reason
  FROM rr LEFT JOIN pidg g ON g.run_id = rr.run_id AND g.rule_key = rr.rule_key),
rep AS (SELECT rc.run_id, al.rule_key, arg_max(rc.rule_count, rc.value_line) AS log_count
        FROM rc JOIN {_ALIASES_SQL} al ON lower(rc.applied_rule) = lower(al.alias) GROUP BY rc.run_id, al.rule_key)"""

_LOG_VIEWS = ("run_log_captures", "runs")
O_LOG_SOURCE_PICK = _with(*_LOG_VIEWS, extra=_LOG_SQL) + "SELECT * FROM picks"
_FILE_CAPTURES = f"""
SELECT run_id, source, file_name, modified_at, line_no, message, CASE WHEN source <> 'file' THEN declared_stream END AS declared_stream
FROM ({ALL_VIEWS['run_log_captures']}) AS lines WHERE source <> 'file' OR {_NEWEST_COPY}"""
O_LOG_FILE_PICK = (oracle_with({**ALL_VIEWS, "run_log_captures": _FILE_CAPTURES}, list(_LOG_VIEWS)).rstrip("\n") + ",\n" + _LOG_SQL
                   + "\nSELECT * FROM picks")
O_LOG_REPORT = _with(*_LOG_VIEWS, extra=_LOG_SQL) + "SELECT * FROM report"
O_LOG_RULE_COUNTS = _with(*_LOG_VIEWS, extra=_LOG_SQL) + "SELECT * EXCLUDE (value_line) FROM rc"
O_ARTIFACT_BY_RULE = _with(*_LOG_VIEWS, extra=_LOG_SQL) + "SELECT * FROM ent"
O_ARTIFACT_LONGEST_PREFIX = _with(*_LOG_VIEWS, extra=_LOG_SQL) + f"""
SELECT run_id, rule_key, position, chunk, bucket, key, filename, process_id, bucket = '{OUTBOUND_BUCKET}' AS bucket_ok, starts_with(key, prefix) AS prefix_ok
FROM (SELECT a.*, r.rule_key, r.p AS prefix
      FROM arts a JOIN (SELECT *, CASE WHEN rule_key = 'practice_f_z' THEN 'outbound/' ELSE prefix END AS p FROM rr) r ON r.run_id = a.run_id
      WHERE starts_with(ltrim(a.key, '/'), r.p)
      QUALIFY length(r.p) = max(length(r.p)) OVER (PARTITION BY a.run_id, a.bucket, a.key)) x"""
O_PROCESS_ID_UNIQUE = _with(*_LOG_VIEWS, extra=_LOG_SQL) + """
SELECT run_id, rule_key, n_files, n_process_ids, process_id, process_id_range, bucket_ok, prefix_ok,
       CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS verdict, reason FROM pid"""
O_LOG_VERDICT = _with(*_LOG_VIEWS, extra=_LOG_SQL) + """
SELECT run_id, rule_key, log_count, records_to_s3, n_artifacts, n_entity_files, process_id,
       CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS verdict, reason
FROM (
  SELECT rr.run_id, rr.rule_key, rep.log_count, report.records_to_s3,
         CAST(COALESCE(report.n_artifacts, 0) AS BIGINT) AS n_artifacts,
         CAST(COALESCE(pid.n_files, 0) AS BIGINT) AS n_entity_files, pid.process_id,
         CASE WHEN rep.log_count IS NULL THEN 'log does not report AppliedRule=' || CAST(rr.rule_id AS VARCHAR)
              WHEN rep.log_count < 1 THEN 'rule_count below 1'
              WHEN COALESCE(report.records_to_s3, 0) < 1 THEN 'no output records written'
              WHEN COALESCE(report.n_artifacts, 0) = 0 THEN 'no output artifacts in the log'
              WHEN pid.reason IS NOT NULL THEN pid.reason
              WHEN NOT pid.bucket_ok THEN 'artifact bucket is not the configured bucket'
              WHEN NOT pid.prefix_ok THEN 'artifact key is outside the prefix' END AS reason
  FROM rr LEFT JOIN rep ON rep.run_id = rr.run_id AND rep.rule_key = rr.rule_key
          LEFT JOIN report ON report.run_id = rr.run_id
          LEFT JOIN pid ON pid.run_id = rr.run_id AND pid.rule_key = rr.rule_key) x"""
O_RULE_COUNT_RECON = _with(*_LOG_VIEWS, *DIRECTORY_TABLES, extra=_LOG_SQL + "," + _QUALIFYING_SQL) + """,
counts AS (SELECT rule_key, count(DISTINCT LocationID) AS n FROM qualifying GROUP BY rule_key)
SELECT rr.run_id, rr.rule_key, rep.log_count, CAST(COALESCE(counts.n, 0) AS BIGINT) AS source_count,
       CASE WHEN rep.log_count IS NULL OR rep.log_count < 1 THEN 'FAIL'
            WHEN rep.log_count <> COALESCE(counts.n, 0) THEN 'FAIL' ELSE 'PASS' END AS verdict,
       CASE WHEN rep.log_count IS NULL THEN 'rule not reported in the log'
            WHEN rep.log_count < 1 THEN 'rule_count below 1'
            WHEN rep.log_count <> COALESCE(counts.n, 0)
                 THEN 'log rule_count ' || CAST(rep.log_count AS VARCHAR) || ' != source count '
                      || CAST(COALESCE(counts.n, 0) AS VARCHAR) END AS reason
FROM rr LEFT JOIN rep ON rep.run_id = rr.run_id AND rep.rule_key = rr.rule_key
        LEFT JOIN counts ON counts.rule_key = rr.rule_key"""

QUERIES.update({
    "artifact_longest_prefix": q_artifact_longest_prefix, "result_tables": q_result_tables,
    "log_source_pick": q_log_source_pick, "log_file_pick": q_log_file_pick,
    "log_report": q_log_report,
    "log_rule_counts": q_log_rule_counts,
    "artifact_by_rule": q_artifact_by_rule,
    "process_id_unique": q_process_id_unique,
    "log_verdict": q_log_verdict,
    "rule_count_recon": q_rule_count_recon,
})
ORACLE.update({
    "artifact_longest_prefix": O_ARTIFACT_LONGEST_PREFIX, "result_tables": O_PROCESS_ID_UNIQUE,
    "log_source_pick": O_LOG_SOURCE_PICK, "log_file_pick": O_LOG_FILE_PICK,
    "log_report": O_LOG_REPORT,
    "log_rule_counts": O_LOG_RULE_COUNTS,
    "artifact_by_rule": O_ARTIFACT_BY_RULE,
    "process_id_unique": O_PROCESS_ID_UNIQUE,
    "log_verdict": O_LOG_VERDICT,
    "rule_count_recon": O_RULE_COUNT_RECON,
})


# ── artifacts and object search ───────────────────────────────────────────
from sluice.operators import artifacts as ar  # noqa: E402


def q_artifact_state(spark, sf_dir):
    runs, picks, _, facts = _logs(spark, sf_dir)
    arts = _artifacts(runs, facts, rules_frame(spark, DRIVER_RULES))
    inv = catalog(spark, sf_dir)["object_inventory"]
    out = ar.check_artifacts(arts, inv, runs, picks, enforce_freshness=False)
    return out.withColumn("last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss"))


O_ARTIFACT_STATE = _with(*_LOG_VIEWS, "object_inventory", extra=_LOG_SQL) + f"""
SELECT run_id, rule_key, position, bucket, key, exists, size, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified,
       CASE WHEN NOT exists THEN 'not found' WHEN COALESCE(size, 0) = 0 THEN '0 bytes'
            WHEN stale THEN 'stale' ELSE 'ok' END AS state,
       CASE WHEN NOT exists OR COALESCE(size, 0) = 0 THEN 'FAIL'
            WHEN stale THEN CASE WHEN verified THEN 'WARN' ELSE 'FAIL' END ELSE 'PASS' END AS verdict
FROM (
  SELECT ent.run_id, ent.rule_key, ent.position, ent.bucket, ent.key, i.key IS NOT NULL AS exists, i.size,
         i.last_modified, COALESCE(i.key IS NOT NULL AND i.last_modified < r.started_at, false) AS stale,
         COALESCE(p.run_verified, false) AS verified
  FROM ent LEFT JOIN object_inventory i ON i.bucket = ent.bucket AND i.key = ent.key
           LEFT JOIN runs r ON r.run_id = ent.run_id
           LEFT JOIN picks p ON p.run_id = ent.run_id) x"""


def _search_targets(runs, rules):
    """RULE-6 fallback: runs whose trigger was skipped search their rules' prefixes."""
    return (lg.runs_rules(runs.where(F.col("state") == "SKIPPED_TRIGGER"), rules)
            .select(F.concat_ws("/", "run_id", "rule_key").alias("search_id"),
                    F.lit(OUTBOUND_BUCKET).alias("target_bucket"), F.col("outbound_prefix").alias("prefix"),
                    F.col("started_at").alias("since")))


def q_object_search(spark, sf_dir):
    c = catalog(spark, sf_dir)
    targets = _search_targets(c["runs"], rules_frame(spark, DRIVER_RULES))
    out = ar.search_objects(c["object_inventory"], targets)
    return out.withColumn("last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss"))


O_OBJECT_SEARCH = _with("runs", "object_inventory") + f"""
SELECT search_id, bucket, key, size, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified
FROM (SELECT r.run_id || '/' || u.rule_key AS search_id, i.*,
             row_number() OVER (PARTITION BY r.run_id, u.rule_key ORDER BY i.last_modified, i.key) AS nth
      FROM runs r JOIN {RULES_SQL} u ON u.flow_name = r.flow_name
      JOIN object_inventory i ON i.bucket = '{OUTBOUND_BUCKET}' AND starts_with(ltrim(i.key, '/'), u.outbound_prefix)
      WHERE r.state = 'SKIPPED_TRIGGER' AND i.last_modified >= r.started_at
        AND regexp_matches(string_split(i.key, '/')[-1], '.*\\.csv$')) x
WHERE nth = 1"""


# ── outbound files ────────────────────────────────────────────────────────
from sluice.operators import outbound as ob  # noqa: E402
from sluice.sources import delimited as dl  # noqa: E402


def _outbound(spark, sf_dir):
    rows = catalog(spark, sf_dir)["outbound_rows"]
    return rows.withColumn("missing_columns", F.array().cast("array<string>"))


def _file_path(bucket, key):
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def _written_runs(rows, spark, rules):
    """The runs that wrote each record under its rule's prefix: (rule_key, _k0, _k1, run_id)."""
    rows = ob.rule_files(rows, rules, OUTBOUND_BUCKET)
    return rows.select("rule_key", "run_id", canon_id(text_norm(F.col("PracticeID"))).alias("_k0"),
                       canon_id(text_norm(F.col("BillingLocationID"))).alias("_k1")).distinct()


def _with_runs(df, rows, spark, rules):
    """Records (rule_key, PracticeID, LocationID, ...) once per run that wrote them into ``rows``."""
    keyed = df.select("*", canon_id(text_norm(F.col("PracticeID"), df.schema["PracticeID"].dataType)).alias("_k0"),
                      canon_id(text_norm(F.col("LocationID"), df.schema["LocationID"].dataType)).alias("_k1"))
    return keyed.join(_written_runs(rows, spark, rules), ["rule_key", "_k0", "_k1"], "left").drop("_k0", "_k1")


def _match(spark, sf_dir, mode, outbound=None, checked=None):
    rules = rules_frame(spark, DRIVER_RULES)
    outbound = _outbound(spark, sf_dir) if outbound is None else outbound
    checked = materialize(outbound.select("file_path", "missing_columns").distinct() if checked is None else checked, "files")
    runs, _, _, facts = _logs(spark, sf_dir)
    arts = materialize(_artifacts(runs, facts, rules).select("rule_key", "run_id", "bucket", "key"), "artifacts")
    own = arts.select("rule_key", F.col("run_id").alias("file_set"), _file_path(F.col("bucket"), F.col("key")).alias("file_path"))
    cands = materialize(cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF).select("rule_key", "PracticeID", "LocationID").distinct(), "candidates")
    rows = materialize(ob.relevant_rows(cands, outbound, DRIVER_RULES), "outbound-rows")
    cands = _with_runs(cands, rows, spark, rules).withColumnRenamed("run_id", "file_set")
    return ob.match_outbound(cands, rows, DRIVER_RULES, rules, OUTBOUND_BUCKET, value_mode=mode, files=checked, own=own
                             ).withColumnRenamed("file_set", "run_id")


def q_outbound_match(spark, sf_dir):
    m = _match(spark, sf_dir, "any")
    return m.select("rule_key", "PracticeID", "LocationID", "run_id", "n_files_checked", "files_matched", "matched_rows",
                    F.when(F.col("files_matched") > 0, "PASS").otherwise("FAIL").alias("identity_verdict"))


def q_outbound_expected_any(spark, sf_dir):
    return _match(spark, sf_dir, "any").select("rule_key", "PracticeID", "LocationID", "run_id",
                                               F.col("value_any").alias("value_ok"), "verdict", "reason")


def q_outbound_expected_all(spark, sf_dir):
    return _match(spark, sf_dir, "all").select("rule_key", "PracticeID", "LocationID", "run_id",
                                               F.col("value_all").alias("value_ok"), "verdict", "reason")


def _canon_sql(t: str) -> str:
    return f"CASE WHEN regexp_full_match({t}, '[0-9]+') THEN COALESCE(NULLIF(ltrim({t}, '0'), ''), '0') ELSE {t} END"


def _num_text_sql(c: str) -> str:
    return f"(CASE WHEN {c} = 0 OR {c} IS NULL THEN '' ELSE CAST({c} AS VARCHAR) END)"


def _str_text_sql(c: str) -> str:
    return f"trim(COALESCE({c}, ''))"


_OUTBOUND_SQL = f"""
ck AS (SELECT DISTINCT rule_key, PracticeID, LocationID,
              {_canon_sql(_num_text_sql('PracticeID'))} AS k0, {_canon_sql(_num_text_sql('LocationID'))} AS k1
       FROM qualifying),
orow AS (SELECT u.rule_key, o.*,
                {_canon_sql(_str_text_sql('o.PracticeID'))} AS k0, {_canon_sql(_str_text_sql('o.BillingLocationID'))} AS k1,
                lower(upper(trim(COALESCE(o.DataSource, '')))) = 'directory-auto' AS good
         FROM outbound_rows o JOIN {RULES_SQL} u
           ON starts_with(regexp_replace(o.file_path, '^[a-z0-9]+://[^/]+/', ''), u.outbound_prefix)
          AND regexp_extract(o.file_path, '^[a-z0-9]+://([^/]+)/', 1) = '{OUTBOUND_BUCKET}'),
wr AS (SELECT DISTINCT rule_key, k0, k1, run_id FROM orow),
ckr AS (SELECT ck.*, wr.run_id FROM ck LEFT JOIN wr ON wr.rule_key = ck.rule_key AND wr.k0 = ck.k0 AND wr.k1 = ck.k1)"""
# The files of each set (a run's logged artifacts) and what its candidates find there.
_MATCH_SQL = """
srow AS (SELECT o.*, own.set_id FROM orow o JOIN own ON own.rule_key = o.rule_key AND own.file_path = o.file_path),
files AS (SELECT rule_key, set_id, count(DISTINCT file_path) AS files_checked FROM srow GROUP BY rule_key, set_id),
pf AS (SELECT c.rule_key, c.set_id, c.k0, c.k1, o.file_path, count(*) AS n, bool_or(o.good) AS any_f, bool_and(o.good) AS all_f
       FROM cks c JOIN srow o ON o.rule_key = c.rule_key AND o.set_id = c.set_id AND o.k0 = c.k0 AND o.k1 = c.k1
       GROUP BY ALL),
pc AS (SELECT rule_key, set_id, k0, k1, count(*) AS files_matched, sum(n) AS matched_rows,
              bool_and(any_f) AS value_any, bool_and(all_f) AS value_all
       FROM pf GROUP BY ALL),
m AS (SELECT c.rule_key, CAST(c.PracticeID AS VARCHAR) AS PracticeID, CAST(c.LocationID AS VARCHAR) AS LocationID, c.set_id,
             CAST(COALESCE(f.files_checked, 0) AS BIGINT) AS n_files_checked,
             CAST(COALESCE(pc.files_matched, 0) AS BIGINT) AS files_matched,
             CAST(COALESCE(pc.matched_rows, 0) AS BIGINT) AS matched_rows, pc.value_any, pc.value_all
      FROM cks c LEFT JOIN pc ON pc.rule_key = c.rule_key AND pc.set_id = c.set_id AND pc.k0 = c.k0 AND pc.k1 = c.k1
                 LEFT JOIN files f ON f.rule_key = c.rule_key AND f.set_id = c.set_id)"""
_RUN_SETS_SQL = """
own AS (SELECT DISTINCT rule_key, run_id AS set_id, 's3://' || bucket || '/' || key AS file_path FROM ent),
cks AS (SELECT rule_key, PracticeID, LocationID, k0, k1, run_id AS set_id FROM ckr)"""
_OUT_VIEWS = (*DIRECTORY_TABLES, *_LOG_VIEWS, "outbound_rows")
_RUN_MATCH = _with(*_OUT_VIEWS, extra=",".join([_QUALIFYING_SQL, _LOG_SQL, _OUTBOUND_SQL, _RUN_SETS_SQL, _MATCH_SQL]))


def _expected_sql(mode: str) -> str:
    v = f"value_{mode}"
    return _RUN_MATCH + f"""
SELECT rule_key, PracticeID, LocationID, set_id AS run_id, {v} AS value_ok,
       CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS verdict, reason
FROM (SELECT *, CASE WHEN n_files_checked = 0 THEN 'no outbound files were checked'
                     WHEN files_matched = 0 THEN 'record not found in any outbound file'
                     WHEN NOT COALESCE({v}, false) THEN 'unexpected value in a matched file' END AS reason
      FROM m) x"""


O_OUTBOUND_MATCH = _RUN_MATCH + """
SELECT rule_key, PracticeID, LocationID, set_id AS run_id, n_files_checked, files_matched, matched_rows,
       CASE WHEN files_matched > 0 THEN 'PASS' ELSE 'FAIL' END AS identity_verdict FROM m"""
O_OUTBOUND_EXPECTED_ANY = _expected_sql("any")
# Over the files: rows of a file without the identity column match nothing, and its sets fail.
_MISSING_ID = "instr('0123456789abcdef', substr(md5(file_path), 1, 1)) >= 14"
O_OUTBOUND_FILE_MATCH = _with(*_OUT_VIEWS, extra=",".join([_QUALIFYING_SQL, _LOG_SQL, _OUTBOUND_SQL, _RUN_SETS_SQL]).replace(
    "wr AS (SELECT DISTINCT rule_key, k0, k1, run_id FROM orow)", f"wr AS (SELECT DISTINCT rule_key, k0, k1, run_id FROM orow WHERE NOT {_MISSING_ID})")
    + "," + _MATCH_SQL.replace("JOIN srow o ON", f"JOIN (SELECT * FROM srow WHERE NOT {_MISSING_ID}) o ON")) + f"""
SELECT rule_key, PracticeID, LocationID, run_id, n_files_checked, files_matched, value_ok,
       CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS verdict, reason
FROM (SELECT m.rule_key, m.PracticeID, m.LocationID, m.set_id AS run_id, n_files_checked, files_matched, value_any AS value_ok,
             CASE WHEN n_files_checked = 0 THEN 'no outbound files were checked'
                  WHEN EXISTS (SELECT 1 FROM srow s WHERE s.rule_key = m.rule_key AND s.set_id = m.set_id AND {_MISSING_ID.replace('file_path', 's.file_path')})
                  THEN 'identity column missing from a checked file'
                  WHEN files_matched = 0 THEN 'record not found in any outbound file'
                  WHEN NOT COALESCE(value_any, false) THEN 'unexpected value in a matched file' END AS reason
      FROM m) x"""
O_OUTBOUND_EXPECTED_ALL = _expected_sql("all")


# The same rows as real delimited files: headers drift from file to file
# (order, case, blanks, missing columns), and a note holds quotes and line breaks.
FILE_COLUMNS = ["run_id", "PracticeID", "TaxIDNumber", "BillingLocationID", "DataSource", "Note"]
FILE_PARTS = 2
_DRIFT = "instr('0123456789abcdef', substr(md5(file_path), 1, 1)) - 1"
_NOTE = "'said \"' || BillingServiceCategoryTypeName || '\",' || chr(10) || CASE WHEN row_no % 3 = 0 THEN '' ELSE 'line two' END"
_FILE_VIEW = f"SELECT *, {_DRIFT} AS drift, {_NOTE} AS Note FROM outbound_rows"


def _outbound_files(spark, sf_dir):
    """Write the outbound rows as files and read them back: (rows, files), file paths as the log names them."""
    rows = spark.sql(_FILE_VIEW.replace("outbound_rows", "{outbound_rows}"), outbound_rows=catalog(spark, sf_dir)["outbound_rows"])
    drift = F.col("drift")
    cases = [(drift < 8, FILE_COLUMNS, FILE_COLUMNS),
             (drift < 11, [f" {c.upper()}" for c in reversed(FILE_COLUMNS)], list(reversed(FILE_COLUMNS))),
             (drift < 13, *[[c for c in FILE_COLUMNS if c != "TaxIDNumber"]] * 2),
             (F.lit(True), *[[c for c in FILE_COLUMNS if c != "BillingLocationID"]] * 2)]
    head, values = F.when(F.lit(False), F.array(F.lit(""))), F.when(F.lit(False), F.array(F.lit("")))
    for when, names, cols in cases:
        head, values = head.when(when, F.array(*(F.lit(n) for n in names))), values.when(when, F.array(*cols))
    folder = scratch_folder(spark, "outbound-files")
    dl.write_delimited(rows.withColumn("_head", head).withColumn("_values", values), folder, "file_path", "row_no", "_head", "_values", FILE_PARTS)
    read, files = ob.read_outbound_files(spark, f"{folder}/*/*", FILE_COLUMNS)
    plain = F.url_decode(F.replace(F.regexp_extract("file_path", "/name=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    part = F.regexp_extract("file_path", "/part=([0-9]+)/", 1).cast("int")
    return tuple(df.withColumn("part", part).withColumn("file_path", plain) for df in (read, files))


def q_outbound_file_rows(spark, sf_dir):
    read, _ = _outbound_files(spark, sf_dir)
    return read.select("file_path", "part", "row_no", *FILE_COLUMNS, F.array_join("missing_columns", ",").alias("missing"))


def q_outbound_file_match(spark, sf_dir):
    read, files = _outbound_files(spark, sf_dir)
    rows = read.withColumn("row_no", F.col("row_no") * FILE_PARTS + F.col("part"))
    return _match(spark, sf_dir, "any", rows.drop("part"), files.select("file_path", "missing_columns").distinct()).select(
        "rule_key", "PracticeID", "LocationID", "run_id", "n_files_checked", "files_matched", F.col("value_any").alias("value_ok"), "verdict", "reason")


_FILE_VALUES = ", ".join(
    f"NULLIF(CASE WHEN drift {t} THEN NULL ELSE {c} END, '') AS {c}" if t else f"NULLIF({c}, '') AS {c}"
    for c, t in zip(FILE_COLUMNS, ("", "", "IN (11, 12)", ">= 13", "", "")))
O_OUTBOUND_FILE_ROWS = _with("outbound_rows") + f"""
SELECT file_path, CAST(row_no % {FILE_PARTS} AS INTEGER) AS part,
       row_number() OVER (PARTITION BY file_path, row_no % {FILE_PARTS} ORDER BY row_no) AS row_no, {_FILE_VALUES},
       CASE WHEN drift IN (11, 12) THEN 'TaxIDNumber' WHEN drift >= 13 THEN 'BillingLocationID' ELSE '' END AS missing
FROM ({_FILE_VIEW}) f"""


def q_outbound_first3(spark, sf_dir):
    # Both are used in several places of the plan: stored, so the rows are made once and only the few that matter go on.
    cands = materialize(cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF).select("rule_key", "PracticeID", "LocationID").distinct(), "candidates")
    rows = materialize(ob.relevant_rows(cands, _outbound(spark, sf_dir), DRIVER_RULES), "outbound-rows")
    return ob.first_matching_rows(cands, rows, DRIVER_RULES, rules_frame(spark, DRIVER_RULES), OUTBOUND_BUCKET, 3)


O_OUTBOUND_FIRST3 = _with(*DIRECTORY_TABLES, "outbound_rows", extra=_QUALIFYING_SQL + "," + _OUTBOUND_SQL) + """
SELECT rule_key, key_PracticeID, key_LocationID, file_path, CAST(rank AS INT) AS rank, row_no,
       PracticeID, BillingLocationID, DataSource
FROM (SELECT c.rule_key, c.k0 AS key_PracticeID, c.k1 AS key_LocationID, o.file_path, o.row_no,
             o.PracticeID, o.BillingLocationID, o.DataSource,
             row_number() OVER (PARTITION BY c.rule_key, c.k0, c.k1, o.file_path ORDER BY o.row_no) AS rank
      FROM (SELECT DISTINCT rule_key, k0, k1 FROM ck) c
      JOIN orow o ON o.rule_key = c.rule_key AND o.k0 = c.k0 AND o.k1 = c.k1) x
WHERE rank <= 3"""


def q_outbound_rowcount(spark, sf_dir):
    report = lg.run_report(*_logs(spark, sf_dir)[2:])
    return ob.reconcile_rows(_outbound(spark, sf_dir), report, enforce=True)


O_OUTBOUND_ROWCOUNT = _with(*_LOG_VIEWS, "outbound_rows", extra=_LOG_SQL) + """,
fr AS (SELECT run_id, count(*) AS n FROM outbound_rows GROUP BY run_id)
SELECT COALESCE(fr.run_id, report.run_id) AS run_id, CAST(COALESCE(fr.n, 0) AS BIGINT) AS file_rows,
       report.records_to_s3 AS reported_rows,
       CASE WHEN report.records_to_s3 IS NULL THEN 'SKIPPED'
            WHEN COALESCE(fr.n, 0) = report.records_to_s3 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM fr FULL JOIN report ON report.run_id = fr.run_id"""


def _overlap(spark, sf_dir):
    c = catalog(spark, sf_dir)
    src = (c["practice_locations"].where(F.col("Archived") == "N")
           .select(F.col("LocationID").cast("string").alias("id")))
    out = c["outbound_rows"].select(F.col("BillingLocationID").alias("id"))
    return ob.id_overlap(src, out)


def q_id_overlap(spark, sf_dir):
    return _overlap(spark, sf_dir)


_OVERLAP_SQL = f"""
s AS (SELECT DISTINCT {_canon_sql(_str_text_sql('CAST(LocationID AS VARCHAR)'))} AS id FROM practice_locations
      WHERE Archived = 'N'),
o AS (SELECT DISTINCT {_canon_sql(_str_text_sql('BillingLocationID'))} AS id FROM outbound_rows),
ocnt AS (SELECT (SELECT count(*) FROM s) AS ns, (SELECT count(*) FROM o) AS no,
               (SELECT count(*) FROM s JOIN o ON s.id = o.id) AS nc),
ovl AS (
  SELECT CAST(ns AS BIGINT) AS n_source, CAST(no AS BIGINT) AS n_output, CAST(nc AS BIGINT) AS n_common,
         CASE WHEN ns > 0 THEN CAST(floor((nc * 2000 + ns) / (ns * 2)) AS BIGINT) END AS overlap_tenths,
         CASE WHEN ns > 0 THEN CAST(floor((abs(no - ns) * 2000 + ns) / (ns * 2)) AS BIGINT) END AS diff_tenths
  FROM ocnt),
ovl2 AS (
  SELECT *, CAST(floor(overlap_tenths / 10) AS BIGINT) || '.' || CAST(overlap_tenths % 10 AS VARCHAR) || '%' AS overlap_pct_text,
         CAST(floor(diff_tenths / 10) AS BIGINT) || '.' || CAST(diff_tenths % 10 AS VARCHAR) || '%' AS diff_pct_text,
         CASE WHEN n_source > 0 AND overlap_tenths >= 1000 AND diff_tenths <= 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM ovl)"""

O_ID_OVERLAP = _with("practice_locations", "outbound_rows", extra=_OVERLAP_SQL) + "SELECT * FROM ovl2"


def q_consolidated_verdict(spark, sf_dir):
    return st.consolidated_verdict(q_split_totals(spark, sf_dir), _overlap(spark, sf_dir))


O_CONSOLIDATED_VERDICT = _with("splits", "process_status", "practice_locations", "outbound_rows",
                               extra=_SPLIT_SQL + "," + _TOTALS_SQL + "," + _OVERLAP_SQL) + """
SELECT total_splits, splits_failed, total_errored, total_stuck,
       CASE WHEN problems = '' THEN 'PASS' ELSE 'FAIL' END AS verdict,
       CASE WHEN problems = '' THEN '' ELSE 'validation FAILED:' || chr(10) || '  ' || problems END AS message
FROM (
  SELECT t.*, concat_ws(chr(10) || '  ',
           CASE WHEN v.status = 'FAIL' THEN 'source/output count mismatch - overlap ' || v.overlap_pct_text
                                            || ', diff ' || v.diff_pct_text END,
           CASE WHEN t.splits_failed > 0 THEN CAST(t.splits_failed AS VARCHAR) || '/' || CAST(t.total_splits AS VARCHAR)
                || ' split(s) FAILED - '
                || concat_ws(', ', CASE WHEN t.total_errored > 0 THEN CAST(t.total_errored AS VARCHAR) || ' errored' END,
                                   CASE WHEN t.total_stuck > 0 THEN CAST(t.total_stuck AS VARCHAR) || ' stuck' END)
                || ' sub-process(es).' END) AS problems
  FROM totals t CROSS JOIN ovl2 v) x"""

QUERIES.update({
    "artifact_state": q_artifact_state,
    "object_search": q_object_search,
    "outbound_match": q_outbound_match,
    "outbound_expected_any": q_outbound_expected_any,
    "outbound_expected_all": q_outbound_expected_all, "outbound_file_rows": q_outbound_file_rows, "outbound_file_match": q_outbound_file_match,
    "outbound_first3": q_outbound_first3,
    "outbound_rowcount": q_outbound_rowcount,
    "id_overlap": q_id_overlap,
    "consolidated_verdict": q_consolidated_verdict,
})
ORACLE.update({
    "artifact_state": O_ARTIFACT_STATE,
    "object_search": O_OBJECT_SEARCH,
    "outbound_match": O_OUTBOUND_MATCH,
    "outbound_expected_any": O_OUTBOUND_EXPECTED_ANY,
    "outbound_expected_all": O_OUTBOUND_EXPECTED_ALL, "outbound_file_rows": O_OUTBOUND_FILE_ROWS, "outbound_file_match": O_OUTBOUND_FILE_MATCH,
    "outbound_first3": O_OUTBOUND_FIRST3,
    "outbound_rowcount": O_OUTBOUND_ROWCOUNT,
    "id_overlap": O_ID_OVERLAP,
    "consolidated_verdict": O_CONSOLIDATED_VERDICT,
})


# ── final state, before/after, payload echo ───────────────────────────────
from sluice.operators import finalstate as fs  # noqa: E402


def q_final_state(spark, sf_dir):
    c = catalog(spark, sf_dir)
    cands = cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF)
    state = fs.final_state_rows(c["practices"], c["practice_locations_after"], c["practice_types"])
    return fs.final_state(spark, cands, state, DRIVER_RULES)


O_FINAL_STATE = _with(*DIRECTORY_TABLES, "practice_locations_after", extra=_QUALIFYING_SQL) + """,
fstate AS (
  SELECT p2.LocationID, COALESCE(p2.InDirectory, '') AS InDirectory
  FROM practices p JOIN practice_locations_after p2 ON p2.PracticeID = p.PracticeID
  JOIN practice_types pt ON pt.PracticeTypeID = p2.LocationTypeID
  WHERE p.Archived = 'N' AND p2.Archived = 'N'),
fj AS (
  SELECT c.rule_key, c.LocationID, f.LocationID IS NOT NULL AS found, upper(trim(COALESCE(f.InDirectory, ''))) AS v
  FROM (SELECT DISTINCT rule_key, LocationID FROM qualifying) c LEFT JOIN fstate f ON f.LocationID = c.LocationID)
SELECT rule_key, CAST(LocationID AS VARCHAR) AS LocationID, found,
       CASE WHEN NOT found THEN NULL WHEN v = '' THEN 'NULL' ELSE v END AS actual_value,
       CASE WHEN found AND v IN ('N') THEN 'PASS' ELSE 'FAIL' END AS verdict,
       CASE WHEN NOT found THEN 'final row not found'
            WHEN v NOT IN ('N') THEN 'expected InDirectory in [''N''], found ' || CASE WHEN v = '' THEN 'NULL' ELSE v END
       END AS reason
FROM fj"""


def q_final_state_conflicts(spark, sf_dir):
    """The final state with repeated state rows, some of which disagree."""
    c = catalog(spark, sf_dir)
    q = cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF)
    state = fs.final_state_rows(c["practices"], c["practice_locations_after"], c["practice_types"])
    again = state.where("LocationID % 2 = 0").withColumn("InDirectory", F.when(F.col("LocationID") % 4 == 0, F.lit(" y")).otherwise(F.col("InDirectory")))
    return fs.final_state(spark, q, state.unionByName(again), DRIVER_RULES)


O_FINAL_STATE_CONFLICTS = _with(*DIRECTORY_TABLES, "practice_locations_after", extra=_QUALIFYING_SQL) + """,
once AS (
  SELECT p2.LocationID, COALESCE(p2.InDirectory, '') AS InDirectory
  FROM practices p JOIN practice_locations_after p2 ON p2.PracticeID = p.PracticeID
  JOIN practice_types pt ON pt.PracticeTypeID = p2.LocationTypeID
  WHERE p.Archived = 'N' AND p2.Archived = 'N'),
fstate AS (
  SELECT LocationID, COALESCE(NULLIF(upper(trim(InDirectory)), ''), 'NULL') AS v FROM once
  UNION ALL SELECT LocationID, CASE WHEN LocationID % 4 = 0 THEN 'Y' ELSE COALESCE(NULLIF(upper(trim(InDirectory)), ''), 'NULL') END FROM once WHERE LocationID % 2 = 0),
keyed AS (SELECT LocationID, min(v) AS low, max(v) AS high FROM fstate GROUP BY LocationID),
fj AS (SELECT c.rule_key, c.LocationID, k.LocationID IS NOT NULL AS found, low, high
       FROM (SELECT DISTINCT rule_key, LocationID FROM qualifying) c LEFT JOIN keyed k ON k.LocationID = c.LocationID)
SELECT rule_key, CAST(LocationID AS VARCHAR) AS LocationID, found, CASE WHEN low = high THEN low END AS actual_value,
       CASE WHEN found AND low = high AND low = 'N' THEN 'PASS' ELSE 'FAIL' END AS verdict,
       CASE WHEN NOT found THEN 'final row not found' WHEN low <> high THEN 'final rows differ in InDirectory: ' || low || ' .. ' || high
            WHEN low <> 'N' THEN 'expected InDirectory in [''N''], found ' || low END AS reason
FROM fj"""


def _before_after(spark, sf_dir):
    c = catalog(spark, sf_dir)
    before, after = c["practitioner_locations_before"], c["practitioner_locations_after"]
    return before, fs.before_after_rows(before, after, "InDirectory", ("N",))


def q_before_after(spark, sf_dir):
    return _before_after(spark, sf_dir)[1]


_BA_SQL = """
ba AS (
  SELECT a.PractitionerID, a.PractitionerLocationRecID, a.LocationID,
         CASE WHEN b.PractitionerLocationRecID IS NULL THEN '—' ELSE upper(trim(COALESCE(b.InDirectory, ''))) END
           AS before_flag,
         upper(trim(COALESCE(a.InDirectory, ''))) AS after_flag,
         upper(trim(COALESCE(a.InDirectory, ''))) NOT IN ('N') AS offender,
         COALESCE(a.AuditUser, '') AS audit_user
  FROM practitioner_locations_after a
  LEFT JOIN practitioner_locations_before b ON b.PractitionerLocationRecID = a.PractitionerLocationRecID)"""
_BA_VIEWS = ("practitioner_locations_before", "practitioner_locations_after")
O_BEFORE_AFTER = _with(*_BA_VIEWS, extra=_BA_SQL) + "SELECT * FROM ba"


def q_before_after_summary(spark, sf_dir):
    before, rows = _before_after(spark, sf_dir)
    return fs.before_after_summary(before, rows, "dataloader", enforce_modified_by=False)


O_BEFORE_AFTER_SUMMARY = _with(*_BA_VIEWS, extra=_BA_SQL) + """,
base AS (SELECT PractitionerID, count(*) AS nb,
                count(*) FILTER (WHERE upper(trim(COALESCE(InDirectory, ''))) = 'Y') AS nv
         FROM practitioner_locations_before GROUP BY PractitionerID),
aft AS (SELECT PractitionerID, count(*) AS na, count(*) FILTER (WHERE offender) AS n_off,
               COALESCE(bool_or(contains(lower(audit_user), 'dataloader')), false) AS attributed
        FROM ba GROUP BY PractitionerID),
j AS (SELECT COALESCE(base.PractitionerID, aft.PractitionerID) AS PractitionerID,
             CAST(COALESCE(nb, 0) AS BIGINT) AS n_baseline, CAST(COALESCE(nv, 0) AS BIGINT) AS n_visible_before,
             CAST(COALESCE(na, 0) AS BIGINT) AS n_after, CAST(COALESCE(n_off, 0) AS BIGINT) AS n_offenders,
             COALESCE(attributed, false) AS attributed
      FROM base FULL JOIN aft ON aft.PractitionerID = base.PractitionerID)
SELECT *, CASE WHEN reason IS NULL THEN 'PASS'
               WHEN NOT attributed AND n_offenders = 0 AND n_after > 0 AND n_visible_before > 0 THEN 'WARN'
               ELSE 'FAIL' END AS verdict
FROM (SELECT *, CASE WHEN n_baseline = 0 THEN 'no baseline locations'
                     WHEN n_visible_before = 0 THEN 'no location visible before'
                     WHEN n_after = 0 THEN 'no active locations after'
                     WHEN n_offenders > 0 THEN 'flag not suppressed'
                     WHEN NOT attributed THEN 'change not attributed to ''dataloader''' END AS reason
      FROM j) x"""


def q_payload_rule_echo(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return fs.payload_echo(spark, c["process_status"], c["payload_response"], c["status_targets"], DRIVER_RULES,
                           rules_frame(spark, DRIVER_RULES), C.applied_rule)


_ENTITY_RULES_SQL = _sql_values([(r.key, r.entity_type, r.final_column.lower()) for r in DRIVER_RULES],
                                ["rule_key", "entity_type", "flag"])
O_PAYLOAD_RULE_ECHO = _with("process_status", "payload_response", "status_targets") + f""",
rows AS (SELECT * FROM process_status WHERE process_id IN (SELECT process_id FROM status_targets)),
ids AS (SELECT DISTINCT process_id, trim(payload_response_id) AS payload_response_id FROM rows
        WHERE COALESCE(trim(payload_response_id), '') <> ''),
pl AS (SELECT payload_response_id, arg_min({{'payload': payload, 'response': response}}, COALESCE(payload, '')) AS p
       FROM payload_response GROUP BY payload_response_id),
pp AS (SELECT ids.process_id, ids.payload_response_id,
              COALESCE(pl.p.payload, '') <> '' AS present,
              COALESCE(pl.p.payload, '') || chr(10) || COALESCE(pl.p.response, '') AS txt
       FROM ids LEFT JOIN pl ON pl.payload_response_id = ids.payload_response_id),
pr AS (SELECT DISTINCT r.process_id, u.rule_key, u.flag FROM rows r JOIN {_ENTITY_RULES_SQL} u
         ON lower(r.entity_name) = lower(u.entity_type)),
tok AS (SELECT pp.process_id, pp.payload_response_id, unnest(regexp_extract_all(txt, '{_re(C.applied_rule)}', 1)) AS t
        FROM pp),
echo AS (SELECT DISTINCT tok.process_id, al.rule_key FROM tok JOIN {_ALIASES_SQL} al ON lower(tok.t) = lower(al.alias)),
agg AS (SELECT pr.process_id, pr.rule_key, count(pp.payload_response_id) AS n_payloads,
               count(*) FILTER (WHERE pp.payload_response_id IS NOT NULL AND NOT pp.present) AS n_empty,
               COALESCE(bool_or(contains(lower(pp.txt), pr.flag)), false) AS flag_mentioned
        FROM pr LEFT JOIN pp ON pp.process_id = pr.process_id GROUP BY pr.process_id, pr.rule_key),
bv AS (SELECT DISTINCT process_id, trim(COALESCE(business_value, '')) AS bv FROM rows),
guard AS (SELECT t.process_id, bool_and(bv.bv IS NOT NULL) AS identity_confirmed
          FROM (SELECT DISTINCT process_id, trim(expected_value) AS bv FROM status_targets) t
          LEFT JOIN bv ON bv.process_id = t.process_id AND bv.bv = t.bv GROUP BY t.process_id),
out AS (SELECT agg.process_id, agg.rule_key, CAST(n_payloads AS BIGINT) AS n_payloads, CAST(n_empty AS BIGINT) AS n_empty,
               echo.rule_key IS NOT NULL AS rule_echoed, flag_mentioned,
               COALESCE(guard.identity_confirmed, false) AS identity_confirmed
        FROM agg LEFT JOIN echo ON echo.process_id = agg.process_id AND echo.rule_key = agg.rule_key
                 LEFT JOIN guard ON guard.process_id = agg.process_id)
SELECT *, CASE WHEN reason IS NULL THEN 'PASS' WHEN n_payloads = 0 OR n_empty > 0 THEN 'FAIL' ELSE 'WARN' END AS verdict
FROM (SELECT *, CASE WHEN n_payloads = 0 THEN 'no payload_response_id' WHEN n_empty > 0 THEN 'payload empty'
                     WHEN NOT rule_echoed THEN 'rule not echoed in payload'
                     WHEN NOT flag_mentioned THEN 'flag column not named in payload'
                     WHEN NOT identity_confirmed THEN 'batch-level process row' END AS reason
      FROM out) x"""

QUERIES.update({
    "final_state": q_final_state,
    "before_after": q_before_after,
    "before_after_summary": q_before_after_summary,
    "payload_rule_echo": q_payload_rule_echo,
})
ORACLE.update({
    "final_state": O_FINAL_STATE,
    "before_after": O_BEFORE_AFTER,
    "before_after_summary": O_BEFORE_AFTER_SUMMARY,
    "payload_rule_echo": O_PAYLOAD_RULE_ECHO,
})


# ── streaming monitors ───────────────────────────────────────────────────
from sluice.streaming import monitors as mon  # noqa: E402

LOG_STREAM_DEADLINE = 3 * 86400
_DECIDED_SQL = "strftime(make_timestamp(at_ms * 1000), '%Y-%m-%d %H:%M:%S') AS decided_at"
# The watermark after everything was read: the greatest event time less ten minutes.
_DELAY_MS = 600_000


def _with_decided(df):
    return df.select(*[c for c in df.columns if c != "decided_at"], _ts_text("decided_at"))


def q_stream_terminal(spark, sf_dir):
    ev = catalog(spark, sf_dir).stream_view("process_status").select(
        "id", "process_id", "sub_process_name", "status", F.col("updated_at").cast("timestamp").alias("event_time"))
    return _with_decided(mon.run_available_now(spark, mon.terminal_monitor(ev, mon.LOADER_DEADLINE), "terminal"))


O_STREAM_TERMINAL = _with("process_status", extra=f"""
ev AS (SELECT id, process_id, sub_process_name, upper(trim(COALESCE(status, ''))) AS s, epoch_us(updated_at) // 1000 AS ms FROM process_status),
wm AS (SELECT max(ms) - {_DELAY_MS} AS wm FROM ev),
seen AS (SELECT *, min(ms) OVER (PARTITION BY process_id) AS first_ms FROM ev, wm WHERE ms <= wm),
run AS (
  SELECT *, count(*) OVER w AS n_rows,
         count(*) FILTER (WHERE s IN ('FAILED', 'ERROR')) OVER w AS n_errors,
         count(*) FILTER (WHERE s = 'IN-PROGRESS') OVER w AS n_in_progress,
         count(*) FILTER (WHERE sub_process_name = 'Data-Loader-File') OVER w AS n_loader,
         count(*) FILTER (WHERE sub_process_name = 'Data-Loader-File' AND s IN ('COMPLETED', 'SUCCESS')) OVER w > 0 AS loader_done,
         row_number() OVER (PARTITION BY process_id ORDER BY ms, id) AS nth
  FROM seen WHERE ms <= first_ms + {mon.LOADER_DEADLINE * 1000}
  WINDOW w AS (PARTITION BY process_id ORDER BY ms, id ROWS UNBOUNDED PRECEDING)),
settled AS (SELECT process_id, min(nth) AS nth FROM run WHERE n_errors > 0 OR (loader_done AND n_in_progress = 0) GROUP BY process_id),
last AS (SELECT process_id, max(nth) AS nth FROM run GROUP BY process_id),
picked AS (
  SELECT run.*, settled.nth IS NOT NULL AS done
  FROM run JOIN last ON last.process_id = run.process_id LEFT JOIN settled ON settled.process_id = run.process_id
  WHERE run.nth = COALESCE(settled.nth, last.nth)),
verdicts AS (
  SELECT process_id, CASE WHEN done AND n_errors = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
         CASE WHEN n_errors > 0 THEN 'status rows report errors' WHEN done THEN NULL
              WHEN n_in_progress > 0 THEN 'still IN-PROGRESS' WHEN n_loader = 0 THEN 'no Data-Loader-File row'
              ELSE 'loader did not complete' END AS reason,
         n_rows, n_errors, n_in_progress, n_loader, loader_done,
         CASE WHEN done THEN ms ELSE first_ms + {mon.LOADER_DEADLINE * 1000} END AS at_ms
  FROM picked WHERE done OR first_ms + {mon.LOADER_DEADLINE * 1000} <= wm)""") + f"""
SELECT process_id, verdict, reason, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_errors AS BIGINT) AS n_errors,
       CAST(n_in_progress AS BIGINT) AS n_in_progress, CAST(n_loader AS BIGINT) AS n_loader, loader_done, {_DECIDED_SQL}
FROM verdicts"""


def q_stream_log_done(spark, sf_dir):
    lines = catalog(spark, sf_dir).stream_view("run_log_captures").withColumn(
        "event_time", F.col("modified_at").cast("timestamp") + F.make_dt_interval(secs=F.col("line_no") % 86400))
    return _with_decided(mon.run_available_now(spark, mon.log_completion_monitor(lines, C.sentinel, LOG_STREAM_DEADLINE), "log_done"))


O_STREAM_LOG_DONE = _with("run_log_captures", extra=f"""
ev AS (SELECT run_id, source, epoch_us(CAST(modified_at AS TIMESTAMP)) // 1000 + (line_no % 86400) * 1000 AS ms,
              regexp_matches(message, '{_re(C.sentinel)}') AS hit FROM run_log_captures),
wm AS (SELECT max(ms) - {_DELAY_MS} AS wm FROM ev),
seen AS (SELECT *, min(ms) OVER (PARTITION BY run_id, source) AS first_ms FROM ev, wm WHERE ms <= wm),
within AS (SELECT *, min(CASE WHEN hit THEN ms END) OVER (PARTITION BY run_id, source) AS hit_ms
           FROM seen WHERE ms <= first_ms + {LOG_STREAM_DEADLINE * 1000}),
agg AS (SELECT run_id, source, any_value(hit_ms) AS hit_ms, any_value(first_ms) AS first_ms, any_value(wm) AS wm,
               CAST(count(*) FILTER (WHERE hit_ms IS NULL OR ms <= hit_ms) AS BIGINT) AS n_lines
        FROM within GROUP BY run_id, source),
verdicts AS (SELECT *, COALESCE(hit_ms, first_ms + {LOG_STREAM_DEADLINE * 1000}) AS at_ms
             FROM agg WHERE hit_ms IS NOT NULL OR first_ms + {LOG_STREAM_DEADLINE * 1000} <= wm)""") + f"""
SELECT run_id, source, CASE WHEN hit_ms IS NULL THEN 'FAIL' ELSE 'COMPLETE' END AS verdict, n_lines,
       CASE WHEN hit_ms IS NULL THEN CAST(n_lines AS VARCHAR) || ' event(s), none of them the completion line' END AS reason,
       {_DECIDED_SQL}
FROM verdicts"""


# The driver's runs start long before their objects' dates: a deadline that separates them.
OBJECT_STREAM_DEADLINE = 495 * 86400


def q_stream_objects(spark, sf_dir):
    c = catalog(spark, sf_dir)
    targets = _search_targets(c["runs"], rules_frame(spark, DRIVER_RULES)).withColumn("since", F.col("since").cast("timestamp"))
    beat = c["object_events"].agg(F.max("last_modified").cast("timestamp").alias("since")).select(
        F.lit(None).cast("string").alias("search_id"), F.lit("").alias("target_bucket"), F.lit("").alias("prefix"), "since")
    stored = materialize(targets.unionByName(beat), "searches")
    searches = spark.readStream.schema(stored.schema).parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
    objs = c.stream_view("object_events").withColumn("last_modified", F.col("last_modified").cast("timestamp"))
    out = mon.run_available_now(spark, mon.object_monitor(objs, searches, OBJECT_STREAM_DEADLINE), "objects")
    return out.withColumn("last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss"))


O_STREAM_OBJECTS = _with("runs", "object_events", extra=f"""
clock AS (SELECT max(last_modified) - INTERVAL 10 MINUTE AS t FROM object_events),
best AS (
  SELECT r.run_id || '/' || u.rule_key AS search_id, r.started_at AS since,
         min({{'t': i.last_modified, 'k': i.key}}) FILTER (WHERE i.key IS NOT NULL) AS o
  FROM runs r JOIN {RULES_SQL} u ON u.flow_name = r.flow_name
  LEFT JOIN object_events i ON i.bucket = '{OUTBOUND_BUCKET}' AND starts_with(ltrim(i.key, '/'), u.outbound_prefix)
        AND regexp_matches(string_split(i.key, '/')[-1], '.*\\.csv$')
        AND i.last_modified >= r.started_at AND i.last_modified <= r.started_at + INTERVAL {OBJECT_STREAM_DEADLINE} SECOND
  WHERE r.state = 'SKIPPED_TRIGGER' GROUP BY ALL)""") + f"""
SELECT search_id, o.k AS key, strftime(o.t, '%Y-%m-%d %H:%M:%S') AS last_modified, CASE WHEN o.k IS NULL THEN 'MISSING' ELSE 'FOUND' END AS verdict
FROM best, clock WHERE since + INTERVAL {OBJECT_STREAM_DEADLINE} SECOND <= clock.t"""


def q_stream_flag(spark, sf_dir):
    c = catalog(spark, sf_dir)
    cands = (cand.qualifying_for(spark, directory(spark, sf_dir), DRIVER_RULES, AS_OF)
             .select(F.col("LocationID").alias("record_key")).distinct())
    changes = (c.stream_view("practice_locations_after")
               .select(F.col("LocationID").alias("record_key"), F.col("InDirectory").alias("value"),
                       F.col("ModifiedAt").cast("timestamp").alias("event_time"))
               .join(cands, "record_key", "left_semi"))
    return _with_decided(mon.run_available_now(spark, mon.flag_monitor(changes, ("N",), mon.LOADER_DEADLINE), "flag"))


O_STREAM_FLAG = _with(*DIRECTORY_TABLES, "practice_locations_after", extra=_QUALIFYING_SQL + f""",
ev AS (SELECT CAST(a.LocationID AS VARCHAR) AS record_key, upper(trim(COALESCE(a.InDirectory, ''))) AS v,
              epoch_us(CAST(a.ModifiedAt AS TIMESTAMP)) // 1000 AS ms
       FROM practice_locations_after a WHERE a.LocationID IN (SELECT LocationID FROM qualifying)),
wm AS (SELECT max(ms) - {_DELAY_MS} AS wm FROM ev),
seen AS (SELECT *, min(ms) OVER (PARTITION BY record_key) AS first_ms FROM ev, wm WHERE ms <= wm),
agg AS (SELECT record_key, any_value(first_ms) AS first_ms, any_value(wm) AS wm, min(CASE WHEN v = 'N' THEN ms END) AS hit_ms,
               arg_max(v, ms) AS last_value
        FROM seen WHERE ms <= first_ms + {mon.LOADER_DEADLINE * 1000} GROUP BY record_key),
verdicts AS (SELECT *, COALESCE(hit_ms, first_ms + {mon.LOADER_DEADLINE * 1000}) AS at_ms
             FROM agg WHERE hit_ms IS NOT NULL OR first_ms + {mon.LOADER_DEADLINE * 1000} <= wm)""") + f"""
SELECT record_key, CASE WHEN hit_ms IS NULL THEN 'FAIL' ELSE 'PASS' END AS verdict,
       CASE WHEN hit_ms IS NOT NULL THEN 'N' WHEN last_value = '' THEN 'NULL' ELSE last_value END AS last_value, {_DECIDED_SQL}
FROM verdicts"""


QUERIES.update({
    "stream_terminal": q_stream_terminal,
    "stream_log_done": q_stream_log_done,
    "stream_objects": q_stream_objects,
    "stream_flag": q_stream_flag,
})
ORACLE.update({
    "stream_terminal": O_STREAM_TERMINAL,
    "stream_log_done": O_STREAM_LOG_DONE,
    "stream_objects": O_STREAM_OBJECTS,
    "stream_flag": O_STREAM_FLAG,
})


# ── stage-gated scenario verdict ─────────────────────────────────────────
from sluice.operators import scenario as sc  # noqa: E402


def _scenario(spark, sf_dir, rules, rows, state):
    """The library's scenario on the driver tables.  A count that differs from
    the source only warns: the driver's logs are not about its directory tables."""
    c = catalog(spark, sf_dir)
    rows = c[rows].withColumn("missing_columns", F.array().cast("array<string>"))
    inputs = sc.ScenarioInputs(directory(spark, sf_dir), c["runs"], c["run_log_captures"], c["object_inventory"], rows, c["process_status"], state(c))
    return sc.suppression_scenario(spark, inputs, rules, AS_OF, OUTBOUND_BUCKET, C, enforce_counts=False)


def q_stage_verdict(spark, sf_dir):
    return _scenario(spark, sf_dir, DRIVER_RULES, "outbound_rows",
                     lambda c: {"": fs.final_state_rows(c["practices"], c["practice_locations_after"], c["practice_types"])})


def q_practitioner_stage_verdict(spark, sf_dir):
    return _scenario(spark, sf_dir, PRACTITIONER_RULES, "practitioner_outbound_rows",
                     lambda c: {"practitioner": fs.entity_state_rows(c["practitioners_after"])})


_STAGE_SQL = f"""
pre AS (
  SELECT rule_key, PracticeID, LocationID,
         bool_and(fc = '') AS ok, min(CASE WHEN fc <> '' THEN fc END) AS why
  FROM (SELECT rule_key, PracticeID, LocationID,
               concat_ws(',',
                 CASE WHEN PracticeID = 0 OR PracticeID IS NULL THEN 'identity:PracticeID' END,
                 CASE WHEN LocationID = 0 OR LocationID IS NULL THEN 'identity:LocationID' END,
                 CASE WHEN trim(COALESCE(TaxIDNumber, '')) = '' THEN 'identity:TaxIDNumber' END) AS fc
        FROM qualifying) x
  GROUP BY rule_key, PracticeID, LocationID),
recs AS (
  SELECT pre.rule_key, pre.PracticeID, pre.LocationID, pre.ok, pre.why, wr.run_id, r.state, r.started_at,
         {_canon_sql(_num_text_sql('pre.PracticeID'))} AS k0, {_canon_sql(_num_text_sql('pre.LocationID'))} AS k1,
         CASE WHEN r.state = 'SKIPPED_TRIGGER' THEN concat_ws('/', wr.run_id, pre.rule_key, pre.PracticeID, pre.LocationID) ELSE wr.run_id END AS set_id
  FROM pre LEFT JOIN wr ON wr.rule_key = pre.rule_key AND wr.k0 = {_canon_sql(_num_text_sql('pre.PracticeID'))}
                       AND wr.k1 = {_canon_sql(_num_text_sql('pre.LocationID'))}
           LEFT JOIN runs r ON r.run_id = wr.run_id),
cks AS (SELECT rule_key, PracticeID, LocationID, k0, k1, set_id FROM recs),
held AS (SELECT DISTINCT regexp_replace(file_path, '^[a-z0-9]+://[^/]+/', '') AS key, {_canon_sql(_str_text_sql('PracticeID'))} AS k0
         FROM outbound_rows),
found AS (
  SELECT set_id, bucket, key, size,
         NULLIF(regexp_extract(string_split(key, '/')[-1], '{_re(C.process_id_in_filename)}', 0), '') AS fpid
  FROM (SELECT s.set_id, i.*, row_number() OVER (PARTITION BY s.set_id ORDER BY i.last_modified, i.key) AS nth
        FROM recs s JOIN {RULES_SQL} u ON u.rule_key = s.rule_key
        JOIN object_inventory i ON i.bucket = '{OUTBOUND_BUCKET}' AND starts_with(ltrim(i.key, '/'), u.outbound_prefix)
        JOIN held h ON h.key = i.key AND h.k0 = s.k0
        WHERE s.state = 'SKIPPED_TRIGGER' AND i.last_modified >= s.started_at
          AND regexp_matches(string_split(i.key, '/')[-1], '.*\\.csv$')) x
  WHERE nth = 1),
own AS (SELECT DISTINCT rule_key, run_id AS set_id, 's3://' || bucket || '/' || key AS file_path FROM ent
        UNION SELECT s.rule_key, f.set_id, 's3://' || f.bucket || '/' || f.key FROM found f JOIN recs s ON s.set_id = f.set_id),
{_MATCH_SQL},
astate0 AS (
  SELECT ent.run_id, ent.rule_key, ent.key,
         CASE WHEN i.key IS NULL THEN 'not found' WHEN COALESCE(i.size, 0) = 0 THEN '0 bytes'
              WHEN i.last_modified < r.started_at THEN 'stale' ELSE 'ok' END AS state,
         CASE WHEN i.key IS NULL OR COALESCE(i.size, 0) = 0 THEN 'FAIL'
              WHEN i.last_modified < r.started_at THEN CASE WHEN COALESCE(p.run_verified, false) THEN 'WARN' ELSE 'FAIL' END
              ELSE 'PASS' END AS verdict
  FROM ent LEFT JOIN object_inventory i ON i.bucket = ent.bucket AND i.key = ent.key
           LEFT JOIN runs r ON r.run_id = ent.run_id LEFT JOIN picks p ON p.run_id = ent.run_id),
astate AS (
  SELECT run_id, rule_key,
         CASE WHEN bool_or(verdict = 'FAIL') THEN 'FAIL' WHEN bool_or(verdict = 'WARN') THEN 'WARN' ELSE 'PASS' END
           AS outbound_file_verdict,
         min(CASE WHEN verdict <> 'PASS' THEN key || ': ' || state END) AS outbound_file_reason
  FROM astate0 GROUP BY run_id, rule_key),
logv AS (
  SELECT rr.run_id, rr.rule_key,
         CASE WHEN rep.log_count IS NULL THEN 'log does not report AppliedRule=' || CAST(rr.rule_id AS VARCHAR)
              WHEN rep.log_count < 1 THEN 'rule_count below 1'
              WHEN COALESCE(report.records_to_s3, 0) < 1 THEN 'no output records written'
              WHEN COALESCE(report.n_artifacts, 0) = 0 THEN 'no output artifacts in the log'
              WHEN pid.reason IS NOT NULL THEN pid.reason
              WHEN NOT pid.bucket_ok THEN 'artifact bucket is not the configured bucket'
              WHEN NOT pid.prefix_ok THEN 'artifact key is outside the prefix' END AS lr
  FROM rr LEFT JOIN rep ON rep.run_id = rr.run_id AND rep.rule_key = rr.rule_key
          LEFT JOIN report ON report.run_id = rr.run_id
          LEFT JOIN pid ON pid.run_id = rr.run_id AND pid.rule_key = rr.rule_key),
counts AS (SELECT rule_key, count(DISTINCT LocationID) AS n FROM qualifying GROUP BY rule_key),
recon AS (
  SELECT rr.run_id, rr.rule_key,
         CASE WHEN rep.log_count IS NULL OR rep.log_count < 1 THEN 'FAIL'
              WHEN rep.log_count <> COALESCE(counts.n, 0) THEN 'WARN' ELSE 'PASS' END AS cv
  FROM rr LEFT JOIN rep ON rep.run_id = rr.run_id AND rep.rule_key = rr.rule_key
          LEFT JOIN counts ON counts.rule_key = rr.rule_key),
content AS (
  SELECT rule_key, PracticeID, LocationID, set_id,
         CASE WHEN n_files_checked = 0 THEN 'no outbound files were checked'
              WHEN files_matched = 0 THEN 'record not found in any outbound file'
              WHEN NOT COALESCE(value_any, false) THEN 'unexpected value in a matched file' END AS cr
  FROM m),
term AS (
  SELECT process_id,
         CASE WHEN n_err > 0 THEN 'status rows report errors' WHEN n_ip > 0 THEN 'still IN-PROGRESS'
              WHEN n_ld = 0 THEN 'no Data-Loader-File row' WHEN NOT done THEN 'loader did not complete' END AS tr
  FROM (SELECT process_id, count(*) FILTER (WHERE s IN ('FAILED', 'ERROR')) AS n_err,
               count(*) FILTER (WHERE s = 'IN-PROGRESS') AS n_ip,
               count(*) FILTER (WHERE sub_process_name = 'Data-Loader-File') AS n_ld,
               COALESCE(bool_or(sub_process_name = 'Data-Loader-File' AND s IN ('COMPLETED', 'SUCCESS')), false) AS done
        FROM (SELECT *, upper(trim(COALESCE(status, ''))) AS s FROM process_status) t
        GROUP BY process_id) a),
fstate AS (
  SELECT p2.LocationID, COALESCE(p2.InDirectory, '') AS InDirectory
  FROM practices p JOIN practice_locations_after p2 ON p2.PracticeID = p.PracticeID
  JOIN practice_types pt ON pt.PracticeTypeID = p2.LocationTypeID
  WHERE p.Archived = 'N' AND p2.Archived = 'N'),
fin AS (
  SELECT c.rule_key, CAST(c.LocationID AS VARCHAR) AS LocationID,
         CASE WHEN f.LocationID IS NULL THEN 'final row not found'
              WHEN upper(trim(f.InDirectory)) NOT IN ('N')
              THEN 'expected InDirectory in [''N''], found '
                   || CASE WHEN upper(trim(f.InDirectory)) = '' THEN 'NULL' ELSE upper(trim(f.InDirectory)) END END AS fr
  FROM (SELECT DISTINCT rule_key, LocationID FROM qualifying) c LEFT JOIN fstate f ON f.LocationID = c.LocationID),
st_in AS (
  SELECT s.rule_key, CAST(s.PracticeID AS VARCHAR) AS PracticeID, CAST(s.LocationID AS VARCHAR) AS LocationID, s.run_id, s.state, s.ok, s.why,
         COALESCE(s.state = 'SKIPPED_TRIGGER', false) AS skipped, s.set_id,
         logv.run_id IS NOT NULL AS logged, logv.lr, recon.cv, f.key AS fk, f.size AS fsize, f.fpid, a.outbound_file_verdict AS av,
         a.outbound_file_reason AS ar, CASE WHEN COALESCE(s.state = 'SKIPPED_TRIGGER', false) THEN f.fpid ELSE pid.process_id END AS process_id
  FROM recs s LEFT JOIN logv ON logv.run_id = s.run_id AND logv.rule_key = s.rule_key
              LEFT JOIN recon ON recon.run_id = s.run_id AND recon.rule_key = s.rule_key
              LEFT JOIN found f ON f.set_id = s.set_id
              LEFT JOIN astate a ON a.run_id = s.run_id AND a.rule_key = s.rule_key
              LEFT JOIN pid ON pid.run_id = s.run_id AND pid.rule_key = s.rule_key),
st0 AS (
  SELECT s.rule_key, s.PracticeID, s.LocationID, s.run_id,
         CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS candidate_verdict,
         CASE WHEN NOT ok THEN 'failed checks: ' || why END AS candidate_reason,
         CASE WHEN state IN ('SUCCEEDED', 'SKIPPED_TRIGGER') THEN 'PASS' ELSE 'FAIL' END AS job_verdict,
         CASE WHEN state IS NULL THEN 'no run wrote the record'
              WHEN state NOT IN ('SUCCEEDED', 'SKIPPED_TRIGGER') THEN 'job state ' || state END AS job_reason,
         CASE WHEN skipped THEN CASE WHEN fk IS NOT NULL AND fpid IS NOT NULL THEN 'PASS' ELSE 'FAIL' END
              WHEN NOT logged THEN NULL WHEN lr IS NOT NULL THEN 'FAIL'
              WHEN cv <> 'PASS' THEN cv ELSE 'PASS' END AS run_log_verdict,
         CASE WHEN skipped THEN CASE WHEN fk IS NULL THEN 'no object found by prefix search'
                                     WHEN fpid IS NULL THEN 'no process UUID in the object name' END
              ELSE lr END AS run_log_reason,
         CASE WHEN skipped THEN CASE WHEN COALESCE(fsize, 0) = 0 THEN 'FAIL' ELSE 'PASS' END ELSE av END AS outbound_file_verdict,
         CASE WHEN skipped THEN CASE WHEN COALESCE(fsize, 0) = 0 THEN fk || ': 0 bytes' END ELSE ar END AS outbound_file_reason,
         CASE WHEN ct.rule_key IS NULL THEN NULL WHEN ct.cr IS NULL THEN 'PASS' ELSE 'FAIL' END AS outbound_content_verdict,
         ct.cr AS outbound_content_reason,
         CASE WHEN s.process_id IS NULL OR term.process_id IS NULL THEN 'FAIL'
              WHEN term.tr IS NULL THEN 'PASS' ELSE 'FAIL' END AS dataloader_verdict,
         CASE WHEN s.process_id IS NULL THEN 'no process id for the run'
              WHEN term.process_id IS NULL THEN 'no status rows for the process' ELSE term.tr END AS dataloader_reason,
         CASE WHEN fin.rule_key IS NULL THEN NULL WHEN fin.fr IS NULL THEN 'PASS' ELSE 'FAIL' END AS final_state_verdict,
         fin.fr AS final_state_reason
  FROM st_in s LEFT JOIN content ct ON ct.rule_key = s.rule_key AND ct.PracticeID = s.PracticeID
                                    AND ct.LocationID = s.LocationID AND ct.set_id = s.set_id
               LEFT JOIN term ON term.process_id = s.process_id
               LEFT JOIN fin ON fin.rule_key = s.rule_key AND fin.LocationID = s.LocationID),
st1 AS (SELECT *, COALESCE(candidate_verdict, 'FAIL') AS candidate FROM st0),
st2 AS (SELECT *, CASE WHEN candidate IN ('PASS', 'WARN') THEN COALESCE(job_verdict, 'FAIL') ELSE 'SKIPPED' END AS job FROM st1),
st3 AS (SELECT *, CASE WHEN job IN ('PASS', 'WARN') THEN COALESCE(run_log_verdict, 'FAIL') ELSE 'SKIPPED' END AS run_log FROM st2),
st4 AS (SELECT *, CASE WHEN run_log IN ('PASS', 'WARN') THEN COALESCE(outbound_file_verdict, 'FAIL') ELSE 'SKIPPED' END
                  AS outbound_file FROM st3),
st5 AS (SELECT *, CASE WHEN outbound_file IN ('PASS', 'WARN') THEN COALESCE(outbound_content_verdict, 'FAIL')
                       ELSE 'SKIPPED' END AS outbound_content FROM st4),
st6 AS (SELECT *, CASE WHEN outbound_content IN ('PASS', 'WARN') THEN COALESCE(dataloader_verdict, 'FAIL')
                       ELSE 'SKIPPED' END AS dataloader FROM st5),
st7 AS (SELECT *, CASE WHEN dataloader IN ('PASS', 'WARN') THEN COALESCE(final_state_verdict, 'FAIL')
                       ELSE 'SKIPPED' END AS final_state FROM st6)"""

# Practitioners: their own records, file rows, counts and final state, under the
# names that the later steps read (PracticeID: the provider id, LocationID: the key).
_P_RULES = _sql_values([(r.key, r.rule_id, r.flow_name, r.outbound_prefix) for r in PRACTITIONER_RULES], ["rule_key", "rule_id", "flow_name", "outbound_prefix"])
_P_ALIASES = _sql_values([(r.key, a) for r in PRACTITIONER_RULES for a in sorted(r.rule_ids_accepted)], ["rule_key", "alias"])
_P_KEY = _canon_sql(_str_text_sql('NationalProviderID'))
_P_RECORDS_SQL = f"""
orow AS (SELECT u.rule_key, o.*, {_P_KEY} AS k0, '' AS k1, lower(trim(COALESCE(o.ActiveMilitaryOrReserve, ''))) = 'n' AS good
         FROM practitioner_outbound_rows o JOIN {_P_RULES} u
           ON starts_with(regexp_replace(o.file_path, '^[a-z0-9]+://[^/]+/', ''), u.outbound_prefix)
          AND regexp_extract(o.file_path, '^[a-z0-9]+://([^/]+)/', 1) = '{OUTBOUND_BUCKET}'),
pre AS (
  SELECT rule_key, NationalProviderID AS PracticeID, PractitionerID AS LocationID, {_P_KEY} AS k0, trim(NationalProviderID) <> '' AS ok,
         CASE WHEN trim(NationalProviderID) = '' THEN 'identity:NationalProviderID' END AS why
  FROM (SELECT DISTINCT rule_key, NationalProviderID, PractitionerID FROM pract) x),
recs AS (
  SELECT pre.*, '' AS k1, w.run_id, r.state, r.started_at,
         CASE WHEN r.state = 'SKIPPED_TRIGGER' THEN concat_ws('/', w.run_id, pre.rule_key, pre.PracticeID, pre.LocationID) ELSE w.run_id END AS set_id
  FROM pre LEFT JOIN (SELECT DISTINCT rule_key, k0, run_id FROM orow) w ON w.rule_key = pre.rule_key AND w.k0 = pre.k0 AND pre.k0 <> ''
           LEFT JOIN runs r ON r.run_id = w.run_id),
cks AS (SELECT rule_key, PracticeID, LocationID, k0, k1, set_id FROM recs WHERE set_id IS NOT NULL),
held AS (SELECT DISTINCT regexp_replace(file_path, '^[a-z0-9]+://[^/]+/', '') AS key, {_P_KEY} AS k0 FROM practitioner_outbound_rows),"""
_P_FINAL_SQL = """
counts AS (SELECT rule_key, count(DISTINCT PractitionerID) AS n FROM pract GROUP BY rule_key),"""
_P_FIN_SQL = """
fin AS (
  SELECT c.rule_key, CAST(c.PractitionerID AS VARCHAR) AS LocationID,
         CASE WHEN a.PractitionerID IS NULL THEN 'final row not found'
              WHEN upper(trim(COALESCE(a.ActiveMilitaryOrReserve, ''))) <> 'N'
              THEN 'expected ActiveMilitaryOrReserve in [''N''], found ' || COALESCE(NULLIF(upper(trim(COALESCE(a.ActiveMilitaryOrReserve, ''))), ''), 'NULL') END AS fr
  FROM (SELECT DISTINCT rule_key, PractitionerID FROM pract) c
  LEFT JOIN (SELECT * FROM practitioners_after WHERE Archived = 'N') a ON a.PractitionerID = c.PractitionerID),
"""
_between = lambda a, b: _STAGE_SQL[_STAGE_SQL.index(a):_STAGE_SQL.index(b)]
_P_STAGE_SQL = (_P_RECORDS_SQL + "\n" + _between("found AS (", "counts AS (").replace(RULES_SQL, _P_RULES) + _P_FINAL_SQL.strip() + "\n"
                + _between("recon AS (", "fstate AS (") + _P_FIN_SQL.strip() + "\n" + _STAGE_SQL[_STAGE_SQL.index("st_in AS ("):])

_STAGE_NAMES = ["candidate", "job", "run_log", "outbound_file", "outbound_content", "dataloader", "final_state"]
_STAGE_OUT = f"""
SELECT rule_key, PracticeID, LocationID, run_id, {', '.join(_STAGE_NAMES)},
       COALESCE({', '.join(f"CASE WHEN {s} = 'FAIL' THEN '{s}' END" for s in _STAGE_NAMES)}) AS first_failed_stage,
       COALESCE({', '.join(f"CASE WHEN {s} = 'FAIL' THEN COALESCE({s}_reason, 'no result') END" for s in _STAGE_NAMES)})
         AS reason,
       CASE WHEN {' OR '.join(f"{s} = 'FAIL'" for s in _STAGE_NAMES)} THEN 'FAIL'
            WHEN {' OR '.join(f"{s} = 'WARN'" for s in _STAGE_NAMES)} THEN 'WARN' ELSE 'PASS' END AS verdict
FROM st7"""
_STAGE_VIEWS = (*DIRECTORY_TABLES, *_LOG_VIEWS, "object_inventory", "process_status")
O_STAGE_VERDICT = _with(*_STAGE_VIEWS, "outbound_rows", "practice_locations_after",
                        extra=_QUALIFYING_SQL + "," + _LOG_SQL + "," + _OUTBOUND_SQL + "," + _STAGE_SQL) + _STAGE_OUT
O_PRACTITIONER_STAGE_VERDICT = _with(
    *_STAGE_VIEWS, "practitioner_outbound_rows", "practitioners_after",
    extra=_QUALIFYING_SQL + "," + _PRACTITIONER_SQL + "," + _LOG_SQL.replace(RULES_SQL, _P_RULES).replace(_ALIASES_SQL, _P_ALIASES) + "," + _P_STAGE_SQL
) + _STAGE_OUT.replace("PracticeID, LocationID", "PracticeID AS NationalProviderID, LocationID AS PractitionerID")

QUERIES["final_state_conflicts"] = q_final_state_conflicts
ORACLE["final_state_conflicts"] = O_FINAL_STATE_CONFLICTS
QUERIES["stage_verdict"] = q_stage_verdict
ORACLE["stage_verdict"] = O_STAGE_VERDICT
QUERIES["practitioner_stage_verdict"] = q_practitioner_stage_verdict
ORACLE["practitioner_stage_verdict"] = O_PRACTITIONER_STAGE_VERDICT
