"""Process-status analytics for every split at once (SURVEY §2.5, AGG-2..4,
JOIN-5/6, ORD-2/4, AGG-10/11/13).

The reference asks the status database once per split and once more per
schema error; here the status table is read once.  Counters are aggregated
per process *before* the join with the split list (partial aggregation on the
map side, so a process holding a third of all rows never moves as raw rows),
and the payload lookup is a left join whose key is null for rows that do not
need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.exprs import (
    EMPTY_ERROR_REASON, MISSING_ERROR_TYPE, MISSING_STATUS, MISSING_SUB_PROCESS,
    SCHEMA_VALIDATION_ERROR, STATUS_COMPLETED, STATUS_ERRORED, first_lines, json_normalise, or_default,
    text_norm,
)

# ── fixed values: report texts ────────────────────────────────────────────
NO_ROWS_REASON = "No records in process_status"
NO_PAYLOAD_ID = "(no payload_response_id available)"
NO_PAYLOAD_RECORD = "(no payload_response record for id={})"
EMPTY_RESPONSE = "(response field is empty)"
# A preview is at most 20 lines and so many characters (a JSON reason is one line).
PREVIEW_CHARS = 2000
LOADER_SUB_PROCESS = "Data-Loader-File"
RECORD_SUB_PROCESS = "File-Record"
# Different errors listed per process, the commonest first.
MAX_ERRORS = 5


def classify(status: DataFrame) -> DataFrame:
    """Adds ``status_norm`` and the three classes of AGG-2 (H4: only
    COMPLETED is done here; null and SUCCESS count as stuck)."""
    s = F.upper(text_norm(F.col("status")))
    return status.select("*", s.alias("status_norm"), (s == STATUS_COMPLETED).alias("is_completed"),
                         s.isin(*STATUS_ERRORED).alias("is_errored"),
                         (~s.isin(STATUS_COMPLETED, *STATUS_ERRORED)).alias("is_stuck"))


def process_counters(status: DataFrame) -> DataFrame:
    c = classify(status)
    return c.groupBy("process_id").agg(
        F.count(F.lit(1)).alias("total_sub_processes"),
        F.count_if("is_completed").alias("completed"),
        F.count_if("is_errored").alias("errored"),
        F.count_if("is_stuck").alias("stuck"),
    )


def split_results(splits: DataFrame, status: DataFrame | None = None, counters: DataFrame | None = None) -> DataFrame:
    """AGG-2 + JOIN-6: one row per listed split (duplicates stay duplicates).

    PASS iff the split has rows and none errored or stuck; a split without
    rows fails with its own reason.  ``counters`` (as ``process_counters``
    gives them, or an incremental run) may be given instead of the status rows.
    """
    counters = process_counters(status) if counters is None else counters
    j = splits.join(counters, splits["split_process_id"] == counters["process_id"], "left")
    total = F.coalesce("total_sub_processes", F.lit(0)).cast("long")
    errored = F.coalesce("errored", F.lit(0)).cast("long")
    stuck = F.coalesce("stuck", F.lit(0)).cast("long")
    return j.select(
        "position", "split_process_id",
        total.alias("total_sub_processes"),
        F.coalesce("completed", F.lit(0)).cast("long").alias("completed"),
        errored.alias("errored"), stuck.alias("stuck"),
        F.when((total > 0) & (errored == 0) & (stuck == 0), "PASS").otherwise("FAIL").alias("status"),
        F.when(total == 0, F.lit(NO_ROWS_REASON)).alias("reason"),
    )


def split_totals(results: DataFrame) -> DataFrame:
    """AGG-3: totals over splits; overall PASS iff no split failed (an empty
    split list passes)."""
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return results.agg(
        F.count(F.lit(1)).alias("total_splits"),
        z(F.count_if(F.col("status") == "PASS")).alias("splits_passed"),
        z(F.count_if(F.col("status") == "FAIL")).alias("splits_failed"),
        z(F.sum("total_sub_processes")).alias("total_sub_processes"),
        z(F.sum("completed")).alias("total_completed"),
        z(F.sum("errored")).alias("total_errored"),
        z(F.sum("stuck")).alias("total_stuck"),
    ).withColumn("overall_status", F.when(F.col("splits_failed") == 0, "PASS").otherwise("FAIL"))


def dedupe_payloads(payloads: DataFrame, order_col: str | None = None) -> DataFrame:
    """SRC-3: one response per id; "first" is the smallest ``order_col``
    (default the response text itself), so the choice is deterministic."""
    order = F.col(order_col) if order_col else F.coalesce("response", F.lit(""))
    return payloads.groupBy("payload_response_id").agg(
        F.min_by("response", order).alias("response"), F.lit(True).alias("_found"))


def error_details(splits: DataFrame, status: DataFrame, payloads: DataFrame) -> DataFrame:
    """JOIN-5: errored rows of every listed split with their detailed reason.

    Only ``schema-validation-error`` rows (strip, case-insensitive) look up the
    payload response; its outcomes are: no id, no record, empty response, or
    the response (JSON normalised, other text unchanged).
    """
    c = classify(status).where("is_errored")
    rows = c.join(splits, c["process_id"] == splits["split_process_id"])
    err = text_norm(F.col("error"))
    pr_id = F.coalesce(F.col("payload_response_id").cast("string"), F.lit(""))
    is_schema = F.lower(err) == SCHEMA_VALIDATION_ERROR
    rows = rows.select("*", err.alias("_err"), pr_id.alias("_pr"), is_schema.alias("_schema"),
                       # rows that need no payload get a key of their own, so they spread
                       F.when(is_schema & (pr_id != ""), pr_id).otherwise(F.concat(F.lit("\0"), F.xxhash64("id", "process_id").cast("string"))).alias("_key"))
    pl = dedupe_payloads(payloads).withColumnRenamed("payload_response_id", "_key")
    j = rows.join(pl, "_key", "left")
    resp = F.col("response")
    schema_reason = (F.when(F.col("_pr") == "", F.lit(NO_PAYLOAD_ID))
                     .when(F.col("_found").isNull(), F.format_string(NO_PAYLOAD_RECORD.replace("{}", "%s"), F.col("_pr")))
                     .when(F.coalesce(resp, F.lit("")) == "", F.lit(EMPTY_RESPONSE))
                     .otherwise(json_normalise(resp)))
    return j.select(
        "position", "split_process_id", "id",
        or_default(rows, "sub_process_name", MISSING_SUB_PROCESS).alias("sub_process"),
        F.col("sub_process_name"),
        or_default(rows, "business_value", "").alias("business_value"),
        text_norm(F.col("status")).alias("status"),
        F.when(F.col("_schema"), F.lit(SCHEMA_VALIDATION_ERROR))
         .otherwise(F.coalesce(F.nullif("_err", F.lit("")), F.lit(MISSING_ERROR_TYPE))).alias("error_type"),
        F.col("_err").alias("raw_error"),
        F.when(F.col("_schema"), schema_reason)
         .otherwise(F.coalesce(F.nullif("_err", F.lit("")), F.lit(EMPTY_ERROR_REASON))).alias("detailed_reason"),
        F.col("_pr").alias("payload_response_id"),
        F.coalesce(F.col("notes").cast("string"), F.lit("")).alias("notes"),
    ).withColumn("reason_preview", F.left(first_lines(F.col("detailed_reason"), 20), F.lit(PREVIEW_CHARS)))


def stuck_details(splits: DataFrame, status: DataFrame, n: int = 10) -> DataFrame:
    """ORD-4: the first ``n`` stuck rows per listed split, in status-table
    order (sub_process_name, id).  ``row_number() <= n`` plans as a window
    group limit, so each task keeps only n rows per split before the shuffle."""
    c = classify(status).where("is_stuck")
    rows = c.join(splits, c["process_id"] == splits["split_process_id"])
    w = Window.partitionBy("position", "split_process_id").orderBy(
        F.col("sub_process_name").asc_nulls_last(), F.col("id").asc())
    return (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("position", "split_process_id", "rank", "id",
                    or_default(rows, "sub_process_name", MISSING_SUB_PROCESS).alias("sub_process"),
                    or_default(rows, "business_value", "").alias("business_value"),
                    F.coalesce(F.nullif(text_norm(F.col("status")), F.lit("")), F.lit(MISSING_STATUS)).alias("status")))


def failure_breakdown(details: DataFrame) -> DataFrame:
    """AGG-4: occurrences per error type with the first-seen sample.

    First seen = smallest (split position, sub_process_name, id), the order in
    which the reference walks splits and rows; ties in count keep that order.
    """
    first = F.struct(F.col("position"), F.coalesce("sub_process_name", F.lit("\U0010ffff")), F.col("id"))
    sample = F.struct("sub_process", "business_value", F.left("detailed_reason", F.lit(300)).alias("reason"))
    agg = details.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.min(first).alias("_first"),
        F.min_by(sample, first).alias("_sample"))
    # most frequent first; ties in first-seen order, as the report lists them
    return agg.orderBy(F.desc("occurrences"), F.asc("_first")).select(
        "error_type", "occurrences",
        F.col("_first.position").alias("first_position"),
        F.col("_sample.sub_process").alias("sample_sub_process"),
        F.col("_sample.business_value").alias("sample_business_value"),
        F.col("_sample.reason").alias("sample_reason"),
    )


def consolidated_verdict(totals: DataFrame, comparison: DataFrame | None = None) -> DataFrame:
    """AGG-13: every failure signal folded into one verdict row and message.

    ``comparison`` is an ``id_overlap`` row (status, overlap_pct_text, diff_pct_text).
    """
    # the comparison is one row (a global aggregate) and enters as scalar subqueries
    one = lambda c: comparison.select(c).scalar() if comparison is not None else F.lit(None).cast("string")
    t = totals.select("*", one("status").alias("cmp_status"), one("overlap_pct_text").alias("overlap_pct_text"),
                      one("diff_pct_text").alias("diff_pct_text"))
    details = F.concat_ws(", ",
                          F.when(F.col("total_errored") > 0, F.concat(F.col("total_errored").cast("string"), F.lit(" errored"))),
                          F.when(F.col("total_stuck") > 0, F.concat(F.col("total_stuck").cast("string"), F.lit(" stuck"))))
    cmp_problem = F.when(F.col("cmp_status") == "FAIL", F.concat(
        F.lit("source/output count mismatch - overlap "), F.col("overlap_pct_text"),
        F.lit(", diff "), F.col("diff_pct_text")))
    split_problem = F.when(F.col("overall_status") == "FAIL", F.concat(
        F.col("splits_failed").cast("string"), F.lit("/"), F.col("total_splits").cast("string"),
        F.lit(" split(s) FAILED - "), details, F.lit(" sub-process(es).")))
    problems = F.concat_ws("\n  ", cmp_problem, split_problem)
    return t.select(
        "total_splits", "splits_failed", "total_errored", "total_stuck",
        F.when(problems == "", "PASS").otherwise("FAIL").alias("verdict"),
        F.when(problems == "", F.lit("")).otherwise(F.concat(F.lit("validation FAILED:\n  "), problems)).alias("message"),
    )


def terminal_state(status: DataFrame, loader: str = LOADER_SUB_PROCESS, record: str = RECORD_SUB_PROCESS,
                   process_ids: DataFrame | None = None) -> DataFrame:
    """AGG-10/11 per process: no errors, none IN-PROGRESS, at least one loader
    row, and a loader row COMPLETED or SUCCESS (H4: this policy accepts
    SUCCESS).  The first failing condition gives the reason."""
    c = classify(status)
    if process_ids is not None:
        # FLT-8: by process id, or by process id + business value when given
        keys = ["process_id"] + (["business_value"] if "business_value" in process_ids.columns else [])
        c = c.join(process_ids.select(*keys).distinct(), keys, "left_semi")
    name = F.col("sub_process_name")
    statuses = lambda sub: F.array_join(F.sort_array(F.collect_set(F.when(name == sub, F.col("status_norm")))), ",")
    agg = c.groupBy("process_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_errored").alias("n_errors"),
        F.count_if(F.col("status_norm") == "IN-PROGRESS").alias("n_in_progress"),
        F.count_if(name == loader).alias("n_loader"),
        F.count_if(name == record).alias("n_record"),
        F.coalesce(F.bool_or((name == loader) & F.col("status_norm").isin("COMPLETED", "SUCCESS")),
                   F.lit(False)).alias("loader_done"),
        statuses(loader).alias("loader_statuses"), statuses(record).alias("record_statuses"))
    # The commonest errors of each process: counted first, so a list never holds more than MAX_ERRORS.
    text = F.coalesce(F.nullif(text_norm(F.col("error")), F.lit("")) if "error" in c.columns else F.lit(None), F.col("status_norm"))
    counted = c.where("is_errored").groupBy("process_id", text.alias("_e")).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy("process_id").orderBy(F.desc("_n"), "_e"))
    entry = F.concat("_e", F.lit(" ("), F.col("_n").cast("string"), F.lit(")"))
    listed = (counted.withColumn("_rank", rank).where(F.col("_rank") <= MAX_ERRORS).groupBy("process_id")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rank", entry.alias("e")))), lambda x: x["e"]), "; ").alias("errors")))
    agg = agg.join(listed, "process_id", "left").withColumn("errors", F.coalesce("errors", F.lit("")))
    verdict_reason = (F.when(F.col("n_errors") > 0, F.lit("status rows report errors"))
                      .when(F.col("n_in_progress") > 0, F.lit("still IN-PROGRESS"))
                      .when(F.col("n_loader") == 0, F.lit(f"no {loader} row"))
                      .when(~F.col("loader_done"), F.lit("loader did not complete")))
    return agg.select("*", F.when(verdict_reason.isNull(), "PASS").otherwise("FAIL").alias("verdict"),
                      verdict_reason.alias("reason"))
