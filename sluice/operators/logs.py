"""Run-log analytics for every run at once (SURVEY §2.2 EXP-9/10, AGG-5/6,
ORD-5/6/7, RULE-3/4, JOIN-9/12, RECON-1/9, FLT-5/9/10).

A *captures* table holds log lines: (run_id, source, file_name, modified_at,
line_no, message, declared_stream); ``line_no`` is any orderable type.
``scan_logs`` parses the lines once and reduces them, with partial
aggregation, to one summary row per (run, source) and one row per fact (a
reported rule, a written artifact).  Everything else works on these two small
tables: no raw line is shuffled, and a run holding a third of all lines is
combined on the map side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.exprs import UUID_PATTERN, file_name, normalise_prefix
from sluice.operators.artifacts import ancestors
from sluice.rules import rule_alias_frame
from sluice.sources.files import read_lines

# ── fixed values: source order of the log retrieval ──────────────────────
SOURCE_ORDER = ("api", "manager", "file")
VALID_MODES = ("auto",) + SOURCE_ORDER
# Watermark value meaning "full scan" (FLT-10).
FULL_SCAN_YEAR = 9999


@dataclass(frozen=True)
class LogContract:
    """Line shapes of a run log, as regular expressions (Java syntax).

    Only the chunk line is known from the reference; the other shapes are
    configuration with these defaults.
    """
    sentinel: str = r"Chunk\s+\d+\s+written\s+to\s+s3://"
    chunk: str = r"Chunk\s+(\d+)\s+written\s+to\s+s3://([^/\s]+)/(\S+)"
    applied_rule: str = r"AppliedRule\s*[=:]\s*([A-Za-z0-9_-]+)"
    rule_count: str = r"rule_count\s*[=:]\s*(\d+)"
    records: str = r"records_to_s3\s*[=:]\s*(\d+)"
    error: str = r"\b(ERROR|Exception|Traceback)\b"
    process_id_in_filename: str = UUID_PATTERN


DEFAULT_CONTRACT = LogContract()


# ── SRC-4: reading captures ──────────────────────────────────────────────
def _line_no(seq, pos):
    """Order of a line: (place of its block or event, place in it)."""
    return F.struct(seq.cast("long").alias("seq"), pos.cast("long").alias("pos")).alias("line_no")


def read_log_files(spark: SparkSession, path: str, run_id: str | None = None, source: str = "file",
                   run_id_pattern: str | None = None) -> DataFrame:
    """Saved log files as captures (lossy UTF-8: bad bytes become U+FFFD).

    The run id is given, or taken from the file name with ``run_id_pattern``
    (group 1), or left null (then only the ``file`` source applies).
    """
    df = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("block"))
    if run_id is not None:
        rid = F.lit(run_id)
    elif run_id_pattern:
        rid = F.nullif(F.regexp_extract("file_name", run_id_pattern, 1), F.lit(""))
    else:
        rid = F.lit(None).cast("string")
    return df.select(
        rid.alias("run_id"), F.lit(source).alias("source"), "file_name", "modified_at",
        _line_no(F.col("block"), F.monotonically_increasing_id()), F.col("value").alias("message"),
        F.lit(None).cast("string").alias("declared_stream"))


def events_to_captures(events: DataFrame, run_id_col: str = "run_id", source: str = "manager") -> DataFrame:
    """Log events given as records: ``message`` when present, else the whole
    record as JSON; a multi-line message becomes one row per line."""
    cols = events.columns
    msg = F.col("message").cast("string") if "message" in cols else F.to_json(F.struct(*[c for c in cols if c != run_id_col]))
    seq = F.col("line_no") if "line_no" in cols else F.monotonically_increasing_id()
    df = events.select(F.col(run_id_col).alias("run_id"), msg.alias("_m"), seq.alias("_seq"))
    exploded = df.select("run_id", "_seq", F.posexplode(F.split("_m", r"\r?\n")).alias("_pos", "message"))
    return exploded.select(
        "run_id", F.lit(source).alias("source"), F.lit(None).cast("string").alias("file_name"),
        F.lit(None).cast("timestamp").alias("modified_at"),
        _line_no(F.col("_seq"), F.col("_pos")), "message",
        F.lit(None).cast("string").alias("declared_stream"))


# ── EXP-10: line parsing ─────────────────────────────────────────────────
def parse_lines(lines: DataFrame, contract: LogContract = DEFAULT_CONTRACT) -> DataFrame:
    m = F.col("message")

    def grp(pattern, i):
        return F.nullif(F.regexp_extract(m, pattern, i), F.lit(""))

    key = grp(contract.chunk, 3)
    return lines.select(
        "run_id", "source", "line_no", "message",
        grp(contract.applied_rule, 1).alias("applied_rule"),
        grp(contract.rule_count, 1).try_cast("long").alias("rule_count"),
        grp(contract.records, 1).try_cast("long").alias("records"),
        grp(contract.chunk, 1).try_cast("int").alias("chunk"),
        grp(contract.chunk, 2).alias("bucket"),
        key.alias("key"),
        m.rlike(contract.error).alias("is_error"),
        m.rlike(contract.sentinel).alias("is_sentinel"),
        *[c for c in ("file_name", "declared_stream") if c in lines.columns],
    )


def log_summary(captures: DataFrame, contract: LogContract = DEFAULT_CONTRACT) -> DataFrame:
    """One row per (run, source): line counts, completion, ownership evidence
    and the line-level figures of AGG-5."""
    msg, rid = F.col("message"), F.col("run_id")
    in_text = F.coalesce(msg.contains(rid), F.lit(False))
    in_name = F.coalesce(F.col("file_name").contains(rid), F.lit(False))
    stream = F.btrim("declared_stream")
    error_at = F.when(F.col("is_error"), F.col("line_no"))
    # In two steps: the smallest stream name of a group is text, for which Spark would sort every line;
    # lines counted by stream name are hashed, and only these few counts go on.
    counts = parse_lines(captures, contract).groupBy("run_id", "source", "declared_stream").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.bool_or("is_sentinel").alias("has_sentinel"),
        F.bool_or(in_text).alias("text_has_run"),
        F.bool_or(in_text | in_name).alias("mentions_run"),
        F.sum("records").alias("records_to_s3"),
        F.count("chunk").alias("total_chunks"),
        F.count_if("is_error").alias("error_lines"),
        F.min_by(F.left("message", F.lit(160)), error_at).alias("first_error"),
        F.min(error_at).alias("first_error_at"))
    return counts.groupBy("run_id", "source").agg(
        F.sum("n_lines").alias("n_lines"),
        F.coalesce(F.bool_or("has_sentinel"), F.lit(False)).alias("has_sentinel"),
        F.bool_or("text_has_run").alias("text_has_run"),
        F.bool_or("mentions_run").alias("mentions_run"),
        F.min(F.when(stream != F.btrim(rid), F.col("declared_stream"))).alias("wrong_stream"),
        F.coalesce(F.bool_or(stream == F.btrim(rid)), F.lit(False)).alias("stream_ok"),
        F.sum("records_to_s3").alias("records_to_s3"),
        F.sum("total_chunks").alias("total_chunks"),
        F.sum("error_lines").alias("error_lines"),
        F.min_by("first_error", "first_error_at").alias("first_error"))


def log_facts(captures: DataFrame, contract: LogContract = DEFAULT_CONTRACT) -> DataFrame:
    """One row per (run, source, fact): a reported rule (``kind`` rule, ``a``
    its spelling) or a written artifact (``kind`` artifact, ``a`` bucket,
    ``b`` key), with first and last places and values."""
    rule = F.when(F.col("applied_rule").isNotNull(), F.struct(
        F.lit("rule").alias("kind"), F.col("applied_rule").alias("a"), F.lit(None).cast("string").alias("b"), F.col("rule_count").alias("value")))
    artifact = F.when(F.col("key").isNotNull(), F.struct(
        F.lit("artifact").alias("kind"), F.col("bucket").alias("a"), F.col("key").alias("b"), F.col("chunk").cast("long").alias("value")))
    facts = parse_lines(captures, contract).select("run_id", "source", "line_no", F.explode(F.filter(F.array(rule, artifact), lambda f: f.isNotNull())).alias("f"))
    valued = F.when(F.col("f.value").isNotNull(), F.col("line_no"))
    return facts.groupBy("run_id", "source", "f.kind", "f.a", "f.b").agg(
        F.count(F.lit(1)).alias("n"), F.min("line_no").alias("position"), F.min_by("f.value", "line_no").alias("first_value"),
        F.max_by("f.value", valued).alias("last_value"), F.max(valued).alias("value_line"))


def scan_logs(captures: DataFrame, contract: LogContract = DEFAULT_CONTRACT) -> tuple[DataFrame, DataFrame]:
    """(summary, facts) of all captures: the only two passes over the lines."""
    return log_summary(captures, contract), log_facts(captures, contract)


# ── RULE-3/4, ORD-6: which source is used per run ─────────────────────────
def source_health(summary: DataFrame) -> DataFrame:
    """Per (run, source): lines, completion line present, ownership proven,
    and why the source cannot be used."""
    rid, src = F.col("run_id"), F.col("source")
    verified = (F.when(src == "api", F.lit(True))
                .when(src == "manager", F.col("text_has_run"))
                .when(F.col("stream_ok"), F.lit(True))
                .otherwise(F.col("mentions_run")))
    failure = (F.when(F.col("n_lines") == 0, F.lit("no lines"))
               .when(~F.col("has_sentinel"), F.lit("no completion line"))
               .when((src == "file") & F.col("wrong_stream").isNotNull(),
                     F.concat(F.lit("declared stream '"), F.col("wrong_stream"), F.lit("' is not run '"),
                              rid, F.lit("'"))))
    rank = F.when(src == "api", 1).when(src == "manager", 2).when(src == "file", 3)
    return summary.select("run_id", "source", rank.alias("source_rank"), "n_lines", "has_sentinel",
                      verified.alias("run_verified"), failure.alias("failure"))


def flag_text(value: str | None) -> str:
    """An option as it is compared: no outer blanks, lower case."""
    return str(value if value is not None else "").strip().lower()


def pick_source(summary: DataFrame, mode: str = "auto") -> DataFrame:
    """ORD-6: the first usable source per run (api, manager, file); without a
    run id only ``file``; an explicit mode uses that source only.  Skipped
    sources are listed with their reason, in source order."""
    mode = flag_text(mode) or VALID_MODES[0]
    if mode not in VALID_MODES:
        raise ValueError(f"log source {mode!r} is none of {', '.join(VALID_MODES)}")
    expected = SOURCE_ORDER if mode == "auto" else (mode,)
    health = source_health(summary).select(
        F.col("run_id").alias("h_run"), F.col("source").alias("h_source"), "n_lines", "run_verified", "failure")
    # Every run is tried on every expected source; a source without lines
    # fails with "no lines" (a constant list exploded per run, not a join).
    grid = (summary.select("run_id").distinct()
            .select("run_id", F.explode(F.array(*[F.lit(x) for x in expected])).alias("source"))
            .where(F.col("run_id").isNotNull() | (F.col("source") == "file")))
    j = grid.join(health, F.col("run_id").eqNullSafe(F.col("h_run")) & (F.col("source") == F.col("h_source")), "left")
    src = F.col("source")
    h = j.select("run_id", "source",
                 F.when(src == "api", 1).when(src == "manager", 2).otherwise(3).alias("source_rank"),
                 F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                 F.coalesce("run_verified", F.lit(False)).alias("run_verified"),
                 F.when(F.col("h_source").isNull(), F.lit("no lines")).otherwise(F.col("failure")).alias("failure"))
    usable = F.col("failure").isNull()
    per_run = h.groupBy("run_id").agg(
        F.min(F.when(usable, F.col("source_rank"))).alias("picked_rank"),
        F.collect_list(F.struct("source_rank", "source", "failure", "n_lines", "run_verified")).alias("_s"))
    picked = F.filter("_s", lambda s: s["source_rank"] == F.col("picked_rank"))
    skipped = F.filter("_s", lambda s: s["failure"].isNotNull()
                       & (F.col("picked_rank").isNull() | (s["source_rank"] < F.col("picked_rank"))))
    skipped = F.array_sort(skipped)
    return per_run.select(
        "run_id",
        F.try_element_at(picked, F.lit(1))["source"].alias("source"),
        F.coalesce(F.try_element_at(picked, F.lit(1))["run_verified"], F.lit(False)).alias("run_verified"),
        F.coalesce(F.try_element_at(picked, F.lit(1))["n_lines"], F.lit(0)).cast("long").alias("n_lines"),
        F.array_join(F.transform(skipped, lambda s: F.concat(s["source"], F.lit(": "), s["failure"])), "; ")
         .alias("failures"),
        F.when(F.col("picked_rank").isNull(), "FAIL").otherwise("OK").alias("state"),
    )


def picked(df: DataFrame, picks: DataFrame) -> DataFrame:
    """The rows of the source chosen for each run (summary or facts)."""
    return df.join(picks.where(F.col("state") == "OK").select("run_id", "source"), ["run_id", "source"], "left_semi").drop("source")


def run_report(summary: DataFrame, facts: DataFrame) -> DataFrame:
    """AGG-5 per run (picked tables): records written (sum of reported values),
    chunk lines, distinct artifacts, rules reported, error lines and the first of them."""
    kinds = facts.groupBy("run_id").agg(F.count_if(F.col("kind") == "artifact").alias("_a"), F.count_if(F.col("kind") == "rule").alias("_r"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return summary.join(kinds, "run_id", "left").select(
        "run_id", "n_lines", "records_to_s3", "total_chunks", zero("_a").alias("n_artifacts"), zero("_r").alias("n_rules"),
        "error_lines", "first_error", "has_sentinel")


def rule_counts(facts: DataFrame) -> DataFrame:
    """Per (run, reported spelling): the count of the last line that gives one
    (a later line without a count leaves it), and where that line is."""
    return facts.where(F.col("kind") == "rule").select(
        "run_id", F.col("a").alias("applied_rule"), F.col("last_value").alias("rule_count"), F.col("n").alias("n_reports"), "value_line")


def log_artifacts(facts: DataFrame, contract: LogContract = DEFAULT_CONTRACT) -> DataFrame:
    """ORD-7 + EXP-6/9: each (bucket, key) once per run, at its first position."""
    fname = file_name(F.col("b"))
    pid = F.nullif(F.regexp_extract(fname, contract.process_id_in_filename, 0), F.lit(""))
    return facts.where(F.col("kind") == "artifact").select(
        "run_id", "position", F.col("first_value").cast("int").alias("chunk"), F.col("a").alias("bucket"), F.col("b").alias("key"),
        fname.alias("filename"), pid.alias("process_id"))


def runs_rules(runs: DataFrame, rules: DataFrame) -> DataFrame:
    """Each run with the rules of its flow (an equi-join on flow name)."""
    return runs.select("run_id", "flow_name", "state", "started_at").join(
        rules.select("rule_key", "rule_id", "flow_name", "outbound_prefix"), "flow_name")


def artifacts_by_rule(artifacts: DataFrame, runs: DataFrame, rules: DataFrame, bucket: str) -> DataFrame:
    """JOIN-9 + FLT-5/9: artifacts under each rule's prefix (leading '/'
    ignored; rules of equal prefixes share them, of nested ones the longest
    wins), with the bucket and strict-prefix checks as columns."""
    rr = runs_rules(runs, rules).withColumn("prefix", normalise_prefix(F.col("outbound_prefix")))
    # Each key's directories meet the prefixes of the run's rules; of nested prefixes the deepest keeps the key.
    j = artifacts.withColumn("_dir", F.explode(ancestors(F.col("key")))).join(
        rr.select("run_id", "rule_key", "prefix", F.col("prefix").alias("_dir")), ["run_id", "_dir"])
    depth = Window.partitionBy("run_id", "bucket", "key")
    j = j.withColumn("_deepest", F.max(F.length("prefix")).over(depth)).where(F.length("prefix") == F.col("_deepest"))
    return j.select(
        "run_id", "rule_key", "position", "chunk", "bucket", "key", "filename", "process_id",
        (F.col("bucket") == F.lit(bucket)).alias("bucket_ok"),
        F.col("key").startswith(F.col("prefix")).alias("prefix_ok"))


def process_id_check(entity_artifacts: DataFrame, runs: DataFrame, rules: DataFrame) -> DataFrame:
    """AGG-6 per (run, rule): distinct process UUIDs of the entity files;
    exactly one is required."""
    rr = runs_rules(runs, rules).select("run_id", "rule_key")
    g = entity_artifacts.groupBy("run_id", "rule_key").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_distinct("process_id").alias("n_process_ids"),
        F.min("process_id").alias("min_pid"), F.max("process_id").alias("max_pid"),
        F.coalesce(F.bool_and("bucket_ok"), F.lit(True)).alias("bucket_ok"),
        F.coalesce(F.bool_and("prefix_ok"), F.lit(True)).alias("prefix_ok"))
    j = rr.join(g, ["run_id", "rule_key"], "left")
    n = F.coalesce("n_process_ids", F.lit(0)).cast("long")
    reason = (F.when(F.coalesce("n_files", F.lit(0)) == 0, F.lit("no output file under the rule prefix"))
              .when(n == 0, F.lit("no process UUID in the output file names"))
              .when(n > 1, F.lit("more than one process UUID")))
    return j.select(
        "run_id", "rule_key", F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        n.alias("n_process_ids"),
        F.when(n == 1, F.col("min_pid")).alias("process_id"),
        F.when(n > 1, F.concat_ws(" .. ", "min_pid", "max_pid")).alias("process_id_range"),
        F.coalesce("bucket_ok", F.lit(True)).alias("bucket_ok"),
        F.coalesce("prefix_ok", F.lit(True)).alias("prefix_ok"),
        F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("verdict"), reason.alias("reason"))


def _reported(rc: DataFrame, spark: SparkSession, rule_list) -> DataFrame:
    """Reported rule tokens matched to rule ids through the alias table; of
    several spellings of a rule, the last line with a count wins."""
    aliases = rule_alias_frame(spark, rule_list)
    return (rc.join(aliases, F.lower(rc["applied_rule"]) == F.lower(aliases["alias"]))
            .groupBy("run_id", "rule_key").agg(F.max_by("rule_count", "value_line").alias("log_count")))


def log_verdict(spark: SparkSession, runs: DataFrame, report: DataFrame, rc: DataFrame, pid: DataFrame,
                rules: DataFrame, rule_list) -> DataFrame:
    """RECON-9 per (run, rule of its flow): the first failing reason wins."""
    rr = runs_rules(runs, rules).select("run_id", "rule_key", "rule_id")
    rep = _reported(rc, spark, rule_list)
    j = (rr.join(rep, ["run_id", "rule_key"], "left")
         .join(report.select("run_id", "records_to_s3", "n_artifacts"), "run_id", "left")
         .join(pid.select("run_id", "rule_key", "n_files", "n_process_ids", "process_id", "bucket_ok",
                          "prefix_ok", F.col("reason").alias("pid_reason")), ["run_id", "rule_key"], "left"))
    reason = (F.when(F.col("log_count").isNull(), F.concat(F.lit("log does not report AppliedRule="),
                                                           F.col("rule_id").cast("string")))
              .when(F.col("log_count") < 1, F.lit("rule_count below 1"))
              .when(F.coalesce("records_to_s3", F.lit(0)) < 1, F.lit("no output records written"))
              .when(F.coalesce("n_artifacts", F.lit(0)) == 0, F.lit("no output artifacts in the log"))
              .when(F.col("pid_reason").isNotNull(), F.col("pid_reason"))
              .when(~F.col("bucket_ok"), F.lit("artifact bucket is not the configured bucket"))
              .when(~F.col("prefix_ok"), F.lit("artifact key is outside the prefix")))
    return j.select("run_id", "rule_key", "log_count", "records_to_s3",
                    F.coalesce("n_artifacts", F.lit(0)).cast("long").alias("n_artifacts"),
                    F.coalesce("n_files", F.lit(0)).cast("long").alias("n_entity_files"), "process_id",
                    F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("verdict"), reason.alias("reason"))


def reconcile_counts(spark: SparkSession, runs: DataFrame, rc: DataFrame, counts: DataFrame, rules: DataFrame,
                     rule_list, enforce: bool = True, full_scan: bool = True) -> DataFrame:
    """RECON-1/JOIN-12 per (run, rule of its flow): log count vs source count.

    Missing or < 1 fails; a difference fails when enforced, else warns; on an
    incremental (delta) run the comparison is not valid and is skipped."""
    rr = runs_rules(runs, rules).select("run_id", "rule_key", "rule_id")
    rep = _reported(rc, spark, rule_list)
    j = rr.join(rep, ["run_id", "rule_key"], "left").join(
        counts.select("rule_key", F.col("candidate_count").alias("source_count")), "rule_key", "left")
    lc, sc = F.col("log_count"), F.coalesce("source_count", F.lit(0))
    mismatch = "FAIL" if enforce else "WARN"
    verdict = (F.when(lc.isNull(), "FAIL").when(lc < 1, "FAIL")
               .when(lc != sc, F.lit(mismatch if full_scan else "SKIPPED")).otherwise("PASS"))
    reason = (F.when(lc.isNull(), F.lit("rule not reported in the log"))
              .when(lc < 1, F.lit("rule_count below 1"))
              .when(lc != sc, F.concat(F.lit("log rule_count "), lc.cast("string"), F.lit(" != source count "),
                                       sc.cast("string"))))
    return j.select("run_id", "rule_key", "log_count", sc.cast("long").alias("source_count"),
                    verdict.alias("verdict"), reason.alias("reason"))


def incremental(df: DataFrame, ts_col: str, watermark: str) -> DataFrame:
    """FLT-10: a watermark in year 9999 means full scan; otherwise only rows
    changed after it."""
    if str(watermark).startswith(str(FULL_SCAN_YEAR)):
        return df
    return df.where(F.col(ts_col) > F.to_timestamp(F.lit(watermark)))



# ── ORD-5: which saved log file to read ──────────────────────────────────
def _glob_to_like(pattern: str) -> str:
    out = []
    for ch in pattern:
        out.append("%" if ch == "*" else "_" if ch == "?" else "\\" + ch if ch in "%_\\" else ch)
    return "".join(out)


def newest_log_files(listing: DataFrame, runs: DataFrame, directories: list[str], patterns: list[str],
                     run_id_pattern: str) -> DataFrame:
    """ORD-5 for every run: the newest non-empty file of the first
    (directory, pattern) pair, in order, that has any; an earlier directory or
    pattern wins over a newer file elsewhere.

    ``listing``: (path, size, modified_at); ``patterns`` are file-name globs,
    ``{run_id}`` standing for the run.  Such a pattern is tried only on files
    that carry the run's id (an equi-join on the id taken from the file name with
    ``run_id_pattern``), and the whole name must fit it; the other patterns do not depend on the run, so their best file is one
    row, computed once and compared with each run's own best.
    """
    spark = listing.sparkSession
    files = listing.where(F.col("size") > 0).withColumn("name", F.substring_index("path", "/", -1))
    pairs = [(di, d.rstrip("/") + "/", pi, p) for di, d in enumerate(directories) for pi, p in enumerate(patterns)]
    generic = [(di, d, pi, _glob_to_like(p)) for di, d, pi, p in pairs if "{run_id}" not in p]
    specific = [(di, d, pi, _glob_to_like(p)) for di, d, pi, p in pairs if "{run_id}" in p]
    newest = F.max_by("path", F.struct("modified_at", "path")).alias("path")      # equal times: the greater path
    gen_rank, gen_path = None, None
    if generic:
        cfg = F.broadcast(spark.createDataFrame(generic, "dir_rank int, dir string, pat_rank int, pat string"))
        g = (files.join(cfg, files["path"].startswith(cfg["dir"]) & F.expr("name LIKE pat"))
             .groupBy("dir_rank", "pat_rank").agg(newest))
        top = g.orderBy("dir_rank", "pat_rank").first()        # one row: bounded by the configuration
        if top is not None:
            gen_rank, gen_path = (top["dir_rank"], top["pat_rank"]), top["path"]
    out = runs.select("run_id").distinct()
    if specific:
        cfg = F.broadcast(spark.createDataFrame(specific, "dir_rank int, dir string, pat_rank int, pat string"))
        f = files.withColumn("run_id", F.nullif(F.regexp_extract("name", run_id_pattern, 1), F.lit("")))
        # the whole name must fit the pattern with this run's id in it
        own = F.expr(r"name LIKE replace(pat, '{run\\_id}', replace(replace(run_id, '_', r'\_'), '%', r'\%'))")
        s = (f.join(out, "run_id").join(cfg, f["path"].startswith(cfg["dir"])).where(own)
             .groupBy("run_id", "dir_rank", "pat_rank").agg(newest)
             .groupBy("run_id").agg(F.min(F.struct("dir_rank", "pat_rank")).alias("_r"),
                                    F.min_by("path", F.struct("dir_rank", "pat_rank")).alias("_p")))
        out = out.join(s, "run_id", "left")
    else:
        out = out.select("run_id", F.lit(None).cast("struct<dir_rank:int,pat_rank:int>").alias("_r"),
                         F.lit(None).cast("string").alias("_p"))
    if gen_rank is None:
        path = F.col("_p")
    else:
        gr = F.struct(F.lit(gen_rank[0]).alias("dir_rank"), F.lit(gen_rank[1]).alias("pat_rank"))
        path = F.when(F.col("_p").isNotNull() & (F.col("_r") < gr), F.col("_p")).otherwise(F.lit(gen_path))
    return out.select("run_id", path.alias("path"))


def newest_log_captures(listing: DataFrame, runs: DataFrame, directories: list[str], patterns: list[str], run_id_pattern: str) -> DataFrame:
    """SRC-4 + ORD-5: the lines of each run's newest log file as captures of
    source ``file``.  Only the chosen files are opened.  ``listing`` may name a file's
    place by ``stored`` where that differs from its ``path``; a file chosen by several runs is read once."""
    stored = F.col("stored") if "stored" in listing.columns else F.col("path")
    chosen = newest_log_files(listing, runs, directories, patterns, run_id_pattern).where(F.col("path").isNotNull())
    files = listing.select("path", stored.alias("stored"), "size", "modified_at").join(chosen.select("path").distinct(), "path", "left_semi")
    lines = read_lines(files, "stored").select(
        "path", "modified_at", _line_no(F.lit(0), F.col("offset")), F.col("line").alias("message"))
    return lines.join(chosen, "path").select(
        "run_id", F.lit("file").alias("source"), F.substring_index("path", "/", -1).alias("file_name"), "modified_at", "line_no", "message",
        F.lit(None).cast("string").alias("declared_stream"))
