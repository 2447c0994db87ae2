"""The suppression scenario over whole tables (RULE-5, RULE-6).

A scenario is a list of ``Stage``: a name, a frame of verdicts with its own
key, and the stages that must have passed before.  ``run_stages`` brings the
frames to the records and folds the gates.  ``suppression_scenario`` builds the
stages of any list of rules: rules of one shape (entity, identity map, final
key) are planned together, and logs, inventory and statuses are read once for all.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.exprs import canon_id, process_uuid, text_norm
from sluice.operators import artifacts, candidates, finalstate, logs, outbound, status
from sluice.operators.verdict import OK, STAGES, job_stage, worst
from sluice.rules import SuppressionRule, rules_frame
from sluice.session import materialize


@dataclass(frozen=True)
class Stage:
    """A verdict per record: from ``frame`` (one row per ``key``, ``verdict``,
    ``reason``) or, without one, from two columns of the record itself.  It
    runs only for records whose ``after`` stages passed or warned.  A record
    that the frame does not hold fails, for the reason ``absent``."""

    name: str
    after: Sequence[str] = ()
    frame: DataFrame | None = None
    key: Sequence[str] = ()
    verdict: Column | None = None
    reason: Column | None = None
    absent: Column | None = None


def run_stages(records: DataFrame, stages: Sequence[Stage]) -> DataFrame:
    """``records`` with a column per stage (PASS, WARN, FAIL, SKIPPED), the
    first failed stage in declared order, its reason and the whole verdict.
    A stage without any verdict for a record (a null key included) fails with
    ``absent`` or "no result".  Stages are declared after those they wait for."""
    seen: list[str] = []
    out = records
    for k, s in enumerate(stages):
        if s.name in (*records.columns, *seen):
            raise ValueError(f"stage name {s.name} is taken")
        if unknown := [a for a in s.after if a not in seen]:
            raise ValueError(f"stage {s.name} waits for {', '.join(unknown)}, not declared before it")
        seen.append(s.name)
        if s.frame is None:
            out = out.select("*", s.verdict.alias(f"_v{k}"), s.reason.alias(f"_r{k}"))
        else:
            out = out.join(s.frame.select(*s.key, F.col("verdict").alias(f"_v{k}"), F.col("reason").alias(f"_r{k}")), list(s.key), "left")
    gates: dict[str, Column] = {}
    for k, s in enumerate(stages):
        out = out.withColumn(f"_s{k}", _gated(F.col(f"_v{k}"), [gates[a] for a in s.after]))
        gates[s.name] = F.col(f"_s{k}")
    whole = [(s, gates[s.name], F.col(f"_v{k}"), F.col(f"_r{k}")) for k, s in enumerate(stages)]
    none = F.lit("no result")
    first = F.coalesce(*[F.when(v == "FAIL", F.lit(s.name)) for s, v, _, _ in whole])
    why = F.coalesce(*[F.when(v == "FAIL", F.coalesce(F.when(got.isNull(), none if s.absent is None else s.absent), r, none)) for s, v, got, r in whole])
    warned = F.greatest(F.lit(0), F.lit(0), *[(v == "WARN").cast("int") for v in gates.values()]) == 1
    return out.select(*[F.col(c) for c in records.columns], *[v.alias(n) for n, v in gates.items()], first.alias("first_failed_stage"), why.alias("reason"),
                      F.when(first.isNotNull(), "FAIL").when(warned, "WARN").otherwise("PASS").alias("verdict"))


def _gated(verdict: Column, before: list[Column]) -> Column:
    open_ = F.lit(True)
    for v in before:
        open_ = open_ & v.isin(*OK)
    return F.when(open_, F.coalesce(verdict, F.lit("FAIL"))).otherwise("SKIPPED")


@dataclass(frozen=True)
class ScenarioInputs:
    """The tables of one scenario run.

    ``directory``: the tables of candidate selection.  ``runs`` (run_id, flow,
    state, started_at), ``captures`` (log lines), ``inventory`` (objects),
    ``status`` (process statuses).  ``outbound``: rows of the outbound files
    with ``run_id``, ``file_path``, ``row_no``, ``missing_columns``; ``files``
    adds files without rows.  ``state``: the rows after the load by entity type
    (``""``: every entity without its own)."""

    directory: dict[str, DataFrame]
    runs: DataFrame
    captures: DataFrame
    inventory: DataFrame
    outbound: DataFrame
    status: DataFrame
    state: dict[str, DataFrame]
    files: DataFrame | None = None


def _path(bucket, key) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def _shapes(rules: Sequence[SuppressionRule]) -> list[list[SuppressionRule]]:
    """Rules that share their record, identity map and search field."""
    found = defaultdict(list)
    for r in rules:
        own = candidates.BINDINGS.get(r.entity_type) if candidates._bound(r) else None
        found[(own, r.outbound_identity_map, r.outbound_search_field, tuple(r.final_key_columns))].append(r)
    return list(found.values())


def record_columns(rule: SuppressionRule) -> list[str]:
    """What tells a rule's records apart: identity for the files, key of the final row."""
    return list(dict.fromkeys([a for a, _ in rule.outbound_identity_map] + list(rule.final_key_columns)))


def suppression_scenario(spark: SparkSession, inputs: ScenarioInputs, rules: Sequence[SuppressionRule], as_of: str, bucket: str,
                         contract: logs.LogContract = logs.DEFAULT_CONTRACT, value_mode: str = "any", enforce_counts: bool = True) -> DataFrame:
    """One row per (rule, record, run that wrote it): the stages of
    ``verdict.STAGES`` in order, each after the one before.  Columns: rule_key,
    the record columns of all rules (text; null where a rule has none), run_id, and those of ``run_stages``.

    A run whose trigger was skipped has no log: the first object under the
    rule's prefix that holds the record's search value is looked up instead,
    its name gives the process id, and it alone is the record's file.
    ``enforce_counts=False`` lets a count that differs from the source only warn.
    Records with a blank identifier match no file row and have no run."""
    rules = list(rules)
    table = rules_frame(spark, rules)
    runs, inv = inputs.runs, materialize(inputs.inventory, "inventory")
    summary, facts = (materialize(t, "log-scan") for t in logs.scan_logs(inputs.captures, contract))
    picks = logs.pick_source(summary)
    summary, facts = logs.picked(summary, picks), logs.picked(facts, picks)
    arts = logs.artifacts_by_rule(logs.log_artifacts(facts, contract), runs, table, bucket)
    pid = logs.process_id_check(arts, runs, table)
    reported = logs.rule_counts(facts)
    log_rows = logs.log_verdict(spark, runs, logs.run_report(summary, facts), reported, pid, table, rules)
    art_rows = (artifacts.check_artifacts(arts, inv, runs, picks).groupBy("run_id", "rule_key")
                .agg(worst("verdict").alias("_av"), F.min(F.when(F.col("verdict") != "PASS", F.concat_ws(": ", "key", "state"))).alias("_ar")))
    shared = {"table": table, "runs": runs, "inv": inv, "arts": arts, "pid": pid, "reported": reported, "log_rows": log_rows, "art_rows": art_rows}
    out = None
    for shape in _shapes(rules):
        part = _shape(spark, inputs, shape, as_of, bucket, value_mode, enforce_counts, **shared)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = list(dict.fromkeys(c for r in rules for c in record_columns(r)))
    return out.select("rule_key", *names, "run_id", *STAGES, "first_failed_stage", "reason", "verdict")


def _shape(spark, inputs, shape, as_of, bucket, value_mode, enforce_counts, *, table, runs, inv, arts, pid, reported, log_rows, art_rows) -> DataFrame:
    """The scenario of rules that share their records."""
    head = shape[0]
    cols, keys = record_columns(head), [a for a, _ in head.outbound_identity_map]
    theirs = [b for _, b in head.outbound_identity_map]
    mine = F.col("rule_key").isin([r.key for r in shape])
    own_rules = table.where(mine)
    bound = candidates._bound(head)
    found = (candidates.qualifying_entity(spark, inputs.directory, bound, shape, as_of) if bound
             else candidates.qualifying_for(spark, inputs.directory, shape, as_of))
    found = materialize(found, "qualifying")
    checks = (candidates.check_preconditions(spark, found, shape).groupBy("rule_key", *cols)
              .agg(F.bool_and("passed").alias("_ok"), F.min(F.when(~F.col("passed"), F.array_join("failed_checks", ","))).alias("_why")))
    counts = candidates.counts_of(spark, found, shape, bound.key if bound else "LocationID")

    # Records once per run that wrote them; the rows are read once and cut to the records' own.
    files = inputs.files if inputs.files is not None else inputs.outbound.select("file_path", "missing_columns").distinct()
    ks = [f"_k{i}" for i in range(len(keys))]
    named = F.forall(F.array(*[text_norm(F.col(c), found.schema[c].dataType) for c in keys]), lambda x: x != "")
    written = materialize(outbound.relevant_rows(found.where(named), inputs.outbound, shape), "outbound-rows")
    canon = lambda df, names: [canon_id(text_norm(F.col(c), df.schema[c].dataType)).alias(k) for c, k in zip(names, ks)]
    by_run = outbound.rule_files(written, own_rules, bucket).select("rule_key", "run_id", *canon(written, theirs)).distinct()
    by_run = by_run.where(F.forall(F.array(*ks), lambda x: x != ""))
    skipped = F.coalesce(F.col("state") == "SKIPPED_TRIGGER", F.lit(False))
    search = F.concat_ws("/", "run_id", "rule_key", *[F.col(c).cast("string") for c in cols])
    recs = materialize(checks.select("*", *canon(checks, keys)).join(by_run, ["rule_key", *ks], "left").drop(*ks)
                       .join(runs.select("run_id", "state", "started_at"), "run_id", "left")
                       .withColumn("file_set", F.when(skipped, search).otherwise(F.col("run_id"))), "records")

    # The object search of records whose run has no log.
    theirs_of = dict(head.outbound_identity_map)
    value = canon_id(text_norm(F.col(head.outbound_search_field), recs.schema[head.outbound_search_field].dataType))
    held = inputs.outbound.select(F.lit(bucket).alias("bucket"), F.regexp_replace("file_path", r"^[a-z0-9]+://[^/]+/", "").alias("key"),
                                  canon_id(text_norm(F.col(theirs_of[head.outbound_search_field]))).alias("value"))
    targets = recs.where(skipped).join(own_rules.select("rule_key", "outbound_prefix"), "rule_key").select(
        F.col("file_set").alias("search_id"), F.lit(bucket).alias("target_bucket"), F.col("outbound_prefix").alias("prefix"),
        F.col("started_at").alias("since"), value.alias("must_contain"))
    objects = materialize(artifacts.search_objects(inv, targets, contents=held).select(
        F.col("search_id").alias("file_set"), F.col("bucket").alias("_fb"), F.col("key").alias("_fk"), F.col("size").alias("_fsize"),
        process_uuid(F.substring_index("key", "/", -1)).alias("_fpid")), "found-objects")

    own = arts.where(mine).select("rule_key", F.col("run_id").alias("file_set"), _path(F.col("bucket"), F.col("key")).alias("file_path")).unionByName(
        objects.join(recs.select("rule_key", "file_set"), "file_set").select("rule_key", "file_set", _path(F.col("_fb"), F.col("_fk")).alias("file_path")))
    content = outbound.match_outbound(recs.where("file_set IS NOT NULL").select("rule_key", *keys, "file_set"), written, shape, own_rules, bucket, value_mode,
                                      files=files, own=own)
    pids = pid.where(mine).select("process_id").unionByName(objects.select(F.col("_fpid").alias("process_id"))).where("process_id IS NOT NULL").distinct()
    after = inputs.state.get(head.entity_type, inputs.state.get(""))
    if after is None:
        raise ValueError(f"no state rows for entity {head.entity_type}")
    recon = logs.reconcile_counts(spark, runs, reported, counts, own_rules, shape, enforce=enforce_counts)

    j = (recs.withColumn("_skipped", skipped)
         .join(log_rows.select("run_id", "rule_key", F.col("verdict").alias("_lv"), F.col("reason").alias("_lr")), ["run_id", "rule_key"], "left")
         .join(recon.select("run_id", "rule_key", F.col("verdict").alias("_cv"), F.col("reason").alias("_cr")), ["run_id", "rule_key"], "left")
         .join(art_rows, ["run_id", "rule_key"], "left")
         .join(pid.select("run_id", "rule_key", F.col("process_id").alias("_lpid")), ["run_id", "rule_key"], "left")
         .join(objects, "file_set", "left")
         .withColumn("process_id", F.when(F.col("_skipped"), F.col("_fpid")).otherwise(F.col("_lpid"))))
    j = j.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in j.columns])
    missing = F.when(F.col("_fk").isNull(), F.lit("no object found by prefix search")).when(
        F.col("_fpid").isNull(), F.lit("no process UUID in the object name"))
    empty = F.coalesce("_fsize", F.lit(0)) == 0
    differs = (F.col("_lv") == "PASS") & (F.col("_cv") != "PASS")
    alone = F.col("_skipped")
    job_v, job_r = job_stage(F.col("state"))
    stages = [
        Stage("candidate", verdict=F.when(F.col("_ok"), "PASS").otherwise("FAIL"),
              reason=F.when(~F.col("_ok"), F.concat(F.lit("failed checks: "), F.col("_why")))),
        Stage("job", ["candidate"], verdict=job_v, reason=job_r),
        Stage("run_log", ["job"],
              verdict=F.when(alone, F.when(missing.isNull(), "PASS").otherwise("FAIL")).when(differs, F.col("_cv")).otherwise(F.col("_lv")),
              reason=F.when(alone, missing).when(differs, F.col("_cr")).otherwise(F.col("_lr"))),
        Stage("outbound_file", ["run_log"], verdict=F.when(alone, F.when(empty, "FAIL").otherwise("PASS")).otherwise(F.col("_av")),
              reason=F.when(alone, F.when(empty, F.concat(F.col("_fk"), F.lit(": 0 bytes")))).otherwise(F.col("_ar"))),
        Stage("outbound_content", ["outbound_file"], content, ["rule_key", *keys, "file_set"]),
        Stage("dataloader", ["outbound_content"], status.terminal_state(inputs.status, process_ids=pids), ["process_id"],
              absent=F.when(F.col("process_id").isNull(), F.lit("no process id for the run")).otherwise(F.lit("no status rows for the process"))),
        Stage("final_state", ["dataloader"], finalstate.final_state(spark, found, after, shape), ["rule_key", *head.final_key_columns]),
    ]
    return run_stages(j, stages).select("rule_key", *cols, "run_id", *STAGES, "first_failed_stage", "reason", "verdict")
