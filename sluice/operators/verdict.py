"""Parts of the scenario's verdicts (RULE-5/6, SNK-1); ``scenario`` folds the
stages: one is evaluated only if those it waits for are PASS or WARN, else it is SKIPPED.
"""

from __future__ import annotations

from pyspark.sql import functions as F

# ── fixed values: the scenario stages, in order ───────────────────────────
STAGES = ("candidate", "job", "run_log", "outbound_file", "outbound_content", "dataloader", "final_state")
OK = ("PASS", "WARN")


def worst(verdict_col: str) -> F.Column:
    """Aggregate for per-stage rows: FAIL over WARN over PASS."""
    v = F.col(verdict_col)
    return (F.when(F.max(F.when(v == "FAIL", 1)) == 1, "FAIL")
            .when(F.max(F.when(v == "WARN", 1)) == 1, "WARN").otherwise("PASS"))


def job_stage(state: F.Column) -> tuple[F.Column, F.Column]:
    """RULE-6: a succeeded run passes; a run whose trigger was skipped passes
    into the fallback (object search); anything else fails."""
    verdict = F.when(state.isin("SUCCEEDED", "SKIPPED_TRIGGER"), "PASS").otherwise("FAIL")
    reason = (F.when(state.isNull(), F.lit("no run wrote the record"))
              .when(~state.isin("SUCCEEDED", "SKIPPED_TRIGGER"), F.concat(F.lit("job state "), state)))
    return verdict, reason
