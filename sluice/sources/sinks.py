"""SNK-1: result tables.

Results stay DataFrames; writing partitions them by the keys reports are read
by (rule, run).  ``raise_if_failed`` is the thin driver action of AGG-13: it
brings back only a count and a bounded sample of failing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import path_exists


class ValidationFailed(AssertionError):
    pass


def write_results(df: DataFrame, path: str, partition_by=("rule_key",), mode: str = "overwrite",
                  fmt: str = "parquet") -> None:
    """Write a result table.  Overwriting replaces only the partitions (rules,
    runs) that ``df`` holds: a run that is repeated replaces its rows, the others stay."""
    cols = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode).format(fmt)
    if cols:
        w = w.partitionBy(*cols)
        if path_exists(df.sparkSession, path):
            w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def stream_results(plan: DataFrame, path: str, checkpoint: str, partition_by=(), output_mode: str = "append"):
    """Start writing a stream's results below ``path``, one partition ``batch``
    for each micro-batch; a micro-batch that is run again replaces its own."""
    def write(df: DataFrame, batch: int) -> None:
        write_results(df.withColumn("batch", F.lit(batch)), path, ("batch", *partition_by))

    return plan.writeStream.foreachBatch(write).outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def raise_if_failed(verdicts: DataFrame, verdict_col: str = "verdict", sample: int = 5) -> None:
    """Raise when any row FAILed; the message lists the count and a sample."""
    failed = verdicts.where(F.col(verdict_col) == "FAIL")
    n = failed.count()
    if n:
        rows = [r.asDict() for r in failed.limit(sample).collect()]
        raise ValidationFailed(f"{n} check(s) FAILED, e.g. {rows}")
