"""FLT-10: incremental runs.

A run keeps its totals as mergeable aggregates in a stored table, together
with the watermark up to which rows were taken.  The next run reads only the
rows after the watermark, adds their partial aggregates to the stored
ones and writes the next version; a run that is lost half-way leaves the last
whole version in force.  So full = delta + delta, whatever the cuts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.logs import FULL_SCAN_YEAR, incremental
from sluice.session import path_exists

START = "0001-01-01 00:00:00"


def merged(parts: DataFrame, keys: list[str], how: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Partial aggregates of equal keys combined column by column."""
    return parts.groupBy(*keys).agg(*(f(F.col(c)).alias(c) for c, f in how.items()))


class Totals:
    """A versioned table of mergeable aggregates below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], how: dict[str, Callable[[Column], Column]]) -> None:
        self.spark, self.folder, self.keys, self.how = spark, folder.rstrip("/"), keys, how

    def _versions(self) -> DataFrame | None:
        """(version, watermark) of the versions that were written whole."""
        log = f"{self.folder}/log"
        return self.spark.read.schema("version long, watermark string").json(log) if path_exists(self.spark, log) else None

    def state(self) -> tuple[int, str, DataFrame | None]:
        """(version, watermark, totals) of the last whole version."""
        log = self._versions()
        last = log.orderBy(F.desc("version")).first() if log is not None else None
        if last is None:
            return 0, START, None
        return last["version"], last["watermark"], self.spark.read.parquet(f"{self.folder}/v{last['version']}")

    def advance(self, rows: DataFrame, ts_col: str, partial: Callable[[DataFrame], DataFrame], until: dt.datetime | str) -> DataFrame:
        """Take the rows after the watermark and up to ``until`` into the totals; a run that repeats one changes nothing.

        A watermark in year 9999 is a full scan: the totals are made anew of all rows."""
        version, mark, before = self.state()
        full = str(until).startswith(str(FULL_SCAN_YEAR))
        if not full and str(until) <= mark and before is not None:
            return before
        new = rows if full else incremental(rows, ts_col, mark).where(F.col(ts_col) <= F.to_timestamp(F.lit(str(until))))
        parts = partial(new)
        if before is not None and not full:
            parts = before.unionByName(parts)
        version += 1
        merged(parts, self.keys, self.how).write.mode("overwrite").parquet(f"{self.folder}/v{version}")
        mark = rows.agg(F.max(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS"))).first()[0] if full else str(until)
        # The version counts from here on.
        self.spark.createDataFrame([(version, mark or START)], "version long, watermark string").coalesce(1).write.mode("append").json(f"{self.folder}/log")
        return self.spark.read.parquet(f"{self.folder}/v{version}")


def split_counters(spark: SparkSession, folder: str) -> Totals:
    """Totals for ``status.split_results``: ``advance(rows, ts, status.process_counters, until)``."""
    counts = ("total_sub_processes", "completed", "errored", "stuck")
    return Totals(spark, folder, ["process_id"], {c: (lambda x: F.sum(x).cast("long")) for c in counts})


def distinct_ids(spark: SparkSession, folder: str, column: str = "id") -> Totals:
    """Exact distinct values with the number of rows of each: ``count()`` of the table is the distinct count."""
    return Totals(spark, folder, [column], {"n": lambda x: F.sum(x).cast("long")})


def log_facts_totals(spark: SparkSession, folder: str) -> Totals:
    """Totals of ``logs.log_facts`` rows, kept with the place of each first and last value."""
    return Totals(spark, folder, ["run_id", "source", "kind", "a", "b"],
                  {"n": lambda x: F.sum(x).cast("long"), "first": F.min, "last": F.max})


def log_facts_partial(facts: DataFrame) -> DataFrame:
    """``logs.log_facts`` rows in the form that merges: values beside their places."""
    return facts.select("run_id", "source", "kind", "a", "b", "n", F.struct("position", F.col("first_value").alias("value")).alias("first"),
                        F.when(F.col("value_line").isNotNull(), F.struct(F.col("value_line").alias("line"), F.col("last_value").alias("value"))).alias("last"))


def log_facts_merged(totals: DataFrame) -> DataFrame:
    """The totals as ``logs.log_facts`` gives them."""
    return totals.select("run_id", "source", "kind", "a", "b", "n", F.col("first.position").alias("position"), F.col("first.value").alias("first_value"),
                         F.col("last.value").alias("last_value"), F.col("last.line").alias("value_line"))

