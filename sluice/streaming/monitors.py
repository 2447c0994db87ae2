"""Structured Streaming versions of the reference's poll-until-deadline loops
(SURVEY §2.8, STR-1..5).

Every monitor decides in *event time*: events wait, per key, until the
watermark has passed them, are then taken in event-time order, and the first
one that settles the key gives its verdict; a key that nothing settles fails
once the watermark has passed its first event by the deadline.  So the verdicts
do not depend on how the events were cut into micro-batches.  A decided key
leaves a small mark behind and never gets a second verdict.  State is kept per
key: the counters so far and the events still ahead of the watermark.
``run_available_now`` drives a plan to completion into a parquet folder under
``spark.checkpoint.dir`` (shared storage on a cluster, so a lost executor or a
restarted query resumes from its checkpoint).
"""

from __future__ import annotations

import datetime as dt
import json
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sluice.functions.exprs import file_name, normalise_prefix
from sluice.operators.artifacts import ancestors
from sluice.session import scratch_folder, ship_package

# ── fixed values: deadlines (seconds) and poll interval of the reference ──
OBJECT_DEADLINE = 900
LOADER_DEADLINE = 2400
LOG_DEADLINE = 600
POLL_SECONDS = 15


def _millis(ts: pd.Series) -> list[int]:
    """Event times as epoch milliseconds (vectorised)."""
    return (pd.to_datetime(ts).astype("datetime64[ns]").astype("int64") // 1_000_000).tolist()


def attempts_deadline(timeout_seconds: int, poll_seconds: int = POLL_SECONDS, share: int = 1) -> int:
    """Deadline arithmetic of the poll loops: max(3, timeout // poll // share)
    attempts, one poll apart."""
    attempts = max(3, timeout_seconds // max(poll_seconds, 1) // max(share, 1))
    return attempts * poll_seconds


def dedupe_events(events: DataFrame, ts_col: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """STR-5: a re-read status row arrives again; drop repeats of the same
    (keys) within the watermark, and events later than the watermark."""
    return events.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)


# ── the common machine ────────────────────────────────────────────────────
MACHINE_STATE = "first_ms long, memo string, ahead string, decided boolean"


def _machine(read: Callable[[pd.DataFrame], list], step: Callable[[dict, list], dict | None],
             expire: Callable[[dict], dict], names: list[str], deadline_s: int, merge: Callable[[list], list] | None = None):
    """State function of a monitor.

    ``read`` turns rows into events ``[time in ms, ...]`` that sort in order of
    time, then content; ``step`` takes one event into the memo and returns the
    verdict's columns if it settles the key; ``expire`` gives them at the deadline.
    """
    dl = deadline_s * 1000

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        warnings.filterwarnings("ignore", category=FutureWarning)
        first, memo, ahead, decided = state.get if state.exists else (None, "{}", "[]", False)
        if decided:
            return
        memo, ahead = json.loads(memo), json.loads(ahead)
        if not state.hasTimedOut:
            for pdf in pdfs:
                ahead += read(pdf)
        if merge:
            ahead = merge(ahead)
        ahead.sort(key=lambda e: [e[0], json.dumps(e[1:])])
        wm, out, at, used = state.getCurrentWatermarkMs(), None, None, 0
        for event in ahead:
            if event[0] > wm or (first is not None and event[0] > first + dl):
                break
            used += 1
            first = event[0] if first is None else first
            out = step(memo, event)
            if out:
                at = event[0]
                break
        if out is None and first is not None and first + dl <= wm:
            out, at = expire(memo), first + dl
        if out is not None:
            state.update((first, "{}", "[]", True))      # the mark that the key is decided
            yield pd.DataFrame([{**dict(zip(names, key)), **out, "decided_at": pd.Timestamp(at, unit="ms")}])
            return
        ahead = ahead[used:]
        state.update((first, json.dumps(memo), json.dumps(ahead), False))
        due = [e[0] for e in ahead[:1]] + ([first + dl] if first is not None else [])
        state.setTimeoutTimestamp(max(min(due) - 1, wm + 1))     # fires once the watermark reaches it

    return fn


# ── STR-3: process reaches a terminal state or the deadline ───────────────
TERMINAL_OUT = ("process_id string, verdict string, reason string, n_rows long, n_errors long, "
                "n_in_progress long, n_loader long, loader_done boolean, decided_at timestamp")
_FINAL = {"COMPLETED", "SUCCESS", "FAILED", "ERROR"}


TERMINAL_FIELDS = [c.split()[0] for c in TERMINAL_OUT.split(", ")]
COUNTS = ("n_rows", "n_errors", "n_in_progress", "n_loader", "n_done")
HELD = ("until", "first_ms", "timer", *COUNTS, "rows", "many_rows", "ahead", "many_ahead")
#: Rows, and events ahead, that a process keeps in its one value.
INLINE = 64
#: How long after its verdict a process id is known to be decided.
KEEP_MARKS_S = 90 * 86400


class TerminalProcessor(StatefulProcessor):
    """The process machine on keyed state: running counters, the newest status
    of each row, the events still ahead of the watermark, and a mark.

    Every call to the state store is a round trip, so a process keeps all it
    has in one value, read and written once per call; only rows and events
    beyond the first ``INLINE`` go to a map and a list of their own.  So an event costs
    the same however many rows its process has.  A timer fires when the watermark
    reaches the next event or the deadline, and another one drops the mark of a
    decided process."""

    def __init__(self, loader: str, deadline_s: int, keep_s: int) -> None:
        self.loader, self.deadline, self.keep = loader, deadline_s * 1000, keep_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # ``until``: set once decided; ``many_rows``, ``many_ahead``: whether the map and the list hold anything.
        self.held = handle.getValueState("held", "until long, first_ms long, timer long, " + ", ".join(f"{c} long" for c in COUNTS)
                                         + ", rows string, many_rows boolean, ahead string, many_ahead boolean")
        self.rows = handle.getMapState("rows", "id string", "status string, loads boolean")
        self.ahead = handle.getListState("ahead", "ms long, id string, loads boolean, status string")

    def _read(self) -> dict:
        found = self.held.get()
        held = dict(zip(HELD, found or (None, None, None, *[0] * len(COUNTS), "{}", False, "[]", False)))
        return held | {"rows": json.loads(held["rows"]), "ahead": json.loads(held["ahead"])}

    def _write(self, held: dict) -> None:
        self.held.update(tuple((held | {"rows": json.dumps(held["rows"]), "ahead": json.dumps(held["ahead"])}).values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._read()
        if held["until"] is not None:
            if held["until"] > timerValues.getCurrentWatermarkInMs():
                return
            held["until"] = None
        new = [(int(r["ms"]), str(r["id"]).zfill(20), r["sub_process_name"] == self.loader, (r["status"] or "").strip().upper()) for r in rows]
        if not new:
            return
        if len(held["ahead"]) + len(new) <= INLINE:
            held["ahead"] += new
        else:
            self.ahead.appendList(new)
            held["many_ahead"] = True
        self._wake(held, min(e[0] for e in new))
        self._write(held)
        yield from ()

    def _wake(self, held: dict, due: int) -> None:
        """A timer for ``due``, unless an earlier one is set."""
        if held["timer"] is None or due < held["timer"]:
            if held["timer"] is not None:
                self.handle.deleteTimer(held["timer"] - 1)
            held["timer"] = due
            self.handle.registerTimer(due - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = self._read()
        if held["until"] is not None:
            if held["until"] <= now:
                self.held.clear()
            return
        waiting = sorted([*map(tuple, held["ahead"]), *(tuple(e) for e in (self.ahead.get() if held["many_ahead"] else ()))])
        first, out, used, changed = held["first_ms"], None, 0, {}
        for ms, rid, loads, status in waiting:
            if ms > now or (first is not None and ms > first + self.deadline):
                break
            used += 1
            first = ms if first is None else first
            self._count(held, changed, rid, loads, status)
            if held["n_errors"]:
                out = ("FAIL", "status rows report errors", ms)
            elif held["n_done"] and not held["n_in_progress"]:
                out = ("PASS", None, ms)
            if out:
                break
        if out is None and first is not None and first + self.deadline <= now:
            out = ("FAIL", "still IN-PROGRESS" if held["n_in_progress"] else f"no {self.loader} row" if not held["n_loader"] else "loader did not complete",
                   first + self.deadline)
        if out is None:
            self._keep(held, changed, waiting[used:])
            held["first_ms"], held["timer"] = first, None
            due = [e[0] for e in waiting[used: used + 1]] + ([first + self.deadline] if first is not None else [])
            self._wake(held, max(min(due), now + 1))
            self._write(held)
            return
        if held["many_rows"]:
            self.rows.clear()
        if held["many_ahead"]:
            self.ahead.clear()
        until = max(out[2], now) + self.keep
        self.held.update((until, None, None, *[0] * len(COUNTS), "{}", False, "[]", False))
        self.handle.registerTimer(until)
        yield Row(*TERMINAL_FIELDS)(key[0], out[0], out[1], held["n_rows"], held["n_errors"], held["n_in_progress"], held["n_loader"], held["n_done"] > 0,
                                    dt.datetime.fromtimestamp(out[2] / 1000, dt.timezone.utc))

    def _count(self, held: dict, changed: dict, rid: str, loads: bool, status: str) -> None:
        """Take a row's newest status into the counters; a final row read again changes nothing."""
        before = changed.get(rid) or held["rows"].get(rid)
        if before is None and held["many_rows"] and self.rows.containsKey((rid,)):
            before = self.rows.getValue((rid,))
        if before is not None and before[0] in _FINAL:
            return
        for entry, by in ((before, -1), ((status, loads), 1)):
            if entry is not None:
                held["n_rows"] += by
                held["n_errors"] += by * (entry[0] in ("FAILED", "ERROR"))
                held["n_in_progress"] += by * (entry[0] == "IN-PROGRESS")
                held["n_loader"] += by * bool(entry[1])
                held["n_done"] += by * (bool(entry[1]) and entry[0] in ("COMPLETED", "SUCCESS"))
        changed[rid] = (status, loads)

    def _keep(self, held: dict, changed: dict, waiting: list) -> None:
        """The rows and events of a process that stays open: the first in its value, the others in the map and the list."""
        for rid, entry in changed.items():
            if rid in held["rows"] or len(held["rows"]) < INLINE and not held["many_rows"]:
                held["rows"][rid] = entry
            else:
                self.rows.updateValue((rid,), entry)
                held["many_rows"] = True
        if len(waiting) > INLINE:
            self.ahead.put(waiting)
            held["ahead"], held["many_ahead"] = [], True
            return
        if held["many_ahead"]:
            self.ahead.clear()
        held["ahead"], held["many_ahead"] = waiting, False

    def close(self) -> None:
        pass


def terminal_monitor(status_events: DataFrame, deadline_s: int = LOADER_DEADLINE, loader: str = "Data-Loader-File",
                     delay: str = "10 minutes", keep_s: int = KEEP_MARKS_S) -> DataFrame:
    """STR-3 (+STR-5): one verdict per process — PASS at the event that leaves
    the loader completed with nothing running and no errors, FAIL at the first
    error, and FAIL with the batch reason when the deadline passes first.

    ``status_events``: (id, process_id, sub_process_name, status, event_time);
    an id may come again with a later status.  A process id must not come back
    later than ``keep_s`` after its verdict.  Needs the RocksDB state store, which
    ``run_available_now`` sets."""
    ship_package(status_events.sparkSession)
    ev = dedupe_events(status_events.select("id", "process_id", "sub_process_name", "status", "event_time"),
                       "event_time", ["id", "status", "event_time"], delay)
    return ev.withColumn("ms", F.unix_millis("event_time")).groupBy("process_id").transformWithState(
        TerminalProcessor(loader, deadline_s, keep_s), TERMINAL_OUT, "Append", "EventTime")


# ── STR-4: a flag flips to an expected value or the deadline ─────────────
FLAG_OUT = "record_key string, verdict string, last_value string, decided_at timestamp"


def _flag_fn(expected: set[str], deadline_s: int):
    def read(pdf: pd.DataFrame) -> list:
        return [[ms, (v or "").strip().upper()] for ms, v in zip(_millis(pdf["event_time"]), pdf["value"])]

    def step(memo: dict, event: list) -> dict | None:
        memo["last"] = event[1]
        return {"verdict": "PASS", "last_value": event[1]} if event[1] in expected else None

    return _machine(read, step, lambda memo: {"verdict": "FAIL", "last_value": memo.get("last") or "NULL"}, ["record_key"], deadline_s)


def flag_monitor(changes: DataFrame, expected_values, deadline_s: int = LOADER_DEADLINE,
                 delay: str = "10 minutes") -> DataFrame:
    """STR-4: ``changes`` (record_key, value, event_time); PASS at the first
    value (strip, upper) that is expected, FAIL at the deadline otherwise."""
    ship_package(changes.sparkSession)
    exp = {str(v).strip().upper() for v in expected_values}
    ev = changes.select(F.col("record_key").cast("string"), F.col("value").cast("string"), "event_time")
    ev = ev.withWatermark("event_time", delay)
    return ev.groupBy("record_key").applyInPandasWithState(
        _flag_fn(exp, deadline_s), FLAG_OUT, MACHINE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# ── STR-2: the run log completes (sentinel) or the deadline ───────────────
LOG_OUT = "run_id string, source string, verdict string, n_lines long, reason string, decided_at timestamp"


def _log_fn(deadline_s: int):
    def read(pdf: pd.DataFrame) -> list:
        # lines of one time are one event: how many, and whether the sentinel is among them
        g = pd.DataFrame({"ms": _millis(pdf["event_time"]), "s": pdf["is_sentinel"].fillna(False).astype(bool).to_numpy()}).groupby("ms")["s"].agg(["size", "any"])
        return [[int(ms), int(n), bool(hit)] for ms, n, hit in zip(g.index, g["size"], g["any"])]

    def step(memo: dict, event: list) -> dict | None:
        memo["n"] = memo.get("n", 0) + event[1]
        return {"verdict": "COMPLETE", "n_lines": memo["n"], "reason": None} if event[2] else None

    def expire(memo: dict) -> dict:
        n = memo.get("n", 0)
        return {"verdict": "FAIL", "n_lines": n, "reason": f"{n} event(s), none of them the completion line"}

    def merge(ahead: list) -> list:
        """Events of one time are one, however many batches they came in."""
        out: dict[int, list] = {}
        for ms, n, hit in ahead:
            e = out.setdefault(ms, [ms, 0, False])
            e[1] += n
            e[2] = e[2] or hit
        return list(out.values())

    return _machine(read, step, expire, ["run_id", "source"], deadline_s, merge)


def log_completion_monitor(lines: DataFrame, sentinel: str, deadline_s: int = LOG_DEADLINE,
                           delay: str = "10 minutes") -> DataFrame:
    """STR-2: per (run, source), COMPLETE with the lines up to the time of the
    first sentinel line, FAIL with the event count at the deadline."""
    ship_package(lines.sparkSession)
    ev = lines.select("run_id", "source", "event_time", F.col("message").rlike(sentinel).alias("is_sentinel"))
    ev = ev.withWatermark("event_time", delay)
    return ev.groupBy("run_id", "source").applyInPandasWithState(
        _log_fn(deadline_s), LOG_OUT, MACHINE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


# ── STR-1: objects arriving under a prefix after a start time ─────────────
def object_monitor(objects: DataFrame, searches: DataFrame, deadline_s: int = OBJECT_DEADLINE, pattern: str = r".*\.csv$",
                   delay: str = "10 minutes") -> DataFrame:
    """One verdict per search, from the stream itself: FOUND with the first
    object under its prefix within the deadline after ``since``, MISSING when the
    watermark passes the deadline without one.

    ``objects`` (bucket, key, last_modified) and ``searches`` (search_id,
    target_bucket, prefix, since) are streams that meet in an outer interval join;
    its state holds an object no longer than the deadline.  The watermark is the
    slower stream's: searches that come seldom need a heartbeat (a row with the
    time as ``since`` and no ``search_id``)."""
    o = (objects.where(file_name(F.col("key")).rlike(pattern)).withWatermark("last_modified", delay)
         .select("bucket", "key", "last_modified", F.explode(ancestors(F.col("key"))).alias("_dir")))
    s = searches.select("search_id", "target_bucket", normalise_prefix(F.col("prefix")).alias("prefix"), "since").withWatermark("since", delay)
    within = (F.col("last_modified") >= F.col("since")) & (F.col("last_modified") <= F.expr(f"since + INTERVAL {int(deadline_s)} SECONDS"))
    met = s.join(o, (s["target_bucket"] == o["bucket"]) & (s["prefix"] == o["_dir"]) & within, "leftOuter")
    found = F.when(F.col("key").isNotNull(), F.struct((F.col("last_modified") + F.make_dt_interval(secs=F.lit(0))).alias("at"), "key"))
    first = met.select("search_id", "since", found.alias("o")).groupBy("search_id", "since").agg(F.min("o").alias("o"), F.max("search_id").alias("_asked"))
    # Heartbeats leave only here: a filter on the id itself would be pushed below the watermark.
    return first.where(F.col("_asked").isNotNull()).select(
        "search_id", "o.key", F.col("o.at").alias("last_modified"), F.when(F.col("o").isNull(), "MISSING").otherwise("FOUND").alias("verdict"))


# ── driving a plan to completion ──────────────────────────────────────────
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available_now(spark: SparkSession, plan: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming plan over everything available, into parquet under the
    shared checkpoint folder, and return the written rows as a batch table."""
    root = scratch_folder(spark, f"stream-{name}")
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)        # read when the query starts
    try:
        q = (plan.writeStream.format("parquet").outputMode(output_mode)
             .option("checkpointLocation", root + "/_checkpoint").option("path", root + "/data")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(setting, before)
    if q.exception():
        raise q.exception()
    return spark.read.schema(plan.schema).parquet(root + "/data")
