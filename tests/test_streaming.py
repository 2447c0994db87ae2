"""Streaming monitors against the batch operators on small literal streams
(file source of parquet written to a scratch folder, availableNow)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sluice.operators import status as S
from sluice.streaming import monitors as M

from conftest import rows

T = dt.datetime


def stream_of(spark, df, folder):
    df.write.mode("overwrite").parquet(folder)
    return spark.readStream.schema(df.schema).parquet(folder)


def test_attempts_deadline():
    assert M.attempts_deadline(2400, 15) == 2400
    assert M.attempts_deadline(10, 15) == 45
    assert M.attempts_deadline(2400, 15, share=4) == 600


def test_terminal_monitor_matches_batch_verdicts(spark, scratch):
    ev = spark.createDataFrame([
        (1, "a", "Data-Loader-File", "Completed", T(2024, 1, 1, 0, 0)),
        (1, "a", "Data-Loader-File", "Completed", T(2024, 1, 1, 0, 1)),    # re-read duplicate
        (2, "b", "Data-Loader-File", "In-Progress", T(2024, 1, 1, 0, 0)),
        (3, "c", "File-Record", "FAILED", T(2024, 1, 1, 0, 0)),
        (4, "c", "Data-Loader-File", "SUCCESS", T(2024, 1, 1, 0, 0)),
        (5, "d", "File-Record", "Completed", T(2024, 1, 1, 0, 0)),
        (6, "e", "Data-Loader-File", "Queued", T(2024, 1, 1, 0, 0)),
        (7, "z", "File-Record", "Completed", T(2024, 1, 3, 0, 0)),          # advances the clock
    ], "id long, process_id string, sub_process_name string, status string, event_time timestamp")
    src = stream_of(spark, ev, os.path.join(scratch, "status"))
    out = M.run_available_now(spark, M.terminal_monitor(src, deadline_s=3600, delay="1 minute"), "t")
    got = {r["process_id"]: (r["verdict"], r["reason"]) for r in out.collect()}
    batch_rows = ev.dropDuplicates(["id", "status"]).withColumn("payload_response_id", F.lit(None).cast("string"))
    batch = {r["process_id"]: (r["verdict"], r["reason"]) for r in S.terminal_state(batch_rows).collect()}
    for pid in "abcde":
        assert got[pid] == batch[pid], pid
    assert "z" not in got          # its deadline has not passed on the event-time clock


def test_flag_and_log_monitors(spark, scratch):
    changes = spark.createDataFrame([
        ("L1", "Y", T(2024, 1, 1, 0, 0)), ("L1", " n ", T(2024, 1, 1, 0, 10)),
        ("L2", "Y", T(2024, 1, 1, 0, 0)), ("L2", "N", T(2024, 1, 1, 5, 0)),   # flips after the deadline
        ("L9", "Y", T(2024, 1, 2, 0, 0))],
        "record_key string, value string, event_time timestamp")
    out = M.run_available_now(spark, M.flag_monitor(stream_of(spark, changes, os.path.join(scratch, "flags")),
                                                     ("N",), deadline_s=3600, delay="1 minute"), "f")
    assert rows(out, "record_key", "verdict", "last_value") == [("L1", "PASS", "N"), ("L2", "FAIL", "Y")]

    lines = spark.createDataFrame([
        ("r1", "api", "INFO a", T(2024, 1, 1, 0, 0)), ("r1", "api", "Chunk 1 written to s3://b/k", T(2024, 1, 1, 0, 5)),
        ("r2", "api", "INFO a", T(2024, 1, 1, 0, 0)), ("r2", "api", "INFO b", T(2024, 1, 1, 0, 1)),
        ("r9", "api", "INFO late", T(2024, 1, 2, 0, 0))],
        "run_id string, source string, message string, event_time timestamp")
    out = M.run_available_now(spark, M.log_completion_monitor(
        stream_of(spark, lines, os.path.join(scratch, "lines")), r"Chunk\s+\d+\s+written\s+to\s+s3://",
        deadline_s=600, delay="1 minute"), "l")
    assert rows(out, "run_id", "verdict", "n_lines") == [("r1", "COMPLETE", 2), ("r2", "FAIL", 2)]


def _batches(spark, df, folder, cuts):
    """The rows of ``df`` in event-time order, as a stream of ``cuts`` micro-batches."""
    rows_ = sorted(df.collect(), key=lambda r: r["event_time"])
    size = -(-len(rows_) // cuts)
    for k in range(cuts):
        part = rows_[k * size: (k + 1) * size]
        if part:
            spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(folder)
            import time
            time.sleep(0.02)       # the file source takes files in order of their time
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1 if cuts > 1 else 1000).parquet(folder)


def test_verdicts_do_not_depend_on_micro_batches(spark, scratch):
    m = lambda k: T(2024, 1, 1) + dt.timedelta(minutes=k)
    flags = spark.createDataFrame([("A", "Y", m(0)), ("A", "N", m(1)), ("A", "Y", m(2)), ("B", "Y", m(0)), ("B", "N", m(90)),
                                   ("C", "N", m(5)), ("C", "N", m(300)), ("Z", "Y", m(900))],
                                  "record_key string, value string, event_time timestamp")
    status = spark.createDataFrame([
        (1, "p", "Data-Loader-File", "Completed", m(0)), (2, "p", "File-Record", "FAILED", m(4)),       # settled before the failure
        (3, "q", "File-Record", "In-Progress", m(0)), (4, "q", "Data-Loader-File", "Completed", m(1)), (3, "q", "File-Record", "Completed", m(9)),
        (5, "r", "File-Record", "Completed", m(0)), (6, "r", "Data-Loader-File", "Completed", m(200)),   # after the deadline
        (9, "z", "File-Record", "Completed", m(900))],
        "id long, process_id string, sub_process_name string, status string, event_time timestamp")
    lines = spark.createDataFrame([
        ("r1", "api", "a", m(0)), ("r1", "api", "DONE", m(3)), ("r1", "api", "b", m(3)), ("r1", "api", "c", m(4)),
        ("r2", "api", "a", m(0)), ("r2", "api", "DONE", m(30)), ("r9", "api", "a", m(900))],
        "run_id string, source string, message string, event_time timestamp")
    seen = []
    for cuts in (1, 3, 8):
        f = M.run_available_now(spark, M.flag_monitor(_batches(spark, flags, os.path.join(scratch, f"f{cuts}"), cuts), ("N",), 3600, "1 minute"), "f")
        s = M.run_available_now(spark, M.terminal_monitor(_batches(spark, status, os.path.join(scratch, f"s{cuts}"), cuts), 3600, delay="1 minute"), "s")
        g = M.run_available_now(spark, M.log_completion_monitor(_batches(spark, lines, os.path.join(scratch, f"l{cuts}"), cuts), "DONE", 600, "1 minute"), "l")
        seen.append((rows(f), rows(s), rows(g)))
    assert seen[0] == seen[1] == seen[2]
    f, s, g = seen[0]
    assert [r[:3] for r in f] == [("A", "PASS", "N"), ("B", "FAIL", "Y"), ("C", "PASS", "N")]
    assert [r[:3] for r in s] == [("p", "PASS", None), ("q", "PASS", None), ("r", "FAIL", "no Data-Loader-File row")]
    assert [(r[0], r[2], r[3]) for r in g] == [("r1", "COMPLETE", 3), ("r2", "FAIL", 1)]


def test_object_deadline_is_an_outcome_of_the_stream(spark, scratch):
    m = lambda k: T(2024, 1, 1) + dt.timedelta(minutes=k)
    inv = spark.createDataFrame([("b", "out/p/early.csv", m(0)), ("b", "out/p/a.csv", m(10)), ("b", "/out/p/b.csv", m(11)), ("b", "out/p/sub/c.csv", m(12)),
                                 ("b", "out/q/late.csv", m(60)), ("b", "out/q/x.tmp", m(21)), ("other", "out/q/y.csv", m(21)), ("b", "zz/clock.csv", m(500))],
                                "bucket string, key string, event_time timestamp")
    asked = spark.createDataFrame([("s1", "b", "out/p/", m(5)), ("s2", "b", "/out", m(5)), ("s3", "b", "out/q/", m(20)), ("s4", "b", "none/", m(6)),
                                   ("s5", "b", "out/p/", m(490)), (None, "", "", m(500))],
                                  "search_id string, target_bucket string, prefix string, event_time timestamp")
    seen = []
    for cuts in (1, 3, 8):
        objects = _batches(spark, inv, os.path.join(scratch, f"i{cuts}"), cuts).withColumnRenamed("event_time", "last_modified")
        searches = _batches(spark, asked, os.path.join(scratch, f"q{cuts}"), cuts).withColumnRenamed("event_time", "since")
        seen.append(rows(M.run_available_now(spark, M.object_monitor(objects, searches, 900, delay="1 minute"), "o"), "search_id", "key", "verdict"))
    assert seen[0] == seen[1] == seen[2] == [("s1", "out/p/a.csv", "FOUND"), ("s2", "out/p/a.csv", "FOUND"), ("s3", None, "MISSING"), ("s4", None, "MISSING")]


def test_marks_of_decided_processes_expire(spark, scratch):
    m = lambda k: T(2024, 1, 1) + dt.timedelta(minutes=k)
    status = spark.createDataFrame([
        (1, "p", "Data-Loader-File", "Completed", m(0)), (2, "p", "File-Record", "FAILED", m(30)), (3, "x", "File-Record", "Completed", m(100)),
        (4, "x", "File-Record", "Completed", m(300)), (5, "p", "File-Record", "FAILED", m(400)), (6, "z", "File-Record", "Completed", m(900))],
        "id long, process_id string, sub_process_name string, status string, event_time timestamp")
    src = _batches(spark, status, os.path.join(scratch, "marks"), 6)
    got = M.run_available_now(spark, M.terminal_monitor(src, 3600, delay="1 minute", keep_s=7200), "m")
    assert sorted((r["decided_at"], r["verdict"]) for r in got.where("process_id = 'p'").collect())[0][1] == "PASS" and got.where("process_id = 'p'").count() == 2


class _Store:
    """A state handle in memory that counts the calls made to it."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, set()

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            return getattr(self, "do_" + name)(*args)

        return call

    def getValueState(self, name, schema):
        return _State(self, name)

    getMapState = getListState = lambda self, name, *schemas: _State(self, name)
    do_registerTimer = lambda self, at: self.timers.add(at)
    do_deleteTimer = lambda self, at: self.timers.discard(at)


class _State:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def __getattr__(self, call):
        held, name = self.store.values, self.name
        self.store.calls += 1
        return {
            "exists": lambda: name in held, "get": lambda: held.get(name, () if name == "ahead" else None), "clear": lambda: held.pop(name, None) and None,
            "update": lambda v: held.update({name: v}), "put": lambda v: held.update({name: list(v)}),
            "appendList": lambda v: held.update({name: [*held.get(name, []), *v]}), "containsKey": lambda k: k in held.get(name, {}),
            "getValue": lambda k: held.get(name, {}).get(k), "updateValue": lambda k, v: held.setdefault(name, {}).update({k: v})}[call]


class _Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def _fire(p, store, now):
    out = []
    while due := [t for t in store.timers if t < now]:
        out += [tuple(r) for r in p.handleExpiredTimer(("p",), _Clock(now), None)]
        store.timers -= set(due[:1])
    return out


def _status_row(k, sub, status, minute):
    return {"id": k, "sub_process_name": sub, "status": status, "ms": minute * 60_000}


def test_a_process_settled_at_once_costs_few_state_calls():
    store = _Store()
    p = M.TerminalProcessor("Data-Loader-File", 3600, 86400)
    p.init(store)
    store.calls = 0
    assert list(p.handleInputRows(("p",), iter([_status_row(k, "File-Record", "Completed", k) for k in range(3)]
                                               + [_status_row(3, "Data-Loader-File", "Completed", 3)]), _Clock(0))) == []
    assert [r[:4] for r in _fire(p, store, 10 * 60_000)] == [("p", "PASS", None, 4)]
    assert store.calls <= 6       # value read and written twice, a timer for the events and one for the mark
    store.calls = 0
    list(p.handleInputRows(("p",), iter([_status_row(9, "File-Record", "FAILED", 11)]), _Clock(10 * 60_000)))
    assert store.calls == 1 and _fire(p, store, 20 * 60_000) == []


def test_rows_and_events_beyond_the_inline_ones():
    n = 3 * M.INLINE
    got = []
    for cuts in (1, 2, n):
        store = _Store()
        p = M.TerminalProcessor("Data-Loader-File", 10 ** 6, 86400)
        p.init(store)
        # every row runs, then all end but for the last one, whose end comes with the loader's
        events = [_status_row(k, "File-Record", "In-Progress", k) for k in range(n)] + [_status_row(k, "File-Record", "Completed", n + k) for k in range(n)]
        events.append(_status_row(n, "Data-Loader-File", "Success", 2 * n))
        size, out = -(-len(events) // cuts), []
        for a in range(0, len(events), size):
            part = events[a: a + size]
            list(p.handleInputRows(("p",), iter(part), _Clock(max(a - 1, 0) * 60_000)))
            # the watermark stays behind the last events, so some are ahead of it
            out += _fire(p, store, part[len(part) // 2]["ms"])
        out += _fire(p, store, 10 * n * 60_000)
        got.append(out)
    assert got[0] == got[1] == got[2] and [r[:8] for r in got[0]] == [("p", "PASS", None, n + 1, 0, 0, 1, True)]
