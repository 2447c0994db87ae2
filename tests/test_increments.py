"""Incremental runs, result tables, nested prefixes and status lists."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sluice.operators import increments as I
from sluice.operators import logs as L
from sluice.operators import status as S
from sluice.sources import sinks

from conftest import rows

T = dt.datetime


def _status(spark):
    rng = random.Random(7)
    data = [(f"p{rng.randint(0, 9)}", rng.choice(["Completed", "failed ", None, "In-Progress", "ERROR"]), T(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 500)))
            for _ in range(300)]
    return spark.createDataFrame(data, "process_id string, status string, updated_at timestamp")


def test_full_equals_the_sum_of_deltas(spark, scratch):
    status = _status(spark)
    want = rows(S.process_counters(status))
    totals = I.split_counters(spark, f"{scratch}/a")
    for minute in (100, 100, 333, 250, 600):          # a run repeated, and one whose time has passed, add nothing
        got = totals.advance(status, "updated_at", S.process_counters, T(2024, 1, 1) + dt.timedelta(minutes=minute))
    assert rows(got, *S.process_counters(status).columns) == want
    again = I.split_counters(spark, f"{scratch}/b")
    again.advance(status.limit(5), "updated_at", S.process_counters, "2024-01-01 01:00:00")
    assert rows(again.advance(status, "updated_at", S.process_counters, "9999-12-31 00:00:00"), *S.process_counters(status).columns) == want


def test_a_lost_run_leaves_the_last_version(spark, scratch):
    status = _status(spark)
    totals = I.split_counters(spark, scratch)
    totals.advance(status, "updated_at", S.process_counters, "2024-01-01 03:00:00")
    before = totals.state()
    spark.range(3).write.parquet(f"{scratch}/v2")           # written, but never logged
    assert totals.state()[:2] == before[:2]
    got = totals.advance(status, "updated_at", S.process_counters, "2024-01-02 00:00:00")
    assert rows(got, *S.process_counters(status).columns) == rows(S.process_counters(status))


def test_distinct_ids_and_log_facts_merge(spark, scratch):
    lines = [("r1", "api", k, f"AppliedRule=15 rule_count={k}" if k % 3 else "AppliedRule=15", T(2024, 1, 1, 0, k)) for k in range(20)]
    lines += [("r1", "api", 30 + k, f"Chunk {k} written to s3://b/out/f{k % 2}.csv", T(2024, 1, 1, 0, 20 + k)) for k in range(6)]
    caps = spark.createDataFrame(lines, "run_id string, source string, line_no long, message string, at timestamp")
    facts, ids = I.log_facts_totals(spark, f"{scratch}/f"), I.distinct_ids(spark, f"{scratch}/d")
    for until in ("2024-01-01 00:07:00", "2024-01-01 00:22:00", "2024-01-01 01:00:00"):
        f = facts.advance(caps, "at", lambda d: I.log_facts_partial(L.log_facts(d)), until)
        d = ids.advance(caps.withColumn("id", F.col("line_no") % 7), "at", lambda x: x.groupBy("id").agg(F.count(F.lit(1)).alias("n")), until)
    whole = L.log_facts(caps)
    assert rows(I.log_facts_merged(f), *whole.columns) == rows(whole)
    assert d.count() == 7 and d.agg(F.sum("n")).first()[0] == 26


def test_result_partitions_are_replaced(spark, scratch):
    first = spark.createDataFrame([("k1", "r1", 1), ("k1", "r2", 2), ("k2", "r1", 3)], "rule_key string, run_id string, n int")
    for part in (first, first.where("run_id = 'r1'").withColumn("n", F.col("n") * 10)):
        sinks.write_results(part, f"{scratch}/out", ("rule_key", "run_id"))
    assert rows(spark.read.parquet(f"{scratch}/out"), "rule_key", "run_id", "n") == [("k1", "r1", 10), ("k1", "r2", 2), ("k2", "r1", 30)]


def test_stream_results_by_batch(spark, scratch):
    src = spark.range(10).withColumn("rule_key", F.lit("k"))
    src.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"{scratch}/in")
    sinks.stream_results(stream, f"{scratch}/out", f"{scratch}/ck", ("rule_key",)).awaitTermination()
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == 10 and {"batch", "rule_key"} <= set(got.columns)


def test_nested_prefixes_give_the_longest_rule(spark):
    arts = spark.createDataFrame([("r", 1, 1, "b", "/out/p/x.csv", "x.csv", None), ("r", 2, 1, "b", "out/q/y.csv", "y.csv", None), ("r", 3, 1, "b", "other/z.csv", "z.csv", None)],
                                 "run_id string, position int, chunk int, bucket string, key string, filename string, process_id string")
    runs = spark.createDataFrame([("r", "f", "SUCCEEDED", T(2024, 1, 1))], "run_id string, flow_name string, state string, started_at timestamp")
    rules = spark.createDataFrame([("wide", 1, "f", "out"), ("deep", 2, "f", "/out/p/"), ("same", 3, "f", "out/p"), ("away", 4, "g", "out/p/")],
                                  "rule_key string, rule_id int, flow_name string, outbound_prefix string")
    got = rows(L.artifacts_by_rule(arts, runs, rules, "b"), "position", "rule_key", "prefix_ok")
    assert got == [(1, "deep", False), (1, "same", False), (2, "wide", True)]


def test_statuses_and_bounded_errors(spark):
    data = [("p", "Data-Loader-File", "Completed", None), ("p", "File-Record", " done", None), ("p", "File-Record", "Queued", "")]
    data += [("p", "File-Record", "Failed", f"e{k}") for k in range(9)] + [("p", "File-Record", "Error", " e7 "), ("p", "File-Record", "Error", "")]
    status = spark.createDataFrame(data, "process_id string, sub_process_name string, status string, error string")
    r = S.terminal_state(status).first()
    assert (r["loader_statuses"], r["record_statuses"]) == ("COMPLETED", "DONE,ERROR,FAILED,QUEUED")
    assert r["errors"] == "e7 (2); ERROR (1); e0 (1); e1 (1); e2 (1)" and r["n_errors"] == 11
