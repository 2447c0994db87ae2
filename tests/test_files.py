"""Folder listings with empty files, range reads, and the newest log file per run."""

import os
import random

from sluice.operators import artifacts, logs
from sluice.sources import files

from conftest import rows


def _write(path, data, when):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    os.utime(path, (when, when))


def test_listing_has_empty_and_nested_files(spark, scratch):
    for k, (name, data) in enumerate({"top.txt": b"1", "a/empty.csv": b"", "a/b/c/deep file.csv": b"xyz", "d+e/%20.csv": b"22"}.items()):
        _write(f"{scratch}/{name}", data, 1_700_000_000 + k)
    got = files.list_files(spark, scratch)
    assert [(p[len(scratch) + 1:], n) for p, n in rows(got, "path", "size")] == [("a/b/c/deep file.csv", 3), ("a/empty.csv", 0), ("d+e/%20.csv", 2), ("top.txt", 1)]
    assert files.list_files(spark, scratch + "/none").count() == 0


def test_lines_by_ranges_equal_whole_files(spark, scratch):
    rng = random.Random(1)
    want = []
    for k in range(5):
        lines = ["x" * rng.choice([0, 1, 3, 40, 200]) + "ü" * rng.randint(0, 2) for _ in range(rng.randint(0, 60))]
        end = "\r\n" if k % 2 else "\n"
        data = (end.join(lines) + (end if k % 3 else "")).encode()
        _write(f"{scratch}/f{k}.log", data, 1_700_000_000)
        at = 0
        for line in data.split(b"\n"):
            if at < len(data):
                want.append((f"f{k}.log", at, line.removesuffix(b"\r").decode()))
            at += len(line) + 1
    _write(f"{scratch}/bad.log", b"a\xffb\n", 1_700_000_000)
    want.append(("bad.log", 0, "a�b"))
    listing = files.list_files(spark, scratch)
    for size in (7, 64, 1 << 20):
        got = [(os.path.basename(p), at, line) for p, at, line in rows(files.read_lines(listing, range_bytes=size), "path", "offset", "line")]
        assert sorted(got) == sorted(want)


def test_newest_log_file_feeds_the_source_choice(spark, scratch):
    done = b"Chunk 1 written to s3://b/out/x.csv\n"
    _write(f"{scratch}/one/output-jr_1-a.log", b"jr_1 started\n" + done, 1_700_000_100)
    _write(f"{scratch}/one/output-jr_1-b.log", b"jr_1 started\n", 1_700_000_900)            # newer: chosen, and not complete
    _write(f"{scratch}/one/output-jr_1-c.log", b"", 1_700_000_999)                          # empty files do not count
    _write(f"{scratch}/two/output-jr_1-d.log", b"jr_1\n" + done, 1_700_009_000)             # a later folder
    _write(f"{scratch}/two/output-jr_2-a.log", b"jr_2 started\n" + done, 1_700_000_100)
    _write(f"{scratch}/two/other.log", b"never opened\n", 1_700_000_100)
    runs = spark.createDataFrame([("jr_1",), ("jr_2",), ("jr_3",)], "run_id string")
    found = logs.newest_log_captures(files.list_files(spark, scratch), runs, [f"{scratch}/one", f"{scratch}/two"], ["output-{run_id}-*.log"], r"(jr_[0-9]+)")
    assert rows(found, "run_id", "file_name", "message") == [
        ("jr_1", "output-jr_1-b.log", "jr_1 started"), ("jr_2", "output-jr_2-a.log", done.decode().strip()), ("jr_2", "output-jr_2-a.log", "jr_2 started")]
    picks = {r["run_id"]: (r["state"], r["failures"]) for r in logs.pick_source(logs.log_summary(found), "file").collect()}
    assert picks["jr_2"][0] == "OK" and picks["jr_1"][0] == "FAIL"


def test_inventory_of_a_folder_reaches_the_empty_state(spark, scratch):
    _write(f"{scratch}/bucket/out/a.csv", b"id\n", 1_700_000_500)
    _write(f"{scratch}/bucket/out/b.csv", b"", 1_700_000_500)
    inv = artifacts.inventory_from_folder(spark, f"{scratch}/bucket", "bkt")
    assert rows(inv, "bucket", "key", "size") == [("bkt", "out/a.csv", 3), ("bkt", "out/b.csv", 0)]
    arts = spark.createDataFrame([("r", "k", 1, "bkt", "out/a.csv"), ("r", "k", 2, "bkt", "out/b.csv"), ("r", "k", 3, "bkt", "out/c.csv")],
                                 "run_id string, rule_key string, position int, bucket string, key string")
    runs = spark.createDataFrame([("r", "2023-01-01")], "run_id string, started_at string").selectExpr("run_id", "to_timestamp(started_at) as started_at")
    picks = spark.createDataFrame([("r", True)], "run_id string, run_verified boolean")
    states = {r["position"]: (r["state"], r["verdict"]) for r in artifacts.check_artifacts(arts, inv, runs, picks).collect()}
    assert states == {1: ("ok", "PASS"), 2: ("0 bytes", "FAIL"), 3: ("not found", "FAIL")}
