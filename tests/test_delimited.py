"""The split reader against Python's csv, with splits of a few bytes."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from sluice.sources import delimited as D


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "157")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plain(data: bytes, columns, names=None):
    """(row_no, values) of one file, and its missing columns (None: no header)."""
    reader = csv.reader(io.StringIO(data.decode("utf-8", "replace").lstrip("﻿"), newline=""))
    records = [r for r in reader if r]
    head = names if names is not None else records.pop(0) if records else None
    if head is None:
        return [], None
    norm = [h.strip().lower() for h in head]
    at = [norm.index(c.lower()) if c.lower() in norm else None for c in columns]
    rows = [(k + 1, *(r[i] or None if i is not None and i < len(r) else None for i in at)) for k, r in enumerate(records)]
    return rows, [c for c, i in zip(columns, at) if i is None]


def _file(rng, end):
    names = ["id", " Name ", "note", "extra"]
    rng.shuffle(names)
    names = names[: rng.randint(2, 4)]
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(names)
    values = ["", "x", "long value " * 3, 'say "hi"', "two\nlines", "a,b", "cr\r\nlf", "ü✓", 'mid"quote', "\n\n\n", '"', "tail " * 40 + "\n" + "more " * 40]
    for _ in range(rng.randint(0, 25)):
        w.writerow([rng.choice(values) for _ in range(rng.randint(1, 5))])
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue().encode()


@pytest.mark.parametrize("sent", [D.MAX_SENT_SPLITS, 0])
def test_small_splits_equal_a_whole_read(spark, scratch, small_splits, monkeypatch, sent):
    monkeypatch.setattr(D, "MAX_SENT_SPLITS", sent)
    rng = random.Random(sent)
    files = {f"f{k}.csv": _file(rng, "\r\n" if k % 2 else "\n") for k in range(7)}
    files["bom.csv"] = b"\xef\xbb\xbf\n\nID,note\n1,\xff\n2\n"
    files["header.csv"] = b"id,name\n"
    files["header only, quoted.csv"] = b'"id\n' + b"x" * 200 + b'",name,"no\nte"\n5,"a\nb",c\n'
    files["blank.csv"] = b"\n\n"
    files["open quote.csv"] = b'id,name\n1,"never ends\n' + b"more\n" * 60
    files["literal.csv"] = b'id,name\n1,a"b\n2,c"\n"3"x,d\n' * 9
    for name, data in files.items():
        with open(f"{scratch}/{name}", "wb") as f:
            f.write(data)
    columns = ["id", "name", "note"]
    rows, seen = D.read_delimited(spark, scratch, columns)
    short = F.substring_index("file_path", "/", -1)
    got, heads = {}, {r["f"]: r["missing_columns"] for r in seen.select(short.alias("f"), "missing_columns").collect()}
    for r in rows.select(short.alias("f"), "row_no", *columns, "missing_columns").collect():
        got.setdefault(r["f"], []).append(tuple(r)[1:5])
        assert r["missing_columns"] == heads[r["f"]]
    for name, data in files.items():
        want, missing = _plain(data, columns)
        assert heads.get(name) == missing, name
        assert sorted(got.get(name, []), key=lambda r: r[0]) == want, name


def test_named_columns_and_other_separator(spark, scratch):
    with open(f"{scratch}/a.txt", "w") as f:
        f.write("1|x\n2|y|z\n")
    rows, _ = D.read_delimited(spark, scratch, ["b", "a", "c"], "|", names=["a", "b"])
    assert sorted(map(tuple, rows.select("row_no", "a", "b", "c").collect())) == [(1, "1", "x", None), (2, "2", "y", None)]


def test_quoted_after():
    for text in ('a,"b', 'a,"b""', '"x" y"', 'a"b,"c', '"a",b\r"c', ',,"', 'x'):
        for quoted in (False, True):
            lead = '"' if quoted else ""
            record = list(csv.reader(io.StringIO(lead + text + "\n\x00end", newline="")))
            assert D.quoted_after(text, quoted, ",") == ("\n\x00end" in record[-1][-1]), (text, quoted)


def test_line_stays_quoted_equals_quoted_after():
    rng = random.Random(5)
    for _ in range(20_000):
        line = "".join(rng.choice('ab"",;') for _ in range(rng.randrange(12)))
        for quoted in (False, True):
            for sep in ",;":
                assert D.line_stays_quoted(line, quoted, sep) == D.quoted_after(line + "\n", quoted, sep), (line, quoted, sep)


def test_a_survey_reads_most_lines_once(monkeypatch):
    read = []
    monkeypatch.setattr(D, "quoted_after", lambda *a, old=D.quoted_after: read.append(a) or old(*a))
    lines = ["id,note", *(x for k in range(1000) for x in (f'{k},"said ""{k}"",', 'line two"'))]
    assert D._survey(0, iter([lines]), ",")[:3] == (False, False, 1001)
    assert len(read) < 10


def test_survey_equals_the_line_by_line_one():
    rng = random.Random(6)
    for _ in range(3000):
        lines = ["".join(rng.choice('ab"",\r') for _ in range(rng.randrange(7))) for _ in range(rng.randrange(9))]
        want = []
        for case in (False, True):
            open_, n = case, 0
            for piece in D._physical(lines):
                n += not open_ and piece not in ("\n", "\r", "\r\n")
                open_ = D.quoted_after(piece, open_, ",")
            want.append((open_, n))
        got = D._survey(9, iter([lines]), ",")
        assert (got[0], got[2]) == want[0] and (got[1], got[3]) == want[1], lines
