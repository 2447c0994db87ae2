"""SRC-5 / PRJ-2: delimited text files of any size, each with its own header.

Spark's line reader cuts a file into splits at line breaks, but a quoted
field may hold line breaks, so whether a split begins inside a record depends on
all splits before it.  Two passes over the lines settle this without ever
holding a file or moving its rows:

1. ``_surveyed``: every split says, for both cases (its first line begins a record, or
   continues a quoted field), in which case it ends and how many records begin
   in it.  These few numbers are chained per file, which gives each split its
   case and its first record number, and each file its header.
2. ``_split_records``: every split is parsed from its case on, with the record
   numbers and column places that the first pass found.

A record that crosses a split border leaves its pieces in both; these (at most
two for a split) are put together by file and record number.
"""

from __future__ import annotations

import csv
import functools
import io
import re
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import ship_package

#: Splits whose facts are sent to every task at most; more are joined instead.
MAX_SENT_SPLITS = 100_000
#: A header that crosses a split border must end within so many bytes.
HEADER_TAIL = 1 << 20
BATCH_ROWS = 10_000

SURVEY = "file_path string, block long, r_quoted boolean, q_quoted boolean, r_records long, q_records long, first string, lead string"
SPLITS = "file_path string, block long, quoted boolean, ends_quoted boolean, base long, header array<string>"


def quoted_after(line: str, quoted: bool, sep: str) -> bool:
    """Whether a quoted field is open after the line.  A quote opens a field
    only as its first character; inside, two quotes stand for one."""
    i, opens = 0, not quoted
    while True:
        if quoted:
            i = line.find('"', i)
            if i < 0:
                return True
            if line[i + 1: i + 2] == '"':
                i += 2
                continue
            i, quoted, opens = i + 1, False, False
        if opens and line[i: i + 1] == '"':
            i, quoted = i + 1, True
            continue
        ends = [p for p in (line.find(c, i) for c in (sep, "\r", "\n")) if p >= 0]
        if not ends:
            return False
        i, opens = min(ends) + 1, True


@functools.cache
def _line_patterns(sep: str) -> tuple[re.Pattern, re.Pattern]:
    """The inside of a quoted field as far as it goes, and whole fields up to one that stays open."""
    s, inside = re.escape(sep), '(?:[^"]++|"")*+'
    field = f'(?:"{inside}"[^{s}]*+|[^"{s}][^{s}]*+|)'
    return re.compile(inside), re.compile(f'(?:{field}{s})*+"{inside}\\Z')


def line_stays_quoted(line: str, quoted: bool, sep: str) -> bool:
    """``quoted_after`` for a line without its end and without carriage returns."""
    inside, opens = _line_patterns(sep)
    at = 0
    if quoted:
        at = inside.match(line).end()
        if at == len(line):
            return True
        at = line.find(sep, at) + 1
        if not at:
            return False
    return opens.match(line, at) is not None


def _physical(lines: Iterable[str]) -> Iterator[str]:
    """Lines with their ends, cut at lone carriage returns too."""
    for line in lines:
        if "\r" in line:
            yield from io.StringIO(line + "\n", newline="")
        else:
            yield line + "\n"


def _lines(spark: SparkSession, paths) -> DataFrame:
    # Paths stay encoded until a split is done, not decoded once for each line.
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("idx"),
        F.col("value").cast("binary").alias("value"))      # decoded here: bad bytes become U+FFFD


def _texts(values: pa.Array) -> list[str]:
    values = pc.fill_null(values, b"") if values.null_count else values
    try:
        return values.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
    except pa.ArrowInvalid:
        return [v.decode("utf-8", "replace") for v in values.to_pylist()]


def _by_split(batches: Iterator[pa.RecordBatch], *extra: str) -> Iterator[tuple[tuple, Iterator[list[str]]]]:
    """((file, block, extra columns), batches of its lines) in the order of the rows."""
    def runs() -> Iterator[tuple[tuple, list[str]]]:
        for b in batches:
            if not b.num_rows:
                continue
            text = _texts(b.column("value"))
            file, block = np.asarray(b.column("file_path").dictionary_encode().indices), np.asarray(b.column("block"))
            cuts = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(text)]
            for at, to in zip(cuts, cuts[1:]):
                yield tuple(b.column(c)[at].as_py() for c in ("file_path", "block", *extra)), text[at:to]

    source = runs()
    ahead = next(source, None)
    while ahead is not None:
        key = ahead[0]

        def mine() -> Iterator[list[str]]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                part, ahead = ahead[1], next(source, None)
                yield part

        parts = mine()
        yield key, parts
        for _ in parts:       # whatever the reader left
            pass


def _survey(block: int, parts: Iterator[list[str]], sep: str) -> tuple[bool, bool, int, int, str | None, str | None]:
    """(open after the split, records begun in it) for a split that begins a
    record and for one that continues one, its first record's text and the
    text that would end the record before it."""
    ends, count = [False, True], [0, 0]
    first: list[str] = []
    lead: list[str] | None = []
    first_done, lead_done, lead_size, top = False, False, 0, block == 0
    source = (line for part in parts for line in part)
    for line in source:
        if top:
            line, top = line.lstrip("\ufeff"), False
        plain = '"' not in line and "\r" not in line
        before, begun = list(ends), [0, 0]
        for case in (0, 1):
            if plain:
                begun[case] = int(not ends[case] and line != "")
                continue
            if "\r" not in line:
                begun[case] += not ends[case]
                ends[case] = line_stays_quoted(line, ends[case], sep)
                continue
            for piece in _physical([line]):
                begun[case] += not ends[case] and piece not in ("\n", "\r", "\r\n")
                ends[case] = quoted_after(piece, ends[case], sep)
        if not first_done and (begun[0] or before[0]):
            first.append(line)
            first_done = not ends[0]
        if not lead_done:
            if lead is not None:
                lead.append(line)
                lead_size += len(line) + 1
                lead = lead if lead_size <= HEADER_TAIL else None
            lead_done = not ends[1]
        count = [n + k for n, k in zip(count, begun)]
        if ends[0] == ends[1] and first_done and lead_done:
            break
    # The cases have met: from here on they are one.
    open_, records = ends[0], 0
    for line in source:
        if "\r" in line:
            for piece in _physical([line]):
                records += not open_ and piece not in ("\n", "\r", "\r\n")
                open_ = quoted_after(piece, open_, sep)
            continue
        records += not open_ and line != ""
        if '"' in line:
            open_ = line_stays_quoted(line, open_, sep)
    if ends[0] == ends[1]:
        ends = [open_, open_]
    count = [n + records for n in count]
    return ends[0], ends[1], count[0], count[1], "\n".join(first) if first else None, "\n".join(lead) if lead is not None else None


def _surveyed(lines: DataFrame, sep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), parts in _by_split(batches):
            row = (file, block, *_survey(block, parts, sep))
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                row, (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string()))], SURVEY_NAMES)

    return lines.mapInArrow(run, SURVEY)


SURVEY_NAMES = [c.split()[0] for c in SURVEY.split(", ")]


def _chained(sep: str, names: list[str] | None):
    """The splits of one file, in order: their cases, first record numbers and the header."""
    def chain(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        quoted, base, header, text = False, 0, names, None
        out = []
        for r in pdf.itertuples():
            records, ends = (r.q_records, r.q_quoted) if quoted else (r.r_records, r.r_quoted)
            if header is None and base and quoted and text is not None:      # the header goes on here
                if r.lead is None:
                    raise ValueError(f"the header of {key[0]} does not end within {HEADER_TAIL} bytes of a split border")
                text += "\n" + r.lead
                if not r.q_quoted or r.q_records:
                    header = next(csv.reader(_physical(text.split("\n")), delimiter=sep))
            elif header is None and not base and records:
                text = r.first
                if records > 1 or not ends:
                    header = next(csv.reader(_physical(text.split("\n")), delimiter=sep))
            out.append([key[0], r.block, quoted, ends, base])
            base, quoted = base + records, ends
        if header is None and text is not None:       # a file that ends inside its header
            header = next(csv.reader(_physical(text.split("\n")), delimiter=sep))
        return pd.DataFrame([[*x, header] for x in out] if header is not None else [], columns=["file_path", "block", "quoted", "ends_quoted", "base", "header"])

    return chain


def _norm_header(h: str) -> str:
    return h.strip().lstrip("﻿").strip().lower()


def _places(header: list[str], columns: list[str]) -> list[int | None]:
    at: dict[str, int] = {}
    for k, h in enumerate(header):
        at.setdefault(_norm_header(h), k)
    return [at.get(_norm_header(c)) for c in columns]


def _split_records(parts: Iterator[list[str]], block: int, quoted: bool, ends_quoted: bool, sep: str) -> Iterator[tuple[str, object]]:
    """("record", fields) of every record inside a split, and the text pieces
    ("lead", "tail") of those that cross its borders."""
    waiting: list[str] = []          # physical lines of the record being read

    def physical() -> Iterator[str]:
        top = True
        for part in parts:
            if top and block == 0 and part:
                part[0] = part[0].lstrip("﻿")
            top = False
            for line in _physical(part):
                waiting.append(line)
                yield line

    source = physical()
    if quoted:
        open_ = True
        while open_ and (line := next(source, None)) is not None:
            open_ = quoted_after(line, open_, sep)
        yield "lead", "".join(waiting)
        waiting.clear()
        if open_:
            return
    held = None
    for fields in csv.reader(source, delimiter=sep):
        if held is not None:
            yield "record", held
        # The last record is only known to be whole when another one, or a closed split, follows.
        text, held = ("".join(waiting), fields or None)
        waiting.clear()
    if held is not None:
        yield ("tail", text) if ends_quoted else ("record", held)


def _parsed(spark: SparkSession, paths, columns: list[str], sep: str, names: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """(rows, splits): ``file_path``, ``row_no`` (from 1), the columns and
    ``missing_columns`` of every record but headers; the facts of every split."""
    from sluice.session import materialize

    ship_package(spark)
    lines = _lines(spark, paths)
    splits = materialize(_surveyed(lines, sep).groupBy("file_path").applyInPandas(_chained(sep, names), SPLITS), "splits")
    sent = splits.count() <= MAX_SENT_SPLITS
    facts = splits.select("file_path", "block", "quoted", "ends_quoted", "base", "header")
    splits = splits.withColumn("file_path", F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))))
    met = lines.join(F.broadcast(facts) if sent else facts, ["file_path", "block"])
    if not sent:      # rows were moved: back into the order of their lines
        met = met.sortWithinPartitions("file_path", "block", "idx")
    shift = 0 if names is None else 1
    out_names = ["file_path", "row_no", "piece", "text", *columns, "missing_columns"]
    schema = ", ".join(["file_path string, row_no long, piece long, text string", *(f"`{c}` string" for c in columns), "missing_columns array<string>"])

    def frame(file: str, rows: list[tuple], missing: list[str]) -> pa.RecordBatch:
        cols, same = list(zip(*rows)), pa.array(np.zeros(len(rows), np.int64))
        return pa.RecordBatch.from_arrays([
            pa.array([file], pa.string()).take(same), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
            *(pa.array(c, pa.string()) for c in cols[3:]), pa.array([missing], pa.list_(pa.string())).take(same)], out_names)

    def picked(fields: list[str], where: list[int | None]) -> list[str | None]:
        return [fields[k] if k is not None and k < len(fields) and fields[k] != "" else None for k in where]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block, quoted, ends, base, header), parts in _by_split(batches, "quoted", "ends_quoted", "base", "header"):
            file, where = unquote(file), _places(header, columns)
            missing = [c for c, k in zip(columns, where) if k is None]
            rows, n = [], base
            for kind, value in _split_records(parts, block, quoted, ends, sep):
                if kind == "lead":
                    rows.append((n - 1 + shift, block, value, *[None] * len(columns)))
                elif kind == "tail":
                    rows.append((n + shift, block, value, *[None] * len(columns)))
                else:
                    rows.append((n + shift, None, None, *picked(value, where)))
                n += kind != "lead"
                if len(rows) >= BATCH_ROWS:
                    yield frame(file, rows, missing)
                    rows = []
            if rows:
                yield frame(file, rows, missing)

    parsed = met.select("file_path", "block", "value", "quoted", "ends_quoted", "base", "header").mapInArrow(run, schema)
    whole = parsed.where("piece is null and row_no > 0").drop("piece", "text")
    crossing = splits.where("ends_quoted").select("file_path").distinct()
    if crossing.isEmpty():
        return whole, splits

    def join(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece")
        header, missing = list(pdf["header"].iloc[0]), list(pdf["missing_columns"].iloc[0])
        fields = next(csv.reader(io.StringIO("".join(pdf["text"]), newline=""), delimiter=sep), [])
        return pd.DataFrame([[key[0], key[1], *picked(fields, _places(header, columns)), missing]], columns=["file_path", "row_no", *columns, "missing_columns"])

    head = splits.groupBy("file_path").agg(F.first("header").alias("header"))
    pieces = parsed.join(crossing, "file_path", "left_semi").where("piece is not null and row_no > 0").join(head, "file_path")
    joined = pieces.groupBy("file_path", "row_no").applyInPandas(join, whole.schema)
    return whole.unionByName(joined), splits


def read_delimited(spark: SparkSession, paths, columns: list[str], sep: str = ",", names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All-string rows (``file_path``, ``row_no``, ``columns``,
    ``missing_columns``) of delimited files, and the files that have a header
    (``file_path``, ``missing_columns``).

    Each file's own header says where the ``columns`` are (trimmed, in any
    case); absent columns and empty fields are null.  ``row_no`` counts a file's
    records from 1, blank lines left out.  ``names`` stands for the header of files
    without one.  Quotes, quoted line breaks, byte order marks and bad bytes are
    taken as Python's ``csv`` takes them; files without a record have no header."""
    rows, splits = _parsed(spark, paths, columns, sep, names)
    wanted = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(_norm_header(c)).alias("norm")) for c in columns))
    plain = F.transform(F.first("header"), lambda h: F.lower(F.trim(F.regexp_replace(F.trim(h), "^﻿+", ""))))
    files = splits.groupBy("file_path").agg(plain.alias("header")).select(
        "file_path", F.transform(F.filter(wanted, lambda w: ~F.array_contains("header", w["norm"])), lambda w: w["name"]).alias("missing_columns"))
    return rows, files


def write_delimited(rows: DataFrame, folder: str, name: str, order: str, header: str, values: str, parts: int = 1) -> None:
    """Write rows as delimited files with a header line each: below ``folder``,
    one folder ``name=<name>/part=<k>`` for each value of column ``name`` and
    each of ``parts`` shares of its rows (dealt by ``order``, kept in its order).

    ``header`` and ``values`` are string-array columns; the header is the same in all rows of a name."""
    quoted = F.transform(F.col("_v"), lambda v: F.when(v.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')))
                         .otherwise(F.coalesce(v, F.lit(""))))
    text = F.concat_ws(",", quoted)
    line = F.when(text == "", F.lit('""')).otherwise(text)
    keys = [F.col(name).alias("name"), F.pmod(F.col(order).cast("long"), F.lit(parts)).alias("part")]
    body = rows.select(*keys, F.lit(1).alias("_is_row"), F.col(order).cast("long").alias("_order"), F.col(values).alias("_v"))
    heads = rows.select(*keys, F.col(header).alias("_v")).distinct().select("name", "part", F.lit(0).alias("_is_row"), F.lit(0).cast("long").alias("_order"), "_v")
    (heads.unionByName(body).select("name", "part", "_is_row", "_order", line.alias("value")).repartition("name", "part")
     .sortWithinPartitions("name", "part", "_is_row", "_order").drop("_is_row", "_order").write.partitionBy("name", "part").text(folder))
