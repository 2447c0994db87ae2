"""Operator 4: pack documents into fixed-size token sequences by best-two-fit.

Every document is encoded, gets the end id, and only if longer than a
sequence is cut into full pieces (the first takes the remainder).  Full pieces
are sequences already.  The others are dealt evenly into groups of about
``group_rows`` pieces, by a hash of the stored row, so that no key of the
data can make a group hot; each group is packed by best-two-fit on its length
counts, and a group leaves about one sequence unfilled.

Best-two-fit fills a bin greedily with the largest pieces that still fit, then
replaces its smallest piece by the two unpacked pieces that fill the expanded
gap best, if they fill it better.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm import text as T
from sluice.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each document of (ids, offsets)."""
    return np.insert(ids, off[1:], end_id).astype("<u4"), off + np.arange(len(off))


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
                 text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document.  Null text is
    empty: one piece with the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.worker_encoder("library", path)
        for b in T.slices(batches, text):
            ids, off = with_end(*enc.encode(T.text_column(b, text).to_pylist()), end_id)
            n = np.diff(off)
            count = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            head = n - (count - 1) * capacity
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            raw, at = memoryview(ids.tobytes()), (off[row] + start) * 4
            crc = [zlib.crc32(raw[a:z]) for a, z in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays([
                b.column(id_col).cast(pa.int64()).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, text).mapInArrow(run, PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in the bin) of each piece; lengths in 1..capacity."""
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(lengths, kind="stable")
    counts = np.bincount(lengths, minlength=capacity + 1)
    next_of = np.cumsum(counts) - counts            # next unpacked piece of each length, in `order`
    sizes = np.arange(capacity + 1)
    # largest unpacked length not above x (0: none)
    best = np.maximum.accumulate(np.where(counts > 0, sizes, 0))
    present = np.flatnonzero(counts)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, number = len(lengths), 0

    def change(size: int, by: int) -> None:
        nonlocal best, present, left
        counts[size] += by
        left += by
        if counts[size] == (0 if by < 0 else 1):
            best = np.maximum.accumulate(np.where(counts > 0, sizes, 0))
            present = np.flatnonzero(counts)

    while left:
        held: list[int] = []
        gap = capacity
        while gap and (size := int(best[gap])):
            held.append(size)
            gap -= size
            change(size, -1)
        if gap and left and held:
            small = held[-1]
            room = gap + small
            a = present[: np.searchsorted(present, room - 1, "right")]
            if len(a):
                b = best[room - a]
                # a piece cannot be used twice: take the next smaller length where only one is left
                twice = (b == a) & (counts[a] < 2)
                b = np.where(twice, best[np.maximum(b - 1, 0)], b)
                both = np.where(b > 0, a + b, 0)
                k = int(np.argmax(both))
                if both[k] > small:
                    held.pop()
                    change(small, 1)
                    for size in (int(a[k]), int(b[k])):
                        held.append(size)
                        change(size, -1)
        at = 0
        for size in held:
            who = order[next_of[size]]
            next_of[size] += 1
            bins[who], offsets[who] = number, at
            at += size
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 2048, group_rows: int = 200_000) -> DataFrame:
    """Adds ``sequence_id`` (any numbers) and ``offset`` to stored pieces."""
    rows = pieces.withColumn("_row", F.monotonically_increasing_id())
    short = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-pieces.filter(F.col("length") < capacity).count() // group_rows))
    full = rows.filter(F.col("length") >= capacity).select(
        *pieces.columns, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(key, pdf):
        pdf = pdf.sort_values(["length", "doc_id", "_row"], ignore_index=True)
        bins, offsets = best_two_fit(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"], pdf["offset"] = (int(key[0]) << 32) + bins, offsets
        return pdf.drop(columns=["_row", "_group"])

    schema = PIECES + ", sequence_id long, offset long"
    packed = (short.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
              .groupBy("_group").applyInPandas(run, schema))
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
                   text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pieces with their sequence and place: one row per piece of every
    document.  An empty table gives no rows; repeated rows are packed once
    each; null ids stay null."""
    return pack(materialize(token_pieces(docs, path, capacity, end_id, text, id_col), "pieces"), capacity)
