"""Operator 9: token-id files of patched frame-of-reference blocks.

Ids are written in ascending document order.  A *segment* holds whole
documents of about ``SEGMENT_IDS`` ids::

    header   magic, documents, ids, blocks           (4 x uint32, then the tables)
    docs     id (int64), validity (uint8), length (uint32) of each document
    index    byte offset of each block (uint64), from the first block on
    blocks   minimum (uint32) | width (uint8) | pad | exceptions (uint16)
             packed ids, ``width`` bits each, above the minimum
             exception places (uint16), exception values (uint32)

The width of a block is the one that holds ``PERCENTILE`` of its ids; larger
ones go to the exception list.  Segments are rows of a Parquet table in the
folder that the caller names (a shared one), written by Spark's own
committed writer on any file system, so a lost executor costs a task and never a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import bpe
from sluice.llm import text as T
from sluice.llm.packing import with_end

BLOCK = 1024
PERCENTILE = 95
SEGMENT_IDS = 1 << 20
MAGIC = 0x31524650
SEGMENTS = "part int, segment int, start_in_part long, n_docs long, n_ids long, payload binary"


def _width(x: np.ndarray) -> np.ndarray:
    """Bits that hold each value (0 for 0)."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(byte offset of each block, all blocks) of uint32 ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), b""
    grid = np.empty(blocks * BLOCK, np.int64)
    grid[:n] = ids
    grid[n:] = ids[-1]
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    grid -= low[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    width = _width(np.partition(grid, rank, axis=1)[:, rank])
    over = (grid >> width[:, None]) > 0
    if n < blocks * BLOCK:
        over.reshape(-1)[n:] = False
    body: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        if w == 0:
            continue
        for a in range(0, len(rows), 256):
            part = rows[a: a + 256]
            bits = ((grid[part][:, :, None] >> np.arange(w)) & 1).astype(np.uint8)
            packed = np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little")
            for k, r in enumerate(part.tolist()):
                body[r] = packed[k].tobytes()
    exceptions = over.sum(axis=1)
    where = np.nonzero(over)
    places, values = where[1].astype("<u2"), grid[where].astype("<u4")
    ends = np.cumsum(exceptions)
    out, offsets, at = [], np.zeros(blocks, np.uint64), 0
    head = np.zeros(blocks, np.dtype([("low", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")]))
    head["low"], head["width"], head["exceptions"] = low, width, exceptions
    for k in range(blocks):
        s, e = int(ends[k] - exceptions[k]), int(ends[k])
        blob = head[k].tobytes() + body[k] + places[s:e].tobytes() + values[s:e].tobytes()
        offsets[k] = at
        at += len(blob)
        out.append(blob)
    return offsets, b"".join(out)


def decode_ids(offsets: np.ndarray, blob: bytes, n: int) -> np.ndarray:
    """The ids of all blocks."""
    blocks = len(offsets)
    raw = np.frombuffer(blob, np.uint8)
    at = offsets.astype(np.int64)
    head = raw[at[:, None] + np.arange(8)].copy().view(np.dtype([("low", "<u4"), ("width", "u1"), ("pad", "u1"), ("exceptions", "<u2")]))[:, 0] if blocks else np.zeros(0)
    out = np.zeros((blocks, BLOCK), np.int64)
    if blocks:
        width = head["width"].astype(np.int64)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            if w:
                for a in range(0, len(rows), 256):
                    part = rows[a: a + 256]
                    packed = raw[(at[part] + 8)[:, None] + np.arange(BLOCK * w // 8)]
                    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
                    whole = np.zeros((len(part), BLOCK, 4 if w <= 32 else 8), np.uint8)
                    some = np.packbits(bits, axis=2, bitorder="little")
                    whole[:, :, : some.shape[2]] = some
                    out[part] = whole.view("<u4")[:, :, 0]
        count = head["exceptions"].astype(np.int64)
        for k in np.flatnonzero(count).tolist():
            s, c = int(at[k] + 8 + BLOCK * width[k] // 8), int(count[k])
            out[k, np.frombuffer(blob, "<u2", c, s)] = np.frombuffer(blob, "<u4", c, s + 2 * c)
        out += head["low"].astype(np.int64)[:, None]
    return out.reshape(-1)[:n].astype("<u4")


def segment_bytes(doc_ids: np.ndarray, valid: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    offsets, blob = encode_ids(ids)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(offsets)], "<u4")
    return b"".join([head.tobytes(), doc_ids.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(), lengths.astype("<u4").tobytes(), offsets.astype("<u8").tobytes(), blob])


def read_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, validity, lengths, ids) of one segment."""
    magic, docs, n, blocks = np.frombuffer(payload, "<u4", 4).tolist()
    if magic != MAGIC:
        raise ValueError("not a token-id segment")
    at = 16
    doc_ids = np.frombuffer(payload, "<i8", docs, at)
    at += 8 * docs
    valid = np.frombuffer(payload, np.uint8, docs, at).astype(bool)
    at += docs
    lengths = np.frombuffer(payload, "<u4", docs, at).astype(np.int64)
    at += 4 * docs
    offsets = np.frombuffer(payload, "<u8", blocks, at)
    return doc_ids, valid, lengths, decode_ids(offsets, payload[at + 8 * blocks:], n)


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 0, text: str = "text", id_col: str = "doc_id") -> None:
    """Encode every text (null: empty) with the tokenizers library, append
    ``end_id``, and write segments in ascending (id, text) order; null ids
    come first.  Range partitions follow each other in id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.worker_encoder("library", path)
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        waiting = start = number = 0

        def close() -> pa.RecordBatch:
            nonlocal held, waiting, start, number
            doc, valid, lens, ids = (np.concatenate(x) for x in zip(*held))
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start]), pa.array([len(doc)]),
                pa.array([len(ids)]), pa.array([segment_bytes(doc, valid, lens, ids)], pa.binary())],
                ["part", "segment", "start_in_part", "n_docs", "n_ids", "payload"])
            held, waiting, start, number = [], 0, start + len(ids), number + 1
            return row

        for b in T.slices(batches, text):
            ids, off = with_end(*enc.encode(T.text_column(b, text).to_pylist()), end_id)
            col = b.column(id_col).cast(pa.int64())
            held.append((np.asarray(col.fill_null(0)), np.asarray(col.is_valid()), np.diff(off), ids))
            waiting += len(ids)
            if waiting >= SEGMENT_IDS:
                yield close()
        if held:
            yield close()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(id_col, text).repartitionByRange(parts, id_col).sortWithinPartitions(id_col, text)
     .mapInArrow(run, SEGMENTS).write.mode("overwrite").parquet(folder))


def read_ids(spark, folder: str) -> DataFrame:
    """Documents of the written files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32``.

    Only the totals of the write's partitions reach the driver.
    """
    files = spark.read.schema(SEGMENTS).parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in totals:
        base[r["part"]] = at
        at += r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                doc, valid, lens, ids = read_segment(b.column("payload")[k].as_py())
                ends = np.cumsum(lens)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * s: 4 * e]) for s, e in zip((ends - lens).tolist(), ends.tolist())]
                first = base[b.column("part")[k].as_py()] + b.column("start_in_part")[k].as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, mask=~valid), pa.array(first + ends - lens), pa.array(lens), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "start_in_part", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
