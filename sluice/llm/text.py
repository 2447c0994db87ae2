"""Shared batch helpers: Arrow text columns as flat numpy buffers, span hashing.

Every operator that must run Python works on whole Arrow batches inside
``mapInArrow``: the texts of a batch are one byte (or code point) array plus
offsets, and the work is vectorised over that array.  Batches are cut into
slices of at most ``SLICE_BYTES`` text bytes first, so a task's memory does not
grow with the batch (one text longer than that is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element-wise on uint64 (wraps by design)."""
    x = np.asarray(x).astype(_U, copy=True)
    with np.errstate(over="ignore"):
        x += _U(0x9E3779B97F4A7C15)
        x ^= x >> _U(30)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(27)
        x *= _U(0x94D049BB133111EB)
        x ^= x >> _U(31)
    return x


_BYTE_KEYS = mix64(np.arange(256) + (1 << 40))
_weights = mix64(np.arange(4096)) | _U(1)


def _position_weights(n: int) -> np.ndarray:
    global _weights
    if n > len(_weights):
        _weights = mix64(np.arange(max(n, 2 * len(_weights)))) | _U(1)
    return _weights


def span_hash(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``values[start:start+len]`` (bytes or code
    points); equal spans hash equally wherever they stand.  A sum of
    character keys times position weights, mixed with the length."""
    starts, lens = np.asarray(starts, np.int64), np.asarray(lens, np.int64)
    out = np.zeros(len(starts), _U)
    full = np.flatnonzero(lens > 0)
    if len(full):
        s, n = starts[full], lens[full]
        ends = np.cumsum(n)
        first = ends - n
        every = np.arange(ends[-1], dtype=np.int32 if ends[-1] < 2**31 else np.int64)
        weights = _position_weights(int(n.max()))[every - np.repeat(first.astype(every.dtype), n)]
        if ends[-1] == s[-1] + n[-1] - s[0]:     # no gaps between the spans
            chars = values[s[0]: s[0] + ends[-1]]
        else:
            chars = values[np.repeat(s - first, n) + every]
        del every
        with np.errstate(over="ignore"):
            if values.dtype == np.uint8:
                weights *= _BYTE_KEYS[chars]
            else:
                keys = (chars.astype(_U) + _U(1)) * _U(0xD6E8FEB86659FD93)
                keys ^= keys >> _U(32)
                weights *= keys
            out[full] = np.add.reduceat(weights, first)
    return mix64(out ^ (lens.astype(_U) << _U(40)))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(name)
    return pc.fill_null(col, "") if col.null_count else col


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of a null-free string array, zero-copy."""
    wide = pa.types.is_large_string(col.type)
    bufs = col.buffers()
    if len(col) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], *text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into zero-copy slices of at most ``limit`` text bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.zeros(batch.num_rows, np.int64)
        for name in text:
            size += np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0), np.int64)
        at, total = 0, np.cumsum(size)
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def crc_bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (the folds of the contracts)."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(column).cast("string")) % modulus


def fresh(docs, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
