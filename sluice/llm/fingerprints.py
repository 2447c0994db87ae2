"""Operator 1: document fingerprints as invertible Bloom lookup sketches.

A text is cut into paragraph pieces: at line breaks, and within a line where
the last four bytes hash to a cut (every 32 bytes or so), so that an edit
changes the pieces around it and no others.  A piece and its occurrence
number (first, second, ... of that content in the text) make a 64-bit digest.
The sketch has three rows of cells; each digest adds itself to one cell of
each row (count, digest sum, check sum).  Sketches subtract cell by cell;
*peeling* takes digests out of cells that hold exactly one, until the
differing digests of both versions are recovered or no such cell is left.
Then both versions are sketched anew four times as large.

Likeness of two fingerprints is (shared digests) / (all digests); two texts
without pieces are alike (1.0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm import text as T
from sluice.llm.order import with_copies

ROWS = 3
#: Cells in each row of the stored sketch; retries are GROW times as large.
BASE = 8
GROW = 4
_U = np.uint64


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest of each piece, owner text) of concatenated UTF-8 texts."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    cut = data == 10
    if n > 3:
        x = data.astype(np.uint32)
        word = x[3:] | x[2:-1] << np.uint32(8) | x[1:-2] << np.uint32(16) | x[:-3] << np.uint32(24)
        word *= np.uint32(2654435761)
        word ^= word >> np.uint32(15)
        word *= np.uint32(2246822519)
        hit = (word >> np.uint32(27)) == 0
        for k in range(3):   # the window must not reach into the text before
            near = offsets[:-1] + k - 3
            hit[near[(near >= 0) & (near < len(hit))]] = False
        cut[3:] |= hit
    cut[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.append(0, ends[:-1])
    owner = np.searchsorted(offsets, starts, "right") - 1
    digest = T.span_hash(data, starts, ends - starts)
    order = np.lexsort((digest, owner))
    d, o = digest[order], owner[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(d))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    with np.errstate(over="ignore"):
        return T.mix64(d + occurrence.astype(_U) * _U(0xA24BAED4963EE407)), o


def _check(digest: np.ndarray) -> np.ndarray:
    return T.mix64(digest ^ _U(0x5851F42D4C957F2D)) >> _U(32)


def _cells(digest: np.ndarray, width: int) -> np.ndarray:
    """Cell of each digest in each row, shape (ROWS, n)."""
    return np.stack([k * width + ((digest >> _U(21 * k)) % _U(width)).astype(np.int64) for k in range(ROWS)])


def sketch(digest: np.ndarray, owner: np.ndarray, owners: int, width: int, sign: np.ndarray | int = 1) -> list[np.ndarray]:
    """[counts, digest sums, check sums], each (owners, ROWS * width)."""
    size = ROWS * width
    count, total, check = np.zeros(owners * size, np.int64), np.zeros(owners * size, _U), np.zeros(owners * size, _U)
    at = (_cells(digest, width) + owner * size).ravel()
    signs = np.broadcast_to(np.asarray(sign, np.int64), digest.shape)
    with np.errstate(over="ignore"):
        s = signs.astype(_U)      # -1 wraps to 2^64 - 1
        np.add.at(count, at, np.tile(signs, ROWS))
        np.add.at(total, at, np.tile(digest * s, ROWS))
        np.add.at(check, at, np.tile(_check(digest) * s, ROWS))
    return [x.reshape(owners, size) for x in (count, total, check)]


def peel(cells: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Recover what a difference of sketches holds.

    Returns (pair, digest, side) of every recovered digest, side 1 or -1, and
    whether each pair is fully peeled."""
    count, total, check = (x.copy() for x in cells)
    owners, size = count.shape
    flat = [x.reshape(-1) for x in (count, total, check)]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    live = np.flatnonzero(np.abs(flat[0]) == 1)
    with np.errstate(over="ignore"):
        while len(live):
            live = live[np.abs(flat[0][live]) == 1]
            side = flat[0][live]
            s = side.astype(_U)
            digest = flat[1][live] * s
            row = (live % size) // width
            pure = (_check(digest) == flat[2][live] * s) & (_cells(digest, width)[row, np.arange(len(live))] == live % size)
            live, side, digest = live[pure], side[pure], digest[pure]
            if not len(live):
                break
            pair = live // size
            _, one = np.unique(T.mix64(digest + T.mix64(pair)), return_index=True)
            pair, side, digest = pair[one], side[one], digest[one]
            found.append((pair, digest, side))
            at = (_cells(digest, width) + pair * size).ravel()
            s = (-side).astype(_U)
            np.add.at(flat[0], at, np.tile(-side, ROWS))
            np.add.at(flat[1], at, np.tile(digest * s, ROWS))
            np.add.at(flat[2], at, np.tile(_check(digest) * s, ROWS))
            live = np.unique(at)
    done = ~((count != 0) | (total != 0) | (check != 0)).any(axis=1)
    out = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3)]
    return out[0].astype(np.int64), out[1].astype(_U), out[2], done


def _group(digest: np.ndarray, owner: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the owners in ``keep``, renumbered by their place there."""
    place = np.full(int(max(owner.max(initial=-1), keep.max(initial=-1))) + 1, -1, np.int64)
    place[keep] = np.arange(len(keep))
    to = place[owner]
    return digest[to >= 0], to[to >= 0]


def differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], pairs: int,
                first: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, side) of every digest in which version a and version b
    of each pair differ; ``first`` is the difference of their stored sketches."""
    found, open_, width, cells = [], np.arange(pairs), BASE, first
    while len(open_):
        if cells is None:
            da, oa = _group(*a, open_)
            db, ob = _group(*b, open_)
            cells = sketch(np.concatenate([da, db]), np.concatenate([oa, ob]), len(open_), width,
                           np.concatenate([np.ones(len(da), np.int64), -np.ones(len(db), np.int64)]))
        pair, digest, side, done = peel(cells, width)
        ok = done[pair]
        found.append((open_[pair[ok]], digest[ok], side[ok]))
        open_ = open_[~done]
        width, cells = width * GROW, None
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))


def likeness(a, b, pairs: int, first=None) -> np.ndarray:
    pair, _, _ = differences(a, b, pairs, first)
    differ = np.bincount(pair, minlength=pairs)
    all_ = np.bincount(a[1], minlength=pairs) + np.bincount(b[1], minlength=pairs)
    return np.where(all_ > 0, (all_ - differ) / np.maximum(all_ + differ, 1), 1.0)


def render(cells: list[np.ndarray]) -> list[str]:
    """The stored sketches as text: base64 of counts, digest sums, check sums."""
    count, total, check = cells
    return [base64.b64encode(count[k].astype("<i4").tobytes() + total[k].astype("<u8").tobytes() + check[k].astype("<u8").tobytes()).decode()
            for k in range(len(count))]


def texts_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return pieces(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the next text's first as many."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
    n = len(ids)
    edited = [edit(t, x) for t, x in zip(texts, [*texts[1:], following])]
    digest, owner = texts_pieces([*texts, following])
    e = texts_pieces(edited)
    own = owner < n
    a = digest[own], owner[own]
    later = owner > 0
    b = digest[later], owner[later] - 1
    mine, changed = sketch(digest, owner, n + 1, BASE), sketch(*e, n, BASE)
    with np.errstate(over="ignore"):
        to_edited = [x[:n] - y for x, y in zip(mine, changed)]
        to_next = [x[:n] - x[1:] for x in mine]
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array(render([x[:n] for x in mine]), pa.string()), pa.array(render(changed), pa.string()),
        pa.array(likeness(a, e, n, to_edited)), pa.array(likeness(a, b, n, to_next))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprint every text and its edited version, and compare.

    Null text is empty.  Rows are ordered by id (nulls first), equal ids by
    text; repeated rows are separate documents.  The next of the last is the
    first (a single document is its own next).  Empty tables give no rows.
    """
    from pyspark.sql import functions as F

    rows = with_copies(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "doc_id", "text")
    if rows is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, part = 0, None
        for b in T.slices(batches, "text", limit=T.SLICE_BYTES // 2):
            for i, t, p, copy in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "_part", "_copy"))):
                if copy:
                    if ids:     # the first copy is the successor of the part's last row
                        yield _compare(ids, texts, t)
                        ids, texts, size = [], [], 0
                    continue
                if size >= T.SLICE_BYTES // 2 and p == part:
                    yield _compare(ids, texts, t)
                    ids, texts, size = [], [], 0
                part = p
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            raise RuntimeError("a part has no successor row")

    return rows.mapInArrow(run, SCHEMA)
