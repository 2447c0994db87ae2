"""Operator 10: exact top-k inner products by columnar branch-and-bound.

Vectors become integers, floor(256 x).  All rows are stored in blocks of about
``BLOCK`` rows in vertical layout (dimension by dimension); the query rows are
taken from these into blocks of ``QUERIES``.  A block of candidates accumulates
each query's scores a few dimensions at a time.  After each step the mass that
remains bounds what a candidate can still gain (Cauchy-Schwarz: the norm of the
query's dimensions left times that of the candidate's), and the candidates that
cannot reach the query's k-th best any more are compacted away.  The first k-th
best of a task comes from finishing the most promising candidates at once; it
is carried from block to block.  The k best of each task meet in a window per query.

Candidates stay where they are stored.  The query blocks go to them in rounds
of at most ``ROUND_BYTES``, by checked sums; each round reads the blocks once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import materialize

BLOCK = 8192
QUERIES = 512
STEP = 16
#: Bytes of query blocks that are sent to all candidate blocks at once.
ROUND_BYTES = 16 << 20
EMPTY = "query_id long, rank int, vec_id long, score long"
_EXACT = float(2**53)


def usable(vectors: DataFrame, vector: str, id_col: str) -> DataFrame:
    """Rows that take part: ``vec_id``, integer components ``v``, ``dim``.
    Components beyond a long's range take its nearest value."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"), F.size(vector).alias("dim")))


def _block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of a group as one vertical block."""
    pdf = pdf.sort_values("vec_id", kind="stable")
    grid = np.stack(pdf["v"].to_numpy()).astype(np.int64) if len(pdf) else np.zeros((0, 0), np.int64)
    low, high = grid.min(initial=0), grid.max(initial=0)
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    row = pdf["row"].to_numpy(np.int64) if "row" in pdf else np.arange(len(pdf)) + (int(key[1]) << 32)
    return pd.DataFrame({"dim": [int(key[0])], "block": [int(key[1])], "kind": [kind], "ids": [pdf["vec_id"].to_numpy("<i8").tobytes()],
                         "rows": [row.astype("<i8").tobytes()], "data": [np.ascontiguousarray(grid.T.astype(kind)).tobytes()]})


BLOCKS = "dim int, block long, kind string, ids binary, rows binary, data binary"


def _open(dim: int, kind: str, ids: bytes, rows: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(rows, "<i8"), np.frombuffer(data, kind).reshape(dim, -1)


def block_top(cand: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int,
              floors: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, candidate places, scores) of the k best candidates of a block
    for each query; ``cand`` is (dimensions, rows), ``queries`` (queries, dimensions).
    Candidates that score below a query's floor may be left out."""
    dim, n = cand.shape
    top = float(np.abs(cand.astype(np.float64)).max(initial=0)) * float(np.abs(queries.astype(np.float64)).max(initial=0)) * dim
    if top >= _EXACT:      # beyond exact floating point: whole numbers of any size
        big, limit = cand.astype(object), np.iinfo(np.int64)
        for q in range(len(queries)):
            score = np.array([min(max(int(x), limit.min), limit.max) for x in queries[q].astype(object) @ big], np.int64)
            alive = np.flatnonzero(rows != own[q])
            order = alive[np.lexsort((ids[alive], -score[alive].astype(object)))][:k] if len(alive) else alive
            yield q, order, score[order]
        return
    cand, queries = cand.astype(np.float64), queries.astype(np.float64)
    cuts = [*range(0, dim, STEP), dim]
    mass = np.stack([np.sqrt((cand[z:] ** 2).sum(axis=0)) for z in cuts[1:]])
    for a in range(0, len(queries), 64):
        begun = queries[a: a + 64, : cuts[1]] @ cand[: cuts[1]]
        for q in range(a, min(a + 64, len(queries))):
            x = queries[q]
            alive = np.flatnonzero(rows != own[q])
            score = begun[q - a][alive]
            floor = -np.inf if floors is None else floors[q]
            for s, z in enumerate(cuts[1:]):
                if s:
                    score = score + x[cuts[s]: z] @ cand[cuts[s]: z, alive]
                if z == dim or not len(alive) or (floor == -np.inf and len(alive) <= k):
                    continue
                if floor == -np.inf and len(alive) > k:
                    lead = np.argpartition(-score, k - 1)[:k]
                    floor = (score[lead] + x[z:] @ cand[z:, alive[lead]]).min()
                # The slack covers the rounding of the norms; scores themselves are exact.
                keep = score + np.sqrt(x[z:] @ x[z:]) * mass[s][alive] * (1 + 1e-9) + 1 >= floor
                alive, score = alive[keep], score[keep]
            best = np.lexsort((ids[alive], -score))[:k]
            yield q, alive[best], score[best].astype(np.int64)


class Best:
    """The k best of each query of a block so far, over many candidate blocks."""

    def __init__(self, n: int, k: int) -> None:
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.zeros((n, k), np.int64)
        self.held = np.zeros(n, np.int64)

    def floors(self) -> np.ndarray:
        return np.where(self.held == self.score.shape[1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.held[q]
        scores, ids = np.concatenate([self.score[q, :n], scores]), np.concatenate([self.ids[q, :n], ids])
        # ~x turns the order of whole numbers round, the lowest one included.
        at = np.lexsort((ids, ~scores))[: self.score.shape[1]]
        self.held[q] = len(at)
        self.score[q, : len(at)], self.ids[q, : len(at)] = scores[at], ids[at]


def rounds(asked: DataFrame, every_bytes: int) -> list[DataFrame]:
    """Query blocks dealt into parts of at most ``every_bytes`` (or of a single block)."""
    size = F.sum(F.length("data") + 16 * F.length("ids"))
    parts = max(1, -(-(asked.agg(size).first()[0] or 0) // every_bytes))
    while True:
        part = F.pmod(F.xxhash64("dim", "block"), F.lit(parts))
        sizes = asked.groupBy(part).agg(size, F.count(F.lit(1))).collect()
        if all(b <= every_bytes or n == 1 for _, b, n in sizes):
            return [asked.filter(part == p) for p, _, _ in sizes]
        parts *= 2


def _sent(part: DataFrame) -> Broadcast:
    """The query blocks of a round by dimension, for every task."""
    by_dim: dict[int, list] = {}
    for r in part.collect():
        by_dim.setdefault(r["dim"], []).append(r.asDict())
    return part.sparkSession.sparkContext.broadcast(by_dim)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """The k highest integer inner products of each query (rows whose id is
    divisible by ``every``) with every other row of the same dimension:
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller id.

    Rows with a null id, a null vector, or null or non-finite components take
    no part.  Rows with a repeated id are separate queries and candidates (a
    query skips only its own row).  Scores beyond a long take its nearest value.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vector, id_col).filter("dim > 0")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], EMPTY)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-n // BLOCK))))
    blocks = materialize(rows.groupBy("dim", "block").applyInPandas(_block, BLOCKS), "vector-blocks")

    def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, row, data = _open(r["dim"], r["kind"], r["ids"], r["rows"], r["data"])
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    v = np.ascontiguousarray(data[:, at].T.astype(np.int64))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), r["dim"], np.int32)), pa.array(ids[at]), pa.array(row[at]),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, r["dim"]), pa.int32()), pa.array(v.ravel()))],
                        ["dim", "vec_id", "row", "v"])

    asked = blocks.mapInArrow(query_rows, "dim int, vec_id long, row long, v array<long>")
    groups = max(1, -(-asked.count() // QUERIES))
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(groups)))
                        .groupBy("dim", "block").applyInPandas(_block, BLOCKS), "query-blocks")
    if asked.isEmpty():
        return spark.createDataFrame([], EMPTY)

    def searching(sent: Broadcast):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_, best = {}, {}
            for r in (r for b in batches for r in b.to_pylist()):
                dim = r["dim"]
                if dim not in open_:
                    open_[dim] = [_open(dim, *(q[c] for c in ("kind", "ids", "rows", "data"))) for q in sent.value.get(dim, ())]
                    best[dim] = [Best(len(ids), k) for ids, _, _ in open_[dim]]
                ids, row, cand = _open(dim, r["kind"], r["ids"], r["rows"], r["data"])
                for (_, q_row, q), top in zip(open_[dim], best[dim]):
                    for x, at, scores in block_top(cand, ids, row, np.ascontiguousarray(q.T), q_row, k, top.floors()):
                        if len(at):
                            top.add(x, scores, ids[at])
            for dim in open_:
                for (q_ids, q_row, _), top in zip(open_[dim], best[dim]):
                    who, at = np.nonzero(np.arange(k) < top.held[:, None])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(who), dim, np.int32)), pa.array(q_row[who]), pa.array(q_ids[who]), pa.array(top.ids[who, at]), pa.array(top.score[who, at])],
                        ["dim", "row", "query_id", "vec_id", "score"])
        return search

    found = None
    for part in rounds(asked, ROUND_BYTES):
        some = blocks.mapInArrow(searching(_sent(part)), "dim int, row long, query_id long, vec_id long, score long")
        found = some if found is None else found.unionByName(some)
    w = Window.partitionBy("dim", "row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
