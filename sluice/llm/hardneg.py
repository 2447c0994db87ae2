"""Operator 12: hard negatives by spanning-tree bounds between anchors.

Vectors become integers, floor(256 x), and lie in vertical blocks beside each
other, written once by the tasks that read them (no shuffle).  The anchors
form groups of at most ``ANCHORS``; one task spans a group with a minimum tree
(edge: distance of two anchors).  Groups go to the blocks in rounds of checked
size; the blocks do not move.

In a block the scores of all candidates at the tree's root are computed.
Down an edge of length d they change by at most d times a candidate's norm, so
every candidate has an interval of scores at the next anchor, and only those
are scored there whose interval overlaps the window that is asked for:

* positives: rows of the anchor's label, scores from the k-th best so far up;
* negatives: rows of other labels, scores inside the window of one of the
  anchor's positives, from its k-th best so far up.

A candidate that is not scored keeps its interval for the anchors below.  The
best of all blocks of a task, then of all tasks, are the answer; it is exact.

Rows with a null id, label or vector, or a null or non-finite component, and
empty vectors take no part; vectors of different lengths are never compared.
Rows of a repeated id are anchors and candidates each for itself (an anchor
skips only its own row).  Components and scores beyond a long take its nearest
value.  Tables without an anchor give no rows.
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

BLOCK = 4096
ANCHORS = 512
#: Bytes of anchors that are sent to all blocks at once.
ROUND_BYTES = 32 << 20
EMPTY = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
BLOCKS = "dim int, part long, kind string, ids binary, labels binary, rows binary, data binary"
TREES = "dim int, tree long, kind string, ids binary, labels binary, rows binary, data binary, parent binary"
_LONG = np.iinfo(np.int64)
_EXACT = float(2**53)


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x) of doubles as 64-bit integers."""
    y = np.floor(x.astype(np.float64) * 256)
    out = np.where(np.abs(y) < 2.0**63, y, 0).astype(np.int64)
    out[y >= 2.0**63] = _LONG.max
    out[y < -(2.0**63)] = _LONG.min
    return out


def packed(dim: int, part: int, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, grid: np.ndarray) -> dict:
    """Rows (as ``grid``, row by row) as one vertical block in the narrowest integers."""
    low, high = grid.min(initial=0), grid.max(initial=0)
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return {"dim": dim, "part": part, "kind": kind, "ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i8").tobytes(),
            "rows": rows.astype("<i8").tobytes(), "data": np.ascontiguousarray(grid.T.astype(kind)).tobytes()}


def opened(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, rows, grid by dimension) of a block."""
    ids, labels, rows = (np.frombuffer(r[c], "<i8") for c in ("ids", "labels", "rows"))
    return ids, labels, rows, np.frombuffer(r["data"], r["kind"]).reshape(r["dim"], -1)



def blocks(vectors: DataFrame, vector: str, id_col: str, label_col: str) -> DataFrame:
    """The rows that take part, in blocks of at most ``BLOCK`` rows of one dimension."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        names = ["dim", "part", "kind", "ids", "labels", "rows", "data"]

        def out(dim: int) -> pa.RecordBatch:
            ids, labels, rows, grid = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
            return pa.RecordBatch.from_pylist([packed(dim, int(rows[0]), ids, labels, rows, grid)], schema=schema)

        schema = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("kind", pa.string()), *((c, pa.binary()) for c in names[3:])])
        for batch in batches:
            batch = batch.filter(pa.array(np.asarray(batch.column("v").is_valid()) & np.asarray(batch.column("id").is_valid()) & np.asarray(batch.column("label").is_valid())))
            if not batch.num_rows:
                continue
            lists = batch.column("v")
            size = np.asarray(lists.value_lengths(), np.int64)
            flat = lists.flatten()
            values = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64)
            owner = np.repeat(np.arange(len(size)), size)
            bad = np.unique(owner[~np.isfinite(values) | np.asarray(flat.is_null())])
            good = size > 0
            good[bad] = False
            start = np.cumsum(size) - size
            ids, labels, rows = (np.asarray(batch.column(c)) for c in ("id", "label", "row"))
            for dim in np.unique(size[good]).tolist():
                at = np.flatnonzero(good & (size == dim))
                grid = whole(values[start[at][:, None] + np.arange(dim)])
                waiting.setdefault(dim, []).append((ids[at], labels[at], rows[at], grid))
                if sum(len(x[0]) for x in waiting[dim]) + 2000 > BLOCK:
                    yield out(dim)
        for dim in list(waiting):
            yield out(dim)

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.monotonically_increasing_id().alias("row"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(build, BLOCKS)


def span(grid: np.ndarray) -> np.ndarray:
    """Parent of each row in a minimum spanning tree of the rows (-1: root),
    with rows numbered so that a parent comes before its children: returns
    (order, parent by place in that order) stacked."""
    n = len(grid)
    points = grid.astype(np.float64)
    square = np.einsum("ij,ij->i", points, points)
    near, link = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    at = int(np.argmin(square)) if n else 0
    root = at
    for _ in range(n - 1):
        left[at] = False
        d = square + square[at] - 2 * (points @ points[at])
        closer = left & (d < near)
        near[closer], link[closer] = d[closer], at
        at = int(np.argmin(np.where(left, near, np.inf)))
        if not left[at]:      # distances beyond a double
            at = int(np.flatnonzero(left)[0])
            link[at] = root
        children[link[at]].append(at)
    order, parent, place = [], [], {}
    walk = [root] if n else []
    while walk:       # depth first: only the sums of one path are held at a time
        x = walk.pop()
        place[x] = len(order)
        parent.append(place[link[x]] if link[x] >= 0 and x != root else -1)
        order.append(x)
        walk.extend(reversed(children[x]))
    return np.stack([np.array(order, np.int64), np.array(parent, np.int64)])


def trees(stored: DataFrame, every: int) -> DataFrame:
    """Anchors (rows whose id is divisible by ``every``) in spanning trees of at most ``ANCHORS``."""
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels, rows, grid = opened(r)
                at = np.flatnonzero(ids % every == 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at), r["dim"], np.int32)), pa.array(ids[at]), pa.array(labels[at]), pa.array(rows[at]),
                        pa.array([x.tobytes() for x in np.ascontiguousarray(grid[:, at].T.astype("<i8"))], pa.binary())], ["dim", "id", "label", "row", "v"])

    asked = stored.mapInArrow(anchors, "dim int, id long, label long, row long, v binary")
    groups = F.ceil(F.col("anchors") * 5 / F.lit(4 * ANCHORS))
    sizes = asked.groupBy(F.col("dim").alias("dim_")).agg(F.count(F.lit(1)).alias("anchors"))
    dealt = asked.join(sizes, F.col("dim") == F.col("dim_")).withColumn("group", F.pmod(F.xxhash64("row"), groups))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        made = []
        for a in range(0, len(pdf), ANCHORS):
            part = pdf.iloc[a: a + ANCHORS]
            grid = np.stack([np.frombuffer(v, "<i8") for v in part["v"]])
            order, parent = span(grid)
            r = packed(int(key[0]), 0, *(part[c].to_numpy(np.int64)[order] for c in ("id", "label", "row")), grid[order])
            made.append(r | {"tree": int(part["row"].iloc[0]), "parent": parent.astype("<i8").tobytes()})
        return pd.DataFrame(made)[["dim", "tree", "kind", "ids", "labels", "rows", "data", "parent"]]

    return dealt.groupBy("dim", "group").applyInPandas(grow, TREES)


class Walk:
    """One block under one tree: yields, for each anchor, the candidates that a
    window leaves open, with their exact scores."""

    def __init__(self, cand: np.ndarray, anchors: np.ndarray, parent: np.ndarray) -> None:
        top = float(np.abs(cand.astype(np.float64)).max(initial=0)) * float(np.abs(anchors.astype(np.float64)).max(initial=0)) * len(cand)
        self.big = top >= _EXACT
        self.parent = parent
        if self.big:          # whole numbers of any size, no intervals
            self.cand, self.anchors = cand.astype(object), anchors.astype(object)
            return
        self.cand, self.anchors = cand.astype(np.float64), anchors.astype(np.float64)
        # The slack covers the rounding of norms and distances; scores are exact.
        self.norm = np.sqrt((self.cand**2).sum(axis=0)) * (1 + 1e-9)
        up = self.anchors - self.anchors[np.maximum(parent, 0)]
        self.edge = np.sqrt((up**2).sum(axis=1)) * (1 + 1e-9)
        self.last = np.zeros(len(parent), np.int64)      # last place that needs an anchor's intervals
        np.maximum.at(self.last, parent[1:], np.arange(1, len(parent)))
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def intervals(self, a: int) -> tuple[np.ndarray, np.ndarray] | None:
        """(lowest, highest) score of each candidate at anchor ``a``; None: not known."""
        if self.big or self.parent[a] < 0:
            return None
        low, high = self.open[self.parent[a]]
        reach = self.edge[a] * self.norm + 1
        return low - reach, high + reach

    def score(self, a: int, at: np.ndarray, bounds: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """Exact scores of the candidates ``at`` (all of them are scored when there are no bounds)."""
        if self.big:
            return np.array([min(max(int(x), _LONG.min), _LONG.max) for x in self.anchors[a] @ self.cand[:, at]], np.int64)
        n = self.cand.shape[1]
        if bounds is None or 3 * len(at) > n:
            every = self.anchors[a] @ self.cand
            low = high = every
            found = every[at]
            self.scored += n
        else:
            found = self.anchors[a] @ self.cand[:, at]
            low, high = bounds
            low[at] = high[at] = found
            self.scored += len(at)
        if self.last[a]:
            self.open[a] = (low, high)
        p = self.parent[a]
        if p >= 0 and self.last[p] == a:
            del self.open[p]
        return found.astype(np.int64)


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest scores, then smallest ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], ~scores[some]))[:k]]
    return np.lexsort((ids, ~scores))[:k]


def kth(values: np.ndarray, k: int) -> float:
    """The k-th highest value, or minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


class Best:
    """The k best rows seen so far for each of many questions."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows: dict[int, tuple[np.ndarray, ...]] = {}

    def floor(self, q: int) -> float:
        held = self.rows.get(q)
        return float(held[0][-1]) if held is not None and len(held[0]) >= self.k else -np.inf

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(scores):
            return
        held = self.rows.get(q)
        if held is not None:
            scores, ids, rows = (np.concatenate(x) for x in zip(held, (scores, ids, rows)))
        at = ranked(scores, ids, self.k)
        self.rows[q] = (scores[at], ids[at], rows[at])


def positives_of(block: dict, tree: dict, best: Best) -> int:
    """Add a block's best rows of each anchor's own label; returns the scores computed."""
    ids, labels, rows, cand = opened(block)
    _, a_label, a_row, anchors = opened(tree)
    walk = Walk(cand, np.ascontiguousarray(anchors.T), np.frombuffer(tree["parent"], "<i8"))
    for a in range(len(a_row)):
        same = np.flatnonzero((labels == a_label[a]) & (rows != a_row[a]))
        bounds = walk.intervals(a)
        if bounds is not None and len(same):
            floor = max(best.floor(a), kth(bounds[0][same], best.k))
            same = same[bounds[1][same] >= floor]
        scores = walk.score(a, same, bounds)
        best.add(a, scores, ids[same], rows[same])
    return getattr(walk, "scored", 0)


def windows_of(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """For each positive score p: the whole scores s with low*p <= 100*s <= high*p."""
    return [(-(-low * p // 100), high * p // 100) for p in scores]


def negatives_of(block: dict, tree: dict, wanted: dict[int, list[tuple[int, int, int]]], best: Best) -> int:
    """Add a block's best rows inside the windows; ``wanted`` has (question, lowest, highest) of each anchor."""
    ids, labels, rows, cand = opened(block)
    _, a_label, _, anchors = opened(tree)
    walk = Walk(cand, np.ascontiguousarray(anchors.T), np.frombuffer(tree["parent"], "<i8"))
    for a in range(len(a_label)):
        asked = [w for w in wanted.get(a, ()) if w[1] <= w[2]]
        other = np.flatnonzero(labels != a_label[a]) if asked else np.zeros(0, np.int64)
        bounds = walk.intervals(a)
        if bounds is not None and len(other):
            low, high = bounds[0][other], bounds[1][other]
            overlap = np.zeros(len(other), bool)
            for q, least, most in asked:
                inside = (low >= least) & (high <= most)
                floor = max(best.floor(q), kth(low[inside], best.k), least)
                overlap |= (high >= floor) & (low <= most)
            other = other[overlap]
        scores = walk.score(a, other, bounds)
        for q, least, most in asked:
            at = np.flatnonzero((scores >= least) & (scores <= most))
            best.add(q, scores[at], ids[other[at]], rows[other[at]])
    return getattr(walk, "scored", 0)


FOUND_POSITIVES = ("tree", "place", "anchor_id", "anchor_row", "score", "id", "row")
FOUND_NEGATIVES = ("anchor_row", "p_rank", "anchor_id", "positive_id", "positive_score", "negative_score", "negative_id", "row")


def _found(questions: list[tuple], answers: list[tuple], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Answers as a batch: the questions' own columns, then (score, id, row)."""
    if not questions:
        return
    who = np.repeat(np.arange(len(answers)), [len(x[0]) for x in answers])
    own = [np.array(c, np.int64)[who] for c in zip(*questions)]
    got = [np.concatenate(c) for c in zip(*answers)]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*own, *got)], list(names))


def _rounds(table: DataFrame, every_bytes: int) -> list[DataFrame]:
    """The rows dealt into parts of at most ``every_bytes`` of data, by checked sums."""
    size = F.sum(F.length("data") + F.length("ids") * 4)
    total = table.agg(size).first()[0] or 0
    parts = max(1, -(-total // every_bytes))
    while True:
        part = F.pmod(F.xxhash64("dim", "tree"), F.lit(parts))
        sizes = [(r[0], r[1], r[2]) for r in table.groupBy(part).agg(size, F.count(F.lit(1))).collect()]
        if all(b <= every_bytes or n == 1 for _, b, n in sizes):
            return [table.filter(part == p) for p, _, _ in sizes]
        parts *= 2


def _sent(part: DataFrame) -> Broadcast:
    """The trees of a round by dimension, for every task."""
    by_dim: dict[int, list[dict]] = {}
    for r in part.collect():
        by_dim.setdefault(r["dim"], []).append(r.asDict(True))
    return part.sparkSession.sparkContext.broadcast(by_dim)


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         vector: str = "embedding", id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same
    label, the ``negatives`` best rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's."""
    spark = vectors.sparkSession
    stored = materialize(blocks(vectors, vector, id_col, label_col), "vector-blocks")
    grown = materialize(trees(stored, every), "anchor-trees")
    if grown.isEmpty():
        return spark.createDataFrame([], EMPTY)

    def best_positives(sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, Best] = {}
            for r in (r for batch in batches for r in batch.to_pylist()):
                for t in sent.value.get(r["dim"], ()):
                    positives_of(r, t, best.setdefault(t["tree"], Best(positives)))
            for t in (t for every_dim in sent.value.values() for t in every_dim if t["tree"] in best):
                ids, _, rows, _ = opened(t)
                rows_of = best[t["tree"]].rows
                yield from _found([(t["tree"], a, ids[a], rows[a]) for a in rows_of], list(rows_of.values()), FOUND_POSITIVES)
        return run

    found = None
    for part in _rounds(grown, ROUND_BYTES):
        some = stored.mapInArrow(best_positives(_sent(part)), ", ".join(f"{c} long" for c in FOUND_POSITIVES))
        found = some if found is None else found.unionByName(some)
    w = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), "id", "row")
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= positives)
    # A tree's windows are at most ANCHORS times ``positives`` rows.
    sought = best.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("place", "rank", "anchor_row", "anchor_id", "id", "score"))).alias("sought"))
    asked = materialize(grown.join(sought, "tree"), "negative-windows")

    def best_negatives(sent: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, Best] = {}
            wanted: dict[int, dict[int, list]] = {}
            for t in (t for every_dim in sent.value.values() for t in every_dim):
                best[t["tree"]], places = Best(negatives), wanted.setdefault(t["tree"], {})
                for q, (s, (a, b)) in enumerate(zip(t["sought"], windows_of([s["score"] for s in t["sought"]], low, high))):
                    places.setdefault(s["place"], []).append((q, a, b))
            for r in (r for batch in batches for r in batch.to_pylist()):
                for t in sent.value.get(r["dim"], ()):
                    negatives_of(r, t, wanted[t["tree"]], best[t["tree"]])
            for t in (t for every_dim in sent.value.values() for t in every_dim):
                rows_of = best[t["tree"]].rows
                own = [tuple(t["sought"][q][c] for c in ("anchor_row", "rank", "anchor_id", "id", "score")) for q in rows_of]
                yield from _found(own, list(rows_of.values()), FOUND_NEGATIVES)
        return run

    found = None
    for part in _rounds(asked, ROUND_BYTES):
        some = stored.mapInArrow(best_negatives(_sent(part)), ", ".join(f"{c} long" for c in FOUND_NEGATIVES))
        found = some if found is None else found.unionByName(some)
    w = Window.partitionBy("anchor_row", "p_rank").orderBy(F.col("negative_score").desc(), "negative_id", "row")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
