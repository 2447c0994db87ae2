"""Operator 8: document quality from a linear-chain CRF over lines.

Every line gets features of itself and of its two neighbours; a two-state
chain (bad, good) has a weight per feature and state and a weight per
transition.  It is fitted on a bounded sample of labelled rows, whose lines
take the label of their document, by maximum conditional likelihood
(forward-backward gradients).  A document's quality is the mean of its lines'
forward-backward marginals of *good*, weighted by their lengths, and a
logistic curve fitted on the same sample turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import text as T

#: Bounds of the training sample: rows of each label, lines of a row (of longer rows, as many in hashed runs).
SAMPLE_ROWS = 2500
SAMPLE_LINES = 200
RUNS = 5
FEATURES = ("one", "length", "upper", "digit", "symbol", "space", "repeat", "word_length", "symbol_ends", "marked_words",
            "distinct", "same_as_last", "blank", "wide")
OWN = len(FEATURES)
WIDTH = 3 * OWN - 2      # the constant once
_KIND = np.zeros(256, np.uint8)
for _c in range(256):
    _KIND[_c] = (1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else 4 if _c in (9, 11, 12, 13, 32) else 5 if _c >= 128 else 0 if 97 <= _c <= 122
                 else 6 if _c in (44, 46, 39, 34, 45, 40, 41, 59, 58, 63) else 3)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features of each line, line counts of the texts, line lengths).

    Lines end at line breaks; a text has one line more than it has breaks."""
    n = len(data)
    docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    per_doc = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    starts = np.empty(len(ends), np.int64)
    first = np.cumsum(per_doc) - per_doc
    starts[1:] = ends[:-1] + 1
    starts[first] = offsets[:-1]
    size = ends - starts
    kind = _KIND[data]
    word = kind != 4
    word &= data != 10
    cum = lambda m: np.concatenate([[0], np.cumsum(m, dtype=np.int64)])
    share = lambda c: c[ends] - c[starts]
    total = np.maximum(size, 1)
    upper, digit, symbol, space = (share(cum(kind == k)) for k in (1, 2, 3, 4))
    letters = np.maximum(upper + share(cum(kind == 0)), 1)
    # Words: runs without white space, cut at text ends.
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    edge = offsets[:-1][(offsets[:-1] < n)]
    begin[edge] = word[edge]
    w_start = np.flatnonzero(begin)
    stop = word.copy()
    stop[:-1] &= ~word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stop[last] = word[last]
    w_end = np.flatnonzero(stop) + 1
    w_line = np.searchsorted(ends, w_start, "left")
    words = np.bincount(w_line, minlength=len(ends))
    count = np.maximum(words, 1)
    h = T.span_hash(data, w_start, w_end - w_start)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (w_line[1:] == w_line[:-1])
    mean = lambda m: np.bincount(w_line, m, len(ends)) / count
    ends_symbol = kind[w_end - 1] == 3 if len(w_end) else np.zeros(0, bool)
    marked = ends_symbol & (w_end - w_start > 1)
    lone = ends_symbol & (w_end - w_start == 1)
    order = np.lexsort((h, w_line))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w_line[order][1:] != w_line[order][:-1])
    distinct = np.bincount(w_line[order][new], minlength=len(ends)) / count
    l_hash = T.span_hash(data, starts, size)
    same = np.zeros(len(ends), bool)
    same[1:] = l_hash[1:] == l_hash[:-1]
    same[first] = False
    out = np.stack([
        np.ones(len(ends)), np.log1p(size) / 5, upper / letters, digit / total, symbol / total * 4, space / total * 3, mean(again),
        np.minimum(np.bincount(w_line, w_end - w_start, len(ends)) / count, 20) / 10, mean(lone), mean(marked),
        distinct, same.astype(float), (size == 0).astype(float), (share(cum(kind == 5)) / total)], axis=1)
    return out, per_doc, size


def with_neighbours(own: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
    first = np.cumsum(per_doc) - per_doc
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    after[first + per_doc - 1] = 0
    return np.concatenate([own, before[:, 1:], after[:, 1:]], axis=1)


def marginals(unary: np.ndarray, trans: np.ndarray, per_doc: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once, longest first.

    Returns each line's marginals (n, 2) and, with line weights, the weighted
    sum of expected transitions (2, 2)."""
    n, docs = len(unary), len(per_doc)
    first = np.cumsum(per_doc) - per_doc
    order = np.argsort(-per_doc, kind="stable")
    start, size = first[order], per_doc[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if docs else np.zeros(0, np.int64)
    peak = unary.max(axis=1, keepdims=True)
    e, t = np.exp(unary - peak), np.exp(trans)
    fore, back, scale = np.zeros((n, 2)), np.ones((n, 2)), np.ones(n)
    for k, m in enumerate(active):
        at = start[:m] + k
        f = e[at] if k == 0 else (fore[at - 1] @ t) * e[at]
        s = f.sum(axis=1)
        fore[at], scale[at] = f / s[:, None], s
    pairs = np.zeros((2, 2))
    for k in range(len(active) - 1, 0, -1):
        at = start[: active[k]] + k
        right = back[at] * e[at] / scale[at][:, None]
        back[at - 1] = right @ t.T
        if weight is not None:
            pairs += t * ((fore[at - 1] * weight[at][:, None]).T @ right)
    both = fore * back
    return both / both.sum(axis=1, keepdims=True), pairs


def fit(x: np.ndarray, per_doc: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights (WIDTH, 2), transitions (2, 2)) by Adam on the
    conditional likelihood; every chain's lines have the label ``y``."""
    w, t = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    label = np.repeat(y, per_doc)
    line_weight = np.repeat(weight / per_doc, per_doc)
    truth = np.eye(2)[label]
    links = np.zeros((2, 2))
    for c in (0, 1):
        links[c, c] = (weight * (per_doc - 1) / per_doc)[y == c].sum()
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    total = weight.sum()
    for k in range(1, rounds + 1):
        # a chain counts by its mean line: a long document weighs no more than a short one
        p, pairs = marginals(x @ w, t, per_doc, line_weight)
        gw = x.T @ ((truth - p) * line_weight[:, None]) / total - ridge * w
        gt = (links - pairs) / total - ridge * t
        for g, param, (m, v) in ((gw, w, state[:2]), (gt, t, state[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            param += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return w, t


def document_quality(data: np.ndarray, offsets: np.ndarray, w: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Length-weighted mean marginal of *good* of each text."""
    own, per_doc, size = line_features(data, offsets)
    if not len(per_doc):
        return np.zeros(0)
    p, _ = marginals(with_neighbours(own, per_doc) @ w, t, per_doc)
    first = np.cumsum(per_doc) - per_doc
    weight = size + 1e-6
    return np.add.reduceat(p[:, 1] * weight, first) / np.add.reduceat(weight, first)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve (Newton, lightly regularised)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((y - p) * weight * x).sum() - 1e-2 * a, ((y - p) * weight).sum()])
        r = p * (1 - p) * weight
        hess = np.array([[(r * x * x).sum() + 1e-2, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        a, b = a + np.clip(step[0], -2, 2), b + np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def _logit(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def runs_of(lines: int, seed: int) -> list[tuple[int, int]]:
    """All lines of a text as one run (first, end), or of one with more than
    ``SAMPLE_LINES`` a run at a hashed place of each of ``RUNS`` equal parts."""
    if lines <= SAMPLE_LINES:
        return [(0, lines)]
    size, part = SAMPLE_LINES // RUNS, lines / RUNS
    place = T.mix64((np.arange(RUNS) + (seed & 0xFFFFFFFF)).astype(np.uint64)) / 2.0**64
    first = (part * np.arange(RUNS) + place * (part - size)).astype(np.int64)
    return [(a, a + size) for a in first.tolist()]


def train(docs: DataFrame, labels: DataFrame, fit_on: Column, text: str = "text", id_col: str = "doc_id",
          label: str = "quality", rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """(weights, transitions, slope, intercept) from a bounded sample of the
    labelled rows that ``fit_on`` (over the id) admits; None without rows of
    both labels."""
    # Rates are those of the rows that can be drawn: labels of documents that are there.
    known = (labels.filter(F.col(label).isin(0, 1) & fit_on).groupBy(id_col).agg(F.max(label).cast("int").alias("_y"))
             .join(docs.select(id_col), id_col, "left_semi"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit("quality"), id_col), F.lit(1_000_000)) / 1_000_000
    rate = F.when(F.col("_y") == 1, min(1.0, rows / counts[1])).otherwise(min(1.0, rows / counts[0]))
    # The sample is bounded, so it may be broadcast to where the texts are.
    chosen = F.broadcast(known.filter(draw < rate).select(F.col(id_col).alias("_id"), "_y"))
    docs = docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("text"))
    # Rows of a repeated id count as one, so the sample is bounded by documents.
    sample = docs.join(chosen, F.col("_doc") == F.col("_id")).groupBy("_id", "_y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).select(
        "text", "_y", F.xxhash64(F.lit("lines"), "_id").alias("_seed"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text"):
            own, per_doc, size = line_features(*T.utf8(b.column("text")))
            one, two, runs = [], [], []
            for k, e, seed in zip(per_doc.tolist(), np.cumsum(per_doc).tolist(), b.column("_seed").to_pylist()):
                parts = runs_of(k, seed)
                at = np.concatenate([np.arange(max(s - 1, 0), min(z + 1, k)) for s, z in parts]) + e - k     # each run and the lines around it
                one.append(own[at].astype("<f4").tobytes())
                two.append(size[at].astype("<i4").tobytes())
                runs.append(np.array([(s > 0, z - s, z < k) for s, z in parts], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.binary()), pa.array(two, pa.binary()), pa.array(runs, pa.binary()), b.column("_y")], ["own", "size", "runs", "_y"])

    got = sample.mapInArrow(features, "own binary, size binary, runs binary, _y int").toArrow()
    if len(set(got["_y"].to_pylist())) < 2:
        return None
    packed, sizes, y = got["own"].to_pylist(), got["size"].to_pylist(), np.asarray(got["_y"]).astype(np.int64)
    order = sorted(range(len(y)), key=lambda k: (y[k], packed[k]))     # the same model whatever the order of arrival
    own = np.concatenate([np.frombuffer(packed[k], "<f4").reshape(-1, OWN) for k in order]).astype(np.float64)
    y = y[order]
    # Each run is a chain; the lines around it only give its first and last line their neighbours.
    runs = [np.frombuffer(got["runs"][k].as_py(), "<i4").reshape(-1, 3) for k in order]
    chains = np.array([len(r) for r in runs])
    before, per_run, after = np.concatenate(runs).astype(np.int64).T
    inner = np.ones(len(own), bool)
    edge = np.cumsum(before + per_run + after)
    inner[(edge - 1)[after > 0]] = False
    inner[(edge - before - per_run - after)[before > 0]] = False
    x = with_neighbours(own, before + per_run + after)[inner]
    w, t = fit(x, per_run, np.repeat(y, chains), np.repeat(1 / chains, chains))     # a document weighs 1, whatever its runs
    p, _ = marginals(x @ w, t, per_run)
    size = np.concatenate([np.frombuffer(sizes[k], "<i4") for k in order])[inner] + 1e-6
    per_doc = np.add.reduceat(per_run, np.cumsum(chains) - chains)
    first = np.cumsum(per_doc) - per_doc
    q = np.add.reduceat(p[:, 1] * size, first) / np.add.reduceat(size, first)
    # each label weighs as much as the other: the score is no matter of how rare bad documents are
    balance = np.where(y == 1, 1 / max((y == 1).sum(), 1), 1 / max((y == 0).sum(), 1)) * len(y) / 2
    return w, t, *logistic(_logit(q), y.astype(float), balance)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float, float] | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the quality score (0 to 1) appended; null text is empty,
    an empty text is one empty line.  Without a model every score is 0.5.  An
    older column of that name is replaced."""
    docs = docs.drop(name)
    from pyspark.sql.types import DoubleType, StructField, StructType

    w, t, slope, intercept = model or (np.zeros((WIDTH, 2)), np.zeros((2, 2)), 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, text):
            q = document_quality(*T.utf8(T.text_column(b, text)), w, t)
            s = 1 / (1 + np.exp(-np.clip(slope * _logit(q) + intercept, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
