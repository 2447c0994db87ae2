"""Operator 11: ranked lexical search by multi-query common-subexpression evaluation.

1. The items (queries) form groups of bounded size; a group's distinct terms
   are the vocabulary of a pass over the documents, which keeps each
   document's length and its counts of vocabulary terms (a small table), and
   from which N, L and the document frequencies are summed.
2. One task mines a group's term sets.  Terms that the same items hold are one
   shared set, a leaf of the graph; leaves and sets that two or more items
   hold together are merged, the most frequent pair first, into inner nodes,
   and every item ends as the sum of two nodes.  Each partial sum that several
   items share thus stands in the graph once.
3. Tasks take documents in strips: a strip's term scores are summed into one
   accumulator row per leaf, every inner row is the sum of its two parents,
   level by level, and an item's row holds its scores.  The best ten of each
   item travel from strip to strip, and those of all tasks meet in a window.

All numbers of the ranking are whole (the weights come from one logarithm per
term), so adding in any grouping gives the same scores.

Null texts and texts without a term count for nothing; a document without an
id takes part in the counts and is never returned.  Rows of one id are ranked
as separate documents.  Items with no text or no term return nothing, items
with a repeated id are ranked each for itself, an empty table gives no rows.
Very long texts are tokenised piece by piece, so a task holds little more than
the text itself.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.text import SLICE_BYTES, mix64, slices, span_hash, text_column, utf8
from sluice.session import materialize

TOP = 10
#: Distinct terms of a group of items at about; cells of a strip's accumulators.
GROUP_TERMS = 1 << 17
STRIP_CELLS = 1 << 22
#: Shared sets that pairwise merging looks at (the most frequent; the others enter their items directly).
MERGED_SETS = 512
EMPTY = "item_id long, rank int, doc_id long, score long"
_EXACT = 2**53

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _TERM[_a:_b] = True


def term_hashes(data: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, hash) of the terms of one byte array, piece by piece.  A term
    longer than a piece is hashed over its pieces' hashes."""
    at = 0
    while at < len(data):
        to = min(at + limit, len(data))
        if to < len(data):
            gap = np.flatnonzero(~_TERM[data[at:to]])
            if len(gap):
                to = at + int(gap[-1]) + 1
            else:       # one long term from here on, or no end yet
                end = to
                parts = [span_hash(_LOWER[data[at:end]], [0], [end - at])]
                while end < len(data):
                    more = data[end: end + limit]
                    gap = np.flatnonzero(~_TERM[more])
                    size = int(gap[0]) if len(gap) else len(more)
                    if size:
                        parts.append(span_hash(_LOWER[more[:size]], [0], [size]))
                    end += size
                    if len(gap):
                        break
                yield np.array([at]), mix64(span_hash(np.frombuffer(np.concatenate(parts).tobytes(), np.uint8), [0], [8 * len(parts)]))
                at = end
                continue
        piece = data[at:to]
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = _TERM[piece]
        edge = np.diff(inside)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        yield start + at, span_hash(_LOWER[piece], start, stop - start)
        at = to


def _documents(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, term hash) of a slice of texts."""
    data, off = utf8(col)
    if len(col) == 1 or not len(data):
        for start, h in term_hashes(data):
            yield np.zeros(len(start), np.int64), h
        return
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _TERM[data]
    cut = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    edge = np.diff(inside)
    joined = cut[inside[cut] & inside[cut + 1] == 1]         # a term ends and another starts where texts meet
    start = np.union1d(np.flatnonzero(edge == 1), joined)
    stop = np.union1d(np.flatnonzero(edge == -1), joined)
    yield np.searchsorted(off, start, "right") - 1, span_hash(_LOWER[data], start, stop - start)


def item_terms(items: DataFrame, text: str, id_col: str) -> DataFrame:
    """(item row, item id, distinct term hashes) of the items that have a term."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            hashes: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for k, h in _documents(text_column(batch, text)):
                first = np.flatnonzero(np.diff(k, prepend=-1))
                for j, mine in zip(k[first].tolist(), np.split(h, first[1:])):
                    hashes[j].append(np.unique(mine))
            found = [np.unique(np.concatenate(h)).view(np.int64) if h else np.zeros(0, np.int64) for h in hashes]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column(id_col), pa.array(found, pa.list_(pa.int64()))], ["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias(id_col), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(terms, "item long, item_id long, terms array<long>").filter(F.size("terms") > 0)


def sharing_graph(sets: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """The graph of sets of term numbers: (leaf of each term, levels, end node
    of each item, number of nodes).  ``levels`` are arrays of (left, right) whose nodes are
    numbered on after the leaves.

    Terms held by the same items make one leaf.  Then the pair of nodes that
    most items hold together becomes a node, as long as two items hold one.
    """
    holders: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        for t in s.tolist():
            holders.setdefault(t, []).append(k)
    leaf_of: dict[tuple[int, ...], int] = {}
    leaf = np.zeros(max(holders, default=-1) + 1, np.int64)
    for t in sorted(holders):
        leaf[t] = leaf_of.setdefault(tuple(holders[t]), len(leaf_of))
    owns: list[set[int]] = [set() for _ in sets]
    for who, node in leaf_of.items():
        for k in who:
            owns[k].add(node)
    held: dict[int, set[int]] = {node: set(who) for who, node in leaf_of.items()}
    depth = dict.fromkeys(held, 0)
    pairs: list[tuple[int, int, int]] = []

    def join(a: int, b: int, who: set[int]) -> int:
        node = len(depth)
        depth[node] = 1 + max(depth[a], depth[b])
        pairs.append((node, a, b))
        for k in who:
            owns[k] -= {a, b}
            owns[k].add(node)
        for x in (a, b):
            held[x] -= who
        held[node] = set(who)
        return node

    shared = sorted((n for n in held if len(held[n]) > 1), key=lambda n: (-len(held[n]), n))[:MERGED_SETS]
    alive = set(shared)
    together: Counter = Counter()
    for o in owns:
        mine = sorted(o & alive)
        together.update((a, b) for i, a in enumerate(mine) for b in mine[i + 1:])
    buckets: dict[int, set[tuple[int, int]]] = {}
    for p, n in together.items():
        if n > 1:
            buckets.setdefault(n, set()).add(p)

    def move(p: tuple[int, int], by: int) -> None:
        old, together[p] = together[p], together[p] + by
        if old > 1:
            buckets[old].discard(p)
        if together[p] > 1:
            buckets.setdefault(together[p], set()).add(p)

    most = max(buckets, default=0)
    while most > 1:
        if not buckets.get(most):
            most -= 1
            continue
        a, b = min(buckets[most])
        who = held[a] & held[b]
        node = None
        before = {k: owns[k] & alive for k in who}
        node = join(a, b, who)
        alive.add(node)
        for k, mine in before.items():
            others = mine - {a, b}
            move((a, b), -1)
            for x in others:
                move((min(a, x), max(a, x)), -1)
                move((min(b, x), max(b, x)), -1)
                move((x, node), 1)
    ends = np.full(len(sets), -1, np.int64)
    done: dict[tuple[int, ...], int] = {}
    for k, o in enumerate(owns):
        if not o:
            continue
        key = tuple(sorted(o))
        if key not in done:
            rest = sorted(o, key=lambda n: (depth[n], n))
            while len(rest) > 1:      # a balanced sum of what is left
                rest = [join(rest[i], rest[i + 1], {k}) if i + 1 < len(rest) else rest[i] for i in range(0, len(rest), 2)]
            done[key] = rest[0]
        ends[k] = done[key]
    # Nodes by level, so that one vector addition makes a level.
    inner = sorted(pairs, key=lambda p: (depth[p[0]], p[0]))
    place = np.arange(len(depth))
    place[[p[0] for p in inner]] = len(leaf_of) + np.arange(len(inner))
    levels, level = [], 0
    for node, a, b in inner:
        if depth[node] != level:
            level = depth[node]
            levels.append([])
        levels[-1].append((place[a], place[b]))
    return leaf, [np.array(x, np.int64) for x in levels], np.where(ends >= 0, place[ends], -1), len(depth)


class Group:
    """A group of items: vocabulary, graph, and the items' end nodes."""

    def __init__(self, items: np.ndarray, ids: list, terms: list[np.ndarray]) -> None:
        self.items, self.ids = items, ids
        self.vocabulary = np.unique(np.concatenate(terms).view(np.uint64))
        self.leaf, self.levels, self.ends, self.nodes = sharing_graph([np.searchsorted(self.vocabulary, t.view(np.uint64)) for t in terms])

    def additions(self) -> int:
        return sum(len(x) for x in self.levels)

    def scores(self, docs: np.ndarray, n_docs: int, terms: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """Scores (item, document) of a strip from its (document, term, gain) triples."""
        held = np.zeros((self.nodes, n_docs), np.int64)
        leaves = int(self.leaf.max()) + 1
        cell = self.leaf[terms] * n_docs + docs
        if len(gains) and float(np.abs(gains).sum(dtype=np.float64)) < _EXACT:
            held[:leaves] = np.bincount(cell, gains, leaves * n_docs).astype(np.int64).reshape(leaves, n_docs)
        else:
            np.add.at(held[:leaves].reshape(-1), cell, gains)
        at = leaves
        for level in self.levels:
            np.add(held[level[:, 0]], held[level[:, 1]], out=held[at: at + len(level)])
            at += len(level)
        return held[self.ends]


def postings(documents: DataFrame, vocabulary: np.ndarray, text: str, id_col: str) -> DataFrame:
    """Each document with a term: its length ``n``, and the numbers and counts of its vocabulary terms."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        # The leading bits of the hash first: most terms of a text are not asked for.
        bits = max(16, min(26, 4 + int(size).bit_length()))
        shift = np.uint64(64 - bits)
        known = np.zeros(1 << bits, bool)
        known[words >> shift] = True
        for batch in slices(batches, text):
            n = np.zeros(batch.num_rows, np.int64)
            keys = []
            for k, h in _documents(text_column(batch, text)):
                n += np.bincount(k, minlength=batch.num_rows)
                maybe = np.flatnonzero(known[h >> shift])
                place = np.searchsorted(words, h[maybe])
                hit = words[np.minimum(place, size - 1)] == h[maybe]
                part, times = np.unique(k[maybe][hit] * size + place[hit], return_counts=True)
                keys.append(np.stack([part, times]))
            every = np.concatenate(keys, axis=1) if keys else np.zeros((2, 0), np.int64)
            if len(keys) > 1:
                part, where = np.unique(every[0], return_inverse=True)
                every = np.stack([part, np.bincount(where, every[1], len(part)).astype(np.int64)])
            off = np.searchsorted(every[0], np.arange(batch.num_rows + 1) * size).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(x)) for x in ((every[0] % size).astype(np.int32), every[1])]
            out = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(n > 0))

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>")


def best(items: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each item: highest scores, then smallest ids."""
    order = np.lexsort((ids, -scores, items))
    sorted_items = items[order]
    first = np.flatnonzero(np.diff(sorted_items, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
    return order[rank < k]


def _ranked(table: DataFrame, group: Group, weights: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast((group, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, weights = shared.value
        strip = max(1, STRIP_CELLS // max(group.nodes, 1))
        kept = [np.zeros(0, np.int64)] * 3
        least = np.ones(len(group.items), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, strip):
                part = batch.slice(a, strip)
                ids, n = np.asarray(part.column("doc_id")), np.asarray(part.column("n"))
                lists = part.column("terms")
                docs = np.repeat(np.arange(len(ids)), np.asarray(lists.value_lengths()))
                terms, times = np.asarray(lists.flatten()), np.asarray(part.column("times").flatten())
                if not len(terms):
                    continue
                wide = 90 * int(n.max()) * total >= 2**63 or 10**9 * int(times.max()) >= 2**63
                kind = object if wide else np.int64
                m = 10 + (90 * n.astype(kind) * total) // length
                gains = (weights[terms] * ((10**9 * times.astype(kind)) // (1000 * times.astype(kind) + 8 * m[docs]))).astype(np.int64)
                scores = group.scores(docs, len(ids), terms, gains)
                item, doc = np.nonzero(scores >= least[:, None])
                if not len(item):
                    continue
                kept = [np.concatenate([x, y]) for x, y in zip(kept, (item, ids[doc], scores[item, doc]))]
                stay = best(*kept, k)
                kept = [x[stay] for x in kept]
                full = np.bincount(kept[0], minlength=len(least)) >= k
                low = np.full(len(least), np.iinfo(np.int64).max)
                np.minimum.at(low, kept[0], kept[2])
                least = np.where(full, np.maximum(low, 1), 1)
        if len(kept[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.items[kept[0]]), pa.array([group.ids[j] for j in kept[0].tolist()], pa.int64()), pa.array(kept[1]), pa.array(kept[2])],
                ["item", "item_id", "doc_id", "score"])

    return table.filter((F.size("terms") > 0) & F.col("doc_id").isNotNull()).mapInArrow(search, "item long, item_id long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", id_col: str = "doc_id",
           item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of every item's k best documents.

    Items are taken in groups of about ``GROUP_TERMS`` terms; each group is
    one pass over the texts and one over their counts.
    """
    spark = documents.sparkSession
    asked = materialize(item_terms(items, item_text, item_id), "item-terms")
    size = asked.agg(F.sum(F.size("terms"))).first()[0]
    if not size:
        return spark.createDataFrame([], EMPTY)
    groups = -(-size // GROUP_TERMS)
    found = None
    for g in range(groups):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).orderBy("item_id", "item").collect()
        if not rows:
            continue
        group = Group(np.array([r["item"] for r in rows], np.int64), [r["item_id"] for r in rows], [np.array(r["terms"], np.int64) for r in rows])
        table = materialize(postings(documents, group.vocabulary, text, id_col), "postings")
        total, length = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = {r[0]: r[1] for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(group.vocabulary))], np.int64)
        if not total:
            continue
        part = _ranked(table, group, weights, total, length, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], EMPTY)
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


