"""Operator 2: exact set-similarity join of word shingles, with components.

Sets of 4-word shingles link when 100 * intersection >= 85 * union.  The join
leans on relations between sets at three levels:

*Equal sets* are one node.

*Index lists skip blocks.*  In a prefix index a set's shingles are ordered rare
first, and two linked sets must share one of their first
n - ceil(0.85 n) + 1.  Each list (the sets that share a prefix shingle) is
sorted by size and position and cut into blocks; a block's sizes and positions
bound how much its sets can share with another block's from this shingle on, and
block pairs that cannot reach the threshold are skipped.

*Highly similar sets derive their answers.*  First every set meets only the
*hub* of each of its lists, the set with the fewest rarer shingles (among near
copies, the one closest to their common source), and is compared with it exactly.
Sets so linked form a class; whatever links a member finds belong to the whole
class, so two sets of one class never meet again, and only sets of different
classes go through the lists' blocks.  So a large group of near copies costs its
size, not its square.

Any fixed order of shingles gives the same links.  The one used needs the
document frequency of every shingle only roughly: counts over all documents
in a hashed table, whose size follows the corpus up to ``MAX_BUCKETS``.
Shingles are 64-bit hashes of their words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm import text as T
from sluice.llm.graph import components
from sluice.session import materialize

K = 4
#: Bounds of the frequency table (four bytes each in a task, one when broadcast) and of the id filter (bits).
MIN_BUCKETS, MAX_BUCKETS = 1 << 16, 1 << 22
MAX_FILTER_BITS = 1 << 28
#: Entries of a list block.
LIST_BLOCK = 64
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_MIX = T.mix64(np.arange(max(K, 1)) + (1 << 50)) | _U(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (UTF-8 bytes, offsets)."""
    low = _LOWER[data]
    word = ~_GAP[low]
    n = len(low)
    begin, stop = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    heads = offsets[:-1][offsets[:-1] < n]
    begin[heads] = word[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = word[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    h = T.span_hash(low, starts, ends - starts)
    upto = np.searchsorted(starts, offsets)
    out = []
    with np.errstate(over="ignore"):
        rolling = np.zeros(0, _U)
        if len(h) >= K:
            rolling = h[: len(h) - K + 1] * _MIX[0]
            for k in range(1, K):
                rolling += h[k: len(h) - K + 1 + k] * _MIX[k]
            rolling = T.mix64(rolling)
        for a, z in zip(upto[:-1].tolist(), upto[1:].tolist()):
            if z - a >= K:
                out.append(np.unique(rolling[a: z - K + 1]))
            elif z > a:
                out.append(T.mix64(np.array([(h[a:z] * _MIX[: z - a]).sum() + _U(z - a)])))
            else:
                out.append(np.zeros(0, _U))
    return out


def nodes(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit identity of each set."""
    with np.errstate(over="ignore"):
        return T.mix64(np.array([T.mix64(s ^ _U(0x5bd1e995)).sum(dtype=_U) + _U(len(s)) for s in sets], _U)).astype(np.int64)


def signature(s: np.ndarray) -> bytes:
    """A bit for each shingle, in the power of two next to the set's size; half
    as long a signature is the OR of its halves."""
    bits = 1 << max(6, (len(s) - 1).bit_length())
    held = np.zeros(bits, bool)
    held[(s & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(held).tobytes()


def may_link(n_a: int, a: bytes, n_b: int, b: bytes, percent: int) -> bool:
    """Whether two sets can link by their signatures: each bit that one has alone is a shingle that it has alone."""
    size = min(len(a), len(b))
    one, two = (np.bitwise_or.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0) for x in (a, b))
    overlap = min(n_a - int(np.bitwise_count(one & ~two).sum()), n_b - int(np.bitwise_count(two & ~one).sum()))
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def _summaries(docs: DataFrame, buckets: int) -> DataFrame:
    """Per row: doc_id, n, node, signature.  Per task also its part of the
    frequency table: chunk and zipped counts."""
    shift = _U(64 - (buckets.bit_length() - 1))
    chunk = min(buckets, MIN_BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "node", "bits", "chunk", "counts"]
        counts = None
        for b in T.slices(batches, "text"):
            sets = shingle_sets(*T.utf8(T.text_column(b, "text")))
            if counts is None:
                counts = np.zeros(buckets, np.uint32)
            flat = np.concatenate(sets)
            np.add.at(counts, (flat >> shift).astype(np.int64), np.uint32(1))
            m = len(sets)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array(nodes(sets)),
                pa.array([signature(x) if len(x) else None for x in sets], pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if counts is not None:
            k = buckets // chunk
            yield pa.RecordBatch.from_arrays([
                pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                pa.array(range(k), pa.int32()), pa.array([zlib.compress(counts[a: a + chunk].astype(np.uint64).tobytes(), 1) for a in range(0, buckets, chunk)], pa.binary())], names)

    return docs.mapInArrow(run, "doc_id long, n int, node long, bits binary, chunk int, counts binary")


def _levels(summaries: DataFrame, buckets: int) -> np.ndarray:
    """Rank of each bucket's count on a logarithmic scale, one byte each.  The
    tasks' parts are summed in two steps, so no group holds a part of every task."""
    def total(pdf: pd.DataFrame) -> np.ndarray:
        out = np.zeros(1, np.uint64)
        for c in pdf["counts"]:
            out = out + np.frombuffer(zlib.decompress(c), np.uint64)
        return out

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": pdf["chunk"][:1], "counts": [zlib.compress(total(pdf).tobytes(), 1)]})

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": pdf["chunk"][:1], "levels": [np.minimum(np.log2(total(pdf) + 1.0) * 6, 255).astype(np.uint8).tobytes()]})

    parts = summaries.filter("chunk is not null").select("chunk", "counts")
    some = parts.groupBy("chunk", F.pmod(F.xxhash64("counts"), F.lit(8))).applyInPandas(add, "chunk int, counts binary")
    rows = some.groupBy("chunk").applyInPandas(level, "chunk int, levels binary").collect()
    return np.frombuffer(b"".join(bytes(r["levels"]) for r in sorted(rows, key=lambda r: r["chunk"])), np.uint8) if rows else np.zeros(buckets, np.uint8)


def _needed(size: np.ndarray, percent: int) -> np.ndarray:
    return -(-size * percent // 100)


def _entries(docs: DataFrame, levels, buckets: int, percent: int) -> DataFrame:
    """Prefix index: token, node, n, pos.  A task gives each node once."""
    shift = _U(64 - (buckets.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = levels.value, set()
        for b in T.slices(batches, "text"):
            sets = shingle_sets(*T.utf8(T.text_column(b, "text")))
            token, who, size, pos = [], [], [], []
            for s, node in zip(sets, nodes(sets).tolist()):
                if not len(s) or node in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(node)
                first = len(s) - int(_needed(len(s), percent)) + 1
                key = rank[(s >> shift).astype(np.int64)].astype(_U) << _U(56) | s >> _U(8)
                token.append(s[np.argsort(key)[:first]])
                pos.append(np.arange(first, dtype=np.int32))
                who.append(np.full(first, node))
                size.append(np.full(first, len(s), np.int32))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).astype(np.int64)), pa.array(np.concatenate(who)),
                                                  pa.array(np.concatenate(size)), pa.array(np.concatenate(pos))], ["token", "node", "n", "pos"])

    return docs.mapInArrow(run, "token long, node long, n int, pos int")


def list_pairs(node: np.ndarray, cls: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one index list that size, position and class admit; the list
    is sorted by size, then position."""
    m = len(node)
    n, pos = n.astype(np.int64), pos.astype(np.int64)
    starts = np.arange(0, m, LIST_BLOCK)
    n_low, n_high = n[starts], np.maximum.reduceat(n, starts)
    # The first shingle that two linked sets share has all the others behind it in
    # both: its place is at most the set's size less the overlap they need.
    slack = np.maximum.reduceat(n - pos, starts)
    # Blocks of one and the same class hold no pair to look at.
    c_low, c_high = np.minimum.reduceat(cls, starts), np.maximum.reduceat(cls, starts)

    def needed(sizes):
        return -(-sizes * percent // (100 + percent))

    for i, a in enumerate(starts.tolist()):
        least = needed(n_low[i] + n_low[i:])
        open_ = (n_low[i:] * percent <= n_high[i] * 100) & (slack[i] >= least) & (slack[i:] >= least)
        open_ &= (c_low[i] != c_high[i]) | (c_low[i:] != c_low[i]) | (c_high[i:] != c_high[i])
        x = np.arange(a, min(a + LIST_BLOCK, m))
        for j in (np.flatnonzero(open_) + i).tolist():
            y = np.arange(starts[j], min(starts[j] + LIST_BLOCK, m))
            small, large = n[x][:, None], n[y][None, :]
            overlap = needed(small + large)
            good = (np.maximum(small, large) * percent <= np.minimum(small, large) * 100) & ((n[x] - pos[x])[:, None] >= overlap) & ((n[y] - pos[y])[None, :] >= overlap)
            good &= cls[x][:, None] != cls[y][None, :]
            if i == j:
                good &= x[:, None] < y[None, :]
            p, q = np.nonzero(good)
            if len(p):
                one, two = node[x[p]], node[y[q]]
                yield np.minimum(one, two), np.maximum(one, two)


def _hub_round(entries: DataFrame, percent: int) -> DataFrame:
    """The index lists of two sets or more (``token``, ``node``, ``n``, ``pos``)
    and, in rows of their own, the pairs (``a``, ``b``) of each list's hub.

    A list's entries come in order of their position, so its first is the hub:
    the set that holds the fewest rarer shingles, hence the one with the least
    of its own among near copies.  Nothing but the hub is held."""
    names = ["token", "node", "n", "pos", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None            # (token, node, n, pos) of the current list, whether it was given out, and the last node
        for batch in batches:
            token, node, n, pos = (np.asarray(batch.column(c)) for c in names[:4])
            if not len(token):
                continue
            given, last = False, None
            if hub is not None:
                row, given, last = hub
                token, node, n, pos = (np.concatenate([[x], y]) for x, y in zip(row, (token, node, n, pos)))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])          # a set given by several tasks
            if last is not None and len(token) > 1 and token[1] == token[0] and node[1] == last:
                new[1] = False
            tail = int(node[-1])
            token, node, n, pos = token[new], node[new], n[new].astype(np.int64), pos[new].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            count = np.diff(np.append(first, len(token)))
            h = np.repeat(first, count)
            many = np.repeat(count > 1, count)
            out = many.copy()
            if given:
                out[0] = False
            if out.any():
                k = int(out.sum())
                yield pa.RecordBatch.from_arrays([pa.array(token[out]), pa.array(node[out]), pa.array(n[out].astype(np.int32)), pa.array(pos[out].astype(np.int32)),
                                                  pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names)
            overlap = -(-(n + n[h]) * percent // (100 + percent))
            good = ((np.arange(len(token)) != h) & (np.maximum(n, n[h]) * percent <= np.minimum(n, n[h]) * 100)
                    & (n - pos >= overlap) & (n[h] - pos[h] >= overlap) & (node != node[h]))
            if good.any():
                pairs = _pair_batch([np.minimum(node[good], node[h[good]])], [np.maximum(node[good], node[h[good]])])
                k = pairs.num_rows
                yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()),
                                                  pairs.column("a"), pairs.column("b")], names)
            f = int(first[-1])
            hub = ((token[f], node[f], n[f], pos[f]), bool(count[-1] > 1) or (given and f == 0), tail)

    return (entries.repartition("token").sortWithinPartitions("token", "pos", "node")
            .mapInArrow(run, "token long, node long, n int, pos int, a long, b long"))


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of the index lists; rows come sorted by token, size, position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush(cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            token, node, cls, n, pos = cols
            cut = np.concatenate([[0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]])
            a, b, total = [], [], 0
            for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if e - s < 2:
                    continue
                for x, y in list_pairs(node[s:e], cls[s:e], n[s:e], pos[s:e], percent):
                    a.append(x)
                    b.append(y)
                    total += len(x)
                    if total > 200_000:
                        yield _pair_batch(a, b)
                        a, b, total = [], [], 0
            if a:
                yield _pair_batch(a, b)

        for batch in batches:
            cols = tuple(np.asarray(batch.column(c)) for c in ("token", "node", "cls", "n", "pos"))
            if not len(cols[0]):
                continue
            held.append(cols)
            if sum(len(h[0]) for h in held) >= 50_000 and held[0][0][0] != cols[0][-1]:     # all but the last list are whole
                whole = tuple(np.concatenate(c) for c in zip(*held))
                last = int(np.flatnonzero(whole[0] != whole[0][-1])[-1]) + 1
                yield from flush(tuple(c[:last] for c in whole))
                held = [tuple(c[last:] for c in whole)]
        if held:
            yield from flush(tuple(np.concatenate(c) for c in zip(*held)))

    return lists.mapInArrow(run, "a long, b long")


def _pair_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    one, two = np.concatenate(a), np.concatenate(b)
    keep = np.unique(T.mix64(one.astype(_U)) ^ T.mix64(two.astype(_U) + _U(1)), return_index=True)[1]
    return pa.RecordBatch.from_arrays([pa.array(one[keep]), pa.array(two[keep])], ["a", "b"])


def _bit_table(ids: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """(bits, table) with a bit for the hash of each id: a bounded filter that
    lets all ids pass that are there, and few others."""
    count = ids.count()
    bits = min(MAX_FILTER_BITS, 1 << max(15, (16 * count - 1).bit_length()))
    table = np.zeros(bits // 8, np.uint8)
    rows = (ids.select(F.pmod(F.xxhash64(column), F.lit(bits)).alias("p")).groupBy(F.floor(F.col("p") / 32768).alias("k"))
            .agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect())
    for r in rows:
        at = int(r["k"]) * 4096
        table[at: at + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits, table


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes (stored; a, b) whose sets link, compared exactly.

    The sets' signatures drop most other pairs before any text moves.  Texts of
    the nodes then left, one for each, are filtered by a bit table of
    their ids (bounded; it only saves work) and joined to the pairs."""
    spark = docs.sparkSession
    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b"))
            keep = [k for k, x in enumerate(zip(*cols)) if may_link(*x, percent)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).take(pa.array(keep, pa.int64()))

    # Both sets of each pair meet their signatures in one join; the pairs are the small side.
    both = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(classes.select("node", "n", "bits"), "node")
    one = lambda c: F.max(F.when(F.col("node") == F.col(c), F.struct("n", "bits")))
    met = both.groupBy("a", "b").agg(one("a").alias("x"), one("b").alias("y"))
    pairs = materialize(met.select("a", "b", F.col("x.n").alias("n_a"), F.col("x.bits").alias("bits_a"), F.col("y.n").alias("n_b"), F.col("y.bits").alias("bits_b"))
                        .mapInArrow(possible, "a long, b long"), "possible-pairs")
    wanted = materialize(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
                         .join(classes.select("node", "rep"), "node"), "wanted")
    if wanted.isEmpty():
        return pairs.limit(0)
    bits, table = _bit_table(wanted, "rep")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    shared = spark.sparkContext.broadcast(table)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in T.slices(batches, "text"):
            p = np.asarray(b.column("_place"))
            hit = np.flatnonzero(own[p >> 3] >> (p & 7).astype(np.uint8) & 1)
            if not len(hit):
                continue
            part = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text")], ["doc_id", "text"]).take(pa.array(hit))
            text = T.text_column(part, "text")
            node = nodes(shingle_sets(*T.utf8(text)))
            yield pa.RecordBatch.from_arrays([pa.array(node), part.column("doc_id"), text], ["node", "rep", "text"])

    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    texts = (docs.withColumn("doc_id", key).withColumn("_place", place("doc_id")).mapInArrow(chosen, "node long, rep long, text string")
             # joined on the node alone: the grouping and the pairs below use the same partitioning
             .join(wanted.withColumnRenamed("rep", "wanted_rep"), "node").where("rep = wanted_rep")
             .groupBy("node").agg(F.first("text").alias("text")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text_a", "text_b"):
            one, two = (shingle_sets(*T.utf8(T.text_column(b, c))) for c in ("text_a", "text_b"))
            keep = []
            for k, (x, y) in enumerate(zip(one, two)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(k)
            if keep:
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).take(pa.array(keep))

    return (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long"))


def memberships(docs: DataFrame, percent: int = 85, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``n``, ``node`` of every row; ``node``, ``component``,
    ``component_id`` of every set).  Rows without shingles have ``n`` 0."""
    spark = docs.sparkSession
    docs = _plain(docs, text, id_col)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    # About 128 shingles a bucket, at six characters a word.
    buckets = 1 << min(MAX_BUCKETS.bit_length() - 1, max(MIN_BUCKETS.bit_length() - 1, (chars // 768).bit_length()))
    summaries = materialize(_summaries(docs, buckets), "shingle-sets")
    sets = summaries.filter("n > 0")
    low = F.coalesce("doc_id", F.lit(-(1 << 63)))
    classes = materialize(sets.groupBy("node").agg(F.min(low).alias("rep"), F.min("doc_id").alias("smallest"), F.first("n").alias("n"),
                                                   F.first("bits").alias("bits")), "set-classes")

    # The prefix index, without the tokens that one set has alone; every set meets its lists' hubs.
    levels = spark.sparkContext.broadcast(_levels(summaries, buckets))
    indexed = materialize(_hub_round(_entries(docs, levels, buckets, percent), percent), "index-lists")
    hubs = materialize(indexed.filter("a is not null").select("a", "b").distinct(), "hub-pairs")
    entries = indexed.filter("token is not null").select("token", "node", "n", "pos")

    # What then is in one class meets no more.
    w = Window.partitionBy("token")
    ordered = lambda df: df.select("token", "node", "cls", "n", "pos").sortWithinPartitions("token", "n", "pos", "node")
    groups = materialize(components(_verified(hubs, docs, classes, percent)), "classes")
    mixed = (entries.join(groups, "node", "left").withColumn("cls", F.coalesce("component", "node"))
             .withColumn("x", F.min("cls").over(w)).withColumn("y", F.max("cls").over(w)).filter("x <> y"))
    pairs = materialize(_candidates(ordered(mixed), percent).distinct(), "candidate-pairs")
    links = materialize(_verified(pairs, docs, classes, percent).unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))), "links")

    whole = components(links)
    member = classes.select("node", "smallest").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = member.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return summaries.filter("n is not null").select("doc_id", "n", "node"), member.join(smallest, "component").select("node", "component", "component_id")


def _plain(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def similar_sets(docs: DataFrame, percent: int = 85, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable
    by links, its own included) of every row.

    Texts without words, empty and null ones have no shingles and no links.
    Repeated rows and equal sets are one node of the join; a component's id is
    the smallest non-null id in it (null if it has none).
    """
    rows, sets = memberships(docs, percent, text, id_col)
    size = F.col("n").cast("long").alias("n_shingles")
    alone = rows.filter("n = 0").select("doc_id", size, F.col("doc_id").alias("component_id"))
    return rows.filter("n > 0").join(sets, "node").select("doc_id", size, "component_id").unionByName(alone)


def keep_one(docs: DataFrame, percent: int = 85, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of
    equal ids, one).  Rows without shingles stay.  Columns are unchanged.

    Most rows never leave their partition: only those whose id is that of a
    row that goes (by a bounded bit table) are joined to the ids that go."""
    rows, sets = memberships(docs, percent, text, id_col)
    low = F.coalesce("doc_id", F.lit(-(1 << 63)))
    counted = rows.filter("n > 0").groupBy(low.alias("id"), "node").agg(F.count(F.lit(1)).alias("copies")).join(sets, "node")
    best = counted.groupBy("component").agg(F.min(F.struct("id", "node")).alias("best"))
    marks = materialize(counted.join(best, "component").select("id", "node", (F.struct("id", "node") == F.col("best")).alias("stays"), "copies")
                        .filter("not stays or copies > 1"), "duplicates")
    if marks.isEmpty():
        return docs
    bits, table = _bit_table(marks, "id")
    shared = docs.sparkSession.sparkContext.broadcast(table)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    names = docs.columns
    ident, node, place, stays = T.fresh(docs, "_id", "_node", "_place", "_stays")

    def split(suspects: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for b in T.slices(batches, text):
                p = np.asarray(b.column(place))
                hit = (own[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
                part = b.take(pa.array(np.flatnonzero(hit == suspects)))
                cols = [part.column(c) for c in names]
                if part.num_rows and suspects:
                    found = shingle_sets(*T.utf8(T.text_column(part, text)))
                    empty = np.array([not len(x) for x in found])
                    yield pa.RecordBatch.from_arrays([*cols, part.column(ident), pa.array(nodes(found), mask=empty)], [*names, ident, node])
                elif part.num_rows:
                    yield pa.RecordBatch.from_arrays(cols, names)

        return run

    from pyspark.sql.types import LongType, StructField, StructType

    placed = docs.withColumn(ident, key).withColumn(place, F.pmod(F.xxhash64(ident), F.lit(bits)))
    clear = placed.mapInArrow(split(False), docs.schema)
    checked = placed.mapInArrow(split(True), StructType([*docs.schema.fields, StructField(ident, LongType()), StructField(node, LongType())]))
    checked = checked.join(marks.select(F.col("id").alias(ident), F.col("node").alias(node), F.col("stays").alias(stays)), [ident, node], "left")
    single = checked.filter(F.col(stays).isNull()).select(*names)
    repeated = checked.filter(F.col(stays)).dropDuplicates([ident, node]).select(*names)
    return clear.unionByName(single).unionByName(repeated)
