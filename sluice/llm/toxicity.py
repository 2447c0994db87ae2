"""Operator 6: toxicity by weak supervision.

*Voters.*  Lexicon voters are words and word stems, mined from a bounded sample
of labelled rows: a word (or a stem at least so many times, in words that are no
entries themselves) far likelier in toxic rows, by more than chance explains
however rare it is (false-discovery control over all words tried), and there in
varied company (after many different words), so that
the vocabulary of one much-copied toxic text does not count.  Pattern voters look
at the whole text (several lexicon words, one of them repeated, one at the start,
their density, one in capitals or before an exclamation mark).  A voter votes
*toxic* or abstains.

*Label model.*  Without labels, expectation-maximisation estimates how often
each voter votes on toxic and on clean texts, and the posterior of every
sampled row.  Voters that agree beyond what the latent label explains are
correlated: from the residual correlations under the posterior, each voter's
vote is weighted by one over its sum of positive correlations, and the
estimation is repeated.

*Classifier.*  A linear model over the voters' votes, counts and density is
trained on the posterior labels and gives the score.  Only counts, the
sample's telling words and its sparse votes reach the driver.

Null texts are empty; without toxic and clean sample rows the lexicon is empty
and every score low.  Ties of the lexicon's order go by the entry; equal votes
leave the model the same whatever order they arrive in.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import text as T
from sluice.session import materialize

#: Bound of the training sample (rows of each label); it bounds the lexicon too.
SAMPLE_ROWS = 10_000
#: A lexicon entry: least rows and different words before it, least ratio of its rates, and the share of chance finds among all entries kept.
LEAST_ROWS, LEAST_COMPANY, LEAST_RATIO, FALSE_SHARE = 5, 5, 8.0, 0.01
#: Lengths of stems, and how often a text must hold one.
STEMS = range(4, 10)
TIMES = (2, 3, 4)
PATTERNS = ("any", "two_words", "three_votes", "repeated", "at_start", "dense", "shouted")
WORD = re.compile(r"\w+")


def sample_rows(docs: DataFrame, labels: DataFrame, fit_on: Column, text: str, id_col: str, label: str, rows: int) -> DataFrame:
    """Bounded sample of labelled documents: ``text`` and ``y``.  Rates are those
    of labels that have a document; rows of a repeated id count as one (its
    greatest label, its smallest text), rows without an id or a label not at all."""
    known = (labels.filter(F.col(label).isin(0, 1) & fit_on).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
             .join(docs.select(id_col), id_col, "left_semi"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit("toxic"), id_col), F.lit(1_000_000)) / 1_000_000
    rate = F.when(F.col("y") == 1, min(1.0, rows / counts.get(1, 1))).otherwise(min(1.0, rows / counts.get(0, 1)))
    chosen = F.broadcast(known.filter(draw < rate).select(F.col(id_col).alias("_id"), "y"))   # bounded by 2 * rows
    docs = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return docs.join(chosen, F.col("_doc") == F.col("_id")).groupBy("_id", "y").agg(F.min("text").alias("text")).select("text", "y")


#: (text, least times): a whole word is "word$", a stem "stem".
Lexicon = list[tuple[str, int]]


def stems_of(counts: Counter, known: frozenset[str]) -> dict[tuple[str, int], int]:
    """Stems that a text's words satisfy so many times; ``known`` words do not count."""
    stems: Counter = Counter()
    for w, n in counts.items():
        if w not in known:
            for size in STEMS:
                if len(w) > size:
                    stems[w[:size]] += n
    return {(stem, times): n for stem, n in stems.items() for times in TIMES if n >= times}


def _threshold(evidence: DataFrame) -> float:
    """Least evidence (nats, column ``e`` of all entries tried) at which at most
    ``FALSE_SHARE`` of the entries kept are chance finds (Benjamini-Hochberg)."""
    steps = {r["s"]: r["count"] for r in evidence.groupBy(F.floor(F.least("e", F.lit(200.0)) * 8).alias("s")).count().collect()}
    tried, above, least = sum(steps.values()), 0, np.inf
    for s in sorted(steps, reverse=True):
        above += steps[s]
        if np.exp(-s / 8) * tried <= FALSE_SHARE * above:
            least = s / 8
    return least


def _telling(sample: DataFrame, n1: int, n0: int, known: frozenset[str] | None) -> list[tuple[str, int]]:
    """Whole words (``known`` None), or stems of words not ``known``, that mark
    toxic rows in varied company, the most telling first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of each label that hold each entry, added up by slice."""
        for b in T.slices(batches, "text"):
            rows: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                words = Counter(WORD.findall(t.lower()))
                rows[y].update([(f"{w}$", 1) for w in words] if known is None else stems_of(words, known).keys())
            keys = list(rows[0].keys() | rows[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in keys], pa.string()), pa.array([n for _, n in keys], pa.int32()),
                pa.array([rows[1][k] for k in keys], pa.int64()), pa.array([rows[0][k] for k in keys], pa.int64())], ["entry", "times", "c1", "c0"])

    # Chance that so many of an entry's rows are toxic if it fell on rows of either
    # label alike: at most exp(-e) (Chernoff's bound of the binomial tail).
    share, toxic = F.col("c1") / (F.col("c1") + F.col("c0")), n1 / (n1 + n0)
    e = F.when(share <= toxic, 0.0).otherwise(F.col("c1") * F.log(share / toxic) + F.when(F.col("c0") > 0, F.col("c0") * F.log((1 - share) / (1 - toxic))).otherwise(0.0))
    stats = materialize(sample.mapInArrow(count, "entry string, times int, c1 long, c0 long").groupBy("entry", "times")
                        .agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0")).filter(F.col("c1") >= LEAST_ROWS)
                        .withColumn("p1", F.col("c1") / n1).withColumn("p0", (F.col("c0") + 0.5) / n0).withColumn("e", e), "lexicon-entries")
    gain = F.col("p1") * F.log(F.col("p1") / F.col("p0"))
    kept = stats.filter((F.col("p1") >= LEAST_RATIO * F.col("p0")) & (F.col("e") >= _threshold(stats)))
    ranked = [(r["entry"], r["times"]) for r in kept.orderBy(gain.desc(), "entry", "times").collect()]
    wanted = {e for e, _ in ranked}

    def company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidate entries of toxic rows with the word before each place."""
        for b in T.slices(batches, "text"):
            seen = set()
            for t in b.column("text").to_pylist():
                last = ""
                for w in WORD.findall(t.lower()):
                    for e in (f"{w}$",) if known is None else () if w in known else [w[:size] for size in STEMS if len(w) > size]:
                        if e in wanted:
                            seen.add((e, last))
                    last = w
            yield pa.RecordBatch.from_arrays([pa.array([e for e, _ in seen], pa.string()), pa.array([x for _, x in seen], pa.string())], ["entry", "before"])

    varied = {r["entry"] for r in sample.filter("y = 1").mapInArrow(company, "entry string, before string").groupBy("entry")
              .agg(F.approx_count_distinct("before").alias("n")).filter(F.col("n") >= LEAST_COMPANY).collect()} if wanted else set()
    return [(e, times) for e, times in ranked if e in varied]


def mine_lexicon(sample: DataFrame) -> Lexicon:
    """Entries that mark toxic rows, the most telling first: whole words, each
    for itself, then stems of other words; of stems that extend each other only
    the most telling."""
    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    words = _telling(sample, n1, n0, None)
    stems: Lexicon = []
    taken: set[str] = set()          # chosen stems and all that they begin with
    chosen: set[str] = set()
    for e, times in _telling(sample, n1, n0, frozenset(e[:-1] for e, _ in words)):
        heads = {e[:k] for k in range(1, len(e) + 1)}
        if e not in taken and not heads & chosen:
            stems.append((e, times))
            chosen.add(e)
            taken |= heads
    return words + stems


class Voters:
    """Votes of a lexicon and the patterns on one text."""

    def __init__(self, lexicon: Lexicon):
        self.width = len(lexicon) + len(PATTERNS)
        self.size = len(lexicon)
        self.words = {e[:-1]: k for k, (e, _) in enumerate(lexicon) if e.endswith("$")}
        self.stems = {e: (k, n) for k, (e, n) in enumerate(lexicon) if not e.endswith("$")}
        self.sizes = sorted({len(e) for e in self.stems})

    def __call__(self, text: str) -> tuple[np.ndarray, float, float]:
        """(votes, lexicon words found, their share of all words)."""
        out = np.zeros(self.width, bool)
        low = text.lower()
        words = WORD.findall(low)
        found, stems = {}, {}
        for w, n in Counter(words).items():
            if w in self.words:
                found[w] = n
                out[self.words[w]] = True
            else:
                for size in self.sizes:
                    if w[:size] in self.stems:
                        stems.setdefault(w[:size], []).append((w, n))
        for stem, hits in stems.items():
            k, least = self.stems[stem]
            if sum(n for _, n in hits) >= least:
                out[k] = True
                found |= dict(hits)
        if not found:
            return out, 0.0, 0.0
        total = sum(found.values())
        shout = any(w.upper() in text or f"{w}!" in low for w in found if len(w) > 2)
        out[self.size:] = [True, len(found) >= 2, total >= 3, total > len(found), any(w in found for w in words[:5]), total >= 0.01 * len(words), shout]
        return out, float(total), total / len(words)


class LabelModel:
    """Latent-class model of votes: rates on toxic and clean rows, and weights
    that discount correlated voters."""

    def __init__(self, prior: float, start: np.ndarray | None = None):
        self.prior, self.start = min(max(prior, 0.005), 0.5), start

    def fit(self, v: "Votes | np.ndarray", rounds: int = 30) -> np.ndarray:
        """Posterior of *toxic* for each row of votes."""
        v = v if isinstance(v, Votes) else Votes.of(v)
        n, m = v.rows, v.width
        # Rows with most votes begin as toxic; EM moves from there.  A rare voter
        # begins at its rate among the rows with votes, so that the silence of many says little.
        self.weight = np.ones(m)
        self.p1 = np.clip(v.totals(np.ones(n)) / max((np.diff(v.first) > 0).sum(), 1), 1e-4, 0.3)
        self.p0 = self.p1 / 30
        together = v.pairs()
        for _ in range(3):
            for _ in range(rounds):
                q = self.posterior(v)
                self.p1 = (v.totals(q) + 1) / (q.sum() + 4)
                self.p0 = (v.totals(1 - q) + 0.05) / ((1 - q).sum() + 10)
                self.p1 = np.maximum(self.p1, self.p0)      # a vote never speaks for *clean*
                self.prior = min(max((q.sum() + 1) / (n + 2), 0.001), 0.9)
            q = self.posterior(v)
            # Residual correlations of the voters that ever vote together; others' are not positive.
            yes, no = v.totals(q), v.totals(1 - q)
            qq, qr, rr = (q * q).sum(), (q * (1 - q)).sum(), ((1 - q) ** 2).sum()

            def residual(i, j, both):
                mixed = self.p1[j] * yes[i] + self.p0[j] * no[i] + self.p1[i] * yes[j] + self.p0[i] * no[j]
                model = self.p1[i] * self.p1[j] * qq + (self.p1[i] * self.p0[j] + self.p0[i] * self.p1[j]) * qr + self.p0[i] * self.p0[j] * rr
                return (both - mixed + model) / max(n, 1)

            every = np.arange(m)
            sd = np.sqrt(np.maximum(residual(every, every, yes + no), 1e-9))
            i, j, both = together
            self.correlation = (i, j, residual(i, j, both) / (sd[i] * sd[j]))
            strong = np.where(self.correlation[2] > 0.2, self.correlation[2], 0.0)
            self.weight = 1 / (1 + np.bincount(i, strong, m) + np.bincount(j, strong, m))
        return self.posterior(v)

    def posterior(self, v: "Votes") -> np.ndarray:
        # Abstaining says little: only votes and the voters' joint silence count.
        yes, no = np.log(self.p1 / self.p0), np.log((1 - self.p1) / (1 - self.p0))
        logit = np.log(self.prior / (1 - self.prior)) + v.sums((yes - no) * self.weight) + (no * self.weight).sum()
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


class Votes:
    """Votes of many rows, sparse: the voters of row k are ``voter[first[k]: first[k + 1]]``."""

    def __init__(self, voter: np.ndarray, first: np.ndarray, width: int):
        self.voter, self.first, self.width, self.rows = voter.astype(np.int64), first.astype(np.int64), width, len(first) - 1
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    @classmethod
    def of(cls, v: np.ndarray) -> "Votes":
        row, voter = np.nonzero(v)
        return cls(voter, np.searchsorted(row, np.arange(len(v) + 1)), v.shape[1])

    def sums(self, w: np.ndarray) -> np.ndarray:
        """Sum of the weights of each row's voters."""
        return np.bincount(self.row, w[self.voter], self.rows)

    def totals(self, q: np.ndarray) -> np.ndarray:
        """Sum of the rows' weights of each voter."""
        return np.bincount(self.voter, q[self.row], self.width).astype(np.float64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, rows) of the voters i < j that vote together, offset by offset within the rows."""
        found = np.zeros(0, np.int64)
        rows = np.zeros(0, np.int64)
        size = np.diff(self.first)[self.row] if len(self.row) else np.zeros(0, np.int64)
        place = np.arange(len(self.voter)) - self.first[self.row]
        for step in range(1, int(size.max(initial=1))):
            at = np.flatnonzero(place + step < size)
            key, n = np.unique(self.voter[at] * self.width + self.voter[at + step], return_counts=True)
            found, where = np.unique(np.concatenate([found, key]), return_inverse=True)
            rows = np.bincount(where, np.concatenate([rows, n]), len(found)).astype(np.int64)
        return found // self.width, found % self.width, rows


def extra(found: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Features beside the votes: one, lexicon words found, their share."""
    return np.stack([np.ones(len(found)), np.log1p(found), np.minimum(share * 10, 1)], axis=1)


def linear(v: Votes, x: np.ndarray, q: np.ndarray, rounds: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels (Adam): weights of ``x``, then of the votes."""
    k0 = x.shape[1]
    w, m, s = (np.zeros(k0 + v.width) for _ in range(3))
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:k0] + v.sums(w[k0:]), -30, 30)))
        g = np.concatenate([x.T @ (q - p), v.totals(q - p)]) / max(len(x), 1) - ridge * w
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        w += rate * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.99**k)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, fit_on: Column, text: str = "text", id_col: str = "doc_id",
          label: str = "toxic", rows: int = SAMPLE_ROWS) -> tuple[Lexicon, np.ndarray]:
    """(lexicon, weights of the linear model)."""
    sample = materialize(sample_rows(docs, labels, fit_on, text, id_col, label, rows), "toxic-sample")
    words = mine_lexicon(sample)
    votes = Voters(words)
    width = votes.width

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text"):
            got = [votes(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([np.flatnonzero(v).astype(np.int32) for v, _, _ in got], pa.list_(pa.int32())),
                pa.array([f for _, f, _ in got], pa.float64()), pa.array([s for _, _, s in got], pa.float64()), b.column("y")], ["v", "found", "share", "y"])

    # Bounded by the sample: the few votes of at most ``rows`` documents of each label.
    got = sample.mapInArrow(vote, "v array<int>, found double, share double, y int").toArrow()
    if not got.num_rows:
        return words, np.append([-6.0], np.zeros(width + 2))
    # The same model whatever the order of arrival.
    lists = got["v"].combine_chunks()
    sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    found, share, y = (np.asarray(got[c]).astype(np.float64) for c in ("found", "share", "y"))
    start = np.cumsum(sizes) - sizes
    flat = np.asarray(lists.flatten()).astype(np.int64)
    order = sorted(range(len(y)), key=lambda k: (y[k], share[k], found[k], flat[start[k]: start[k] + sizes[k]].tolist()))
    v = Votes(np.concatenate([flat[start[k]: start[k] + sizes[k]] for k in order]), np.concatenate([[0], np.cumsum(sizes[order])]), width)
    q = LabelModel(float(y.mean())).fit(v)
    return words, linear(v, extra(found[order], share[order]), q)


def score(docs: DataFrame, model: tuple[Lexicon, np.ndarray], text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity score (0 to 1) appended; null text is empty.
    An older column of that name is replaced."""
    docs = docs.drop(name)
    from pyspark.sql.types import DoubleType, StructField, StructType

    words, w = model
    votes = Voters(words)
    width = votes.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, text):
            got = [votes(t) for t in T.text_column(b, text).to_pylist()]
            x = extra(np.array([f for _, f, _ in got]), np.array([s for _, _, s in got]))
            logit = x @ w[:x.shape[1]] + Votes.of(np.stack([v for v, _, _ in got]).reshape(-1, width)).sums(w[x.shape[1]:])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
