"""Operator 7: language identification by Kneser-Ney character models.

Texts are folded to lower-case letters with single blanks between words.  For
each language, n-gram types are counted over the whole texts of all labelled
rows but a tenth, and an interpolated Kneser-Ney model of order ``ORDER`` is estimated
(lower orders count in how many contexts a gram continues).  All models
together are sorted arrays: per order the gram hashes (characters packed into
64 bits), the log-probability of the gram in every language, and the
log back-off mass of each context.  A text gets the language of lowest
cross-entropy per character.

Rejection is calibrated on that tenth, which the models did not see: a text is
rejected if it has no letters, or if its cross-entropy in the best language is
above that language's mean by more than ``REJECT`` standard deviations of
texts of its length and also by more than ``FOREIGN`` of the way to the mean that
the language's texts have in the best of the other models (so a text that is
mixed from two languages, or mostly in one, stays).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import text as T
from sluice.session import materialize

ORDER = 4
#: Of a sample, if one is asked for: rows of each language, characters of each such text (of longer ones, as many windows).
SAMPLE_ROWS = 1500
SAMPLE_CHARS = 20_000
WINDOWS = 10
REJECT = 8.0
FOREIGN = 0.75
#: Size of the character set that unseen characters are taken from.
UNSEEN = 1 << 16
_U = np.uint64
_fold: np.ndarray | None = None
_letter: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Lower-case form of each letter, blank for all else."""
    global _fold
    if _fold is None:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if unicodedata.category(ch := chr(c))[0] in "LM":
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold = table
    return _fold


def letter_table() -> np.ndarray:
    """Which code points are letters (marks alone make no text)."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return _letter


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(folded characters of all texts, offsets); each text is a blank and its
    words with single blanks between."""
    cp = T.code_points(" ".join(["", *texts, ""]))
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    low = fold_table()[cp]
    letter = np.flatnonzero(low != 32)
    keep = low != 32
    between = np.flatnonzero(~keep[1:] & keep[:-1]) + 1      # the blank after a word ...
    after = np.append(letter, len(low))[np.searchsorted(letter, between)]
    keep[between[after < edges[np.searchsorted(edges, between)]]] = True      # ... unless the text ends there
    keep[edges] = True       # the blank before each text
    at = np.cumsum(keep) - 1
    out = low[keep]
    return out[: at[edges[-1]]], at[edges]


def grams(chars: np.ndarray, offsets: np.ndarray, n: int = ORDER) -> np.ndarray:
    """Packed n-gram that ends at each character (blanks before a text's start)."""
    c = chars.astype(_U) & _U(0xFFFF)
    key = c.copy()
    place = np.arange(len(c)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, n):
        before = np.full(len(c), 32, _U)
        before[k:] = c[:-k]
        before[place < k] = 32
        key |= before << _U(16 * k)
    return key


class Model:
    """Sorted gram arrays of all languages."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        orders: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
        for keys, n in counts:
            by = (keys, n.astype(np.float64))
            for order in range(ORDER, 0, -1):
                orders[order].append(by)
                if order > 1:      # a lower gram counts the characters that it follows
                    lower, c = np.unique(by[0] & _U((1 << 16 * (order - 1)) - 1), return_counts=True)
                    by = (lower, c.astype(np.float64))
        self.keys: list[np.ndarray] = [np.zeros(0, _U)] * (ORDER + 1)
        self.logp: list[np.ndarray] = [np.zeros(0)] * (ORDER + 1)
        self.mass: list[np.ndarray] = [np.zeros(0)] * (ORDER + 1)     # of contexts one order lower
        size = len(languages)
        self.unseen = np.full(size, -np.log(UNSEEN), np.float32)
        lower_logp = None
        for order in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([k for k, _ in orders[order]])) if size else np.zeros(0, _U)
            context = np.unique(keys >> _U(16))
            p = np.zeros((len(keys), size))
            back = np.ones((len(context), size))
            for j, (own, n) in enumerate(orders[order]):
                if not len(own):
                    continue
                at = np.searchsorted(context, own >> _U(16))
                total = np.bincount(at, n, len(context))
                kinds = np.bincount(at, minlength=len(context))
                once, twice = (n == 1).sum(), (n == 2).sum()
                discount = once / (once + 2 * twice) if once and twice else 0.5
                seen = total > 0
                back[seen, j] = discount * kinds[seen] / total[seen]
                p[np.searchsorted(keys, own), j] = np.maximum(n - discount, 0) / total[at]
            at = np.searchsorted(context, keys >> _U(16))
            if order == 1:
                below = np.full((len(keys), size), 1 / UNSEEN)
            else:
                below = np.exp(self._score(keys & _U((1 << 16 * (order - 1)) - 1), order - 1))
            p += back[at] * below
            self.keys[order], self.logp[order] = keys, np.log(p).astype(np.float32)
            self.mass[order] = np.log(back).astype(np.float32)
            self.context = getattr(self, "context", [None]) + [context]

    def _score(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last character of each gram, by language."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        if order == 0 or not len(self.keys[order]):
            return out + self.unseen
        spot = np.minimum(np.searchsorted(self.keys[order], keys), len(self.keys[order]) - 1)
        hit = self.keys[order][spot] == keys
        out[hit] = self.logp[order][spot[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest = keys[miss]
            context, known = rest >> _U(16), self.context[order]
            at = np.minimum(np.searchsorted(known, context), len(known) - 1)
            value = self._score(rest & _U((1 << 16 * (order - 1)) - 1), order - 1)
            value += np.where((known[at] == context)[:, None], self.mass[order][at], 0)
            out[miss] = value
        return out

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character by language, letters) of each text."""
        chars, off = fold(texts)
        n = np.diff(off)
        letters = np.add.reduceat(np.append(letter_table()[chars], False).astype(np.int64), off[:-1]) * (n > 0) if len(n) else np.zeros(0, np.int64)
        value = np.zeros((len(n), len(self.languages)))
        if len(chars) and len(n):
            score = self._score(grams(chars, off))
            value = -np.add.reduceat(np.concatenate([score, np.zeros((1, score.shape[1]), np.float32)]), off[:-1], axis=0, dtype=np.float64)
        return value / np.maximum(n, 1)[:, None], letters


def windows(text: Column, key: Column) -> Column:
    """A text of at most ``SAMPLE_CHARS``, or a window at a hashed place of each
    of ``WINDOWS`` equal parts of a longer one."""
    size, part = SAMPLE_CHARS // WINDOWS, F.length(text) / WINDOWS
    place = lambda k: F.pmod(F.xxhash64(F.lit("window"), F.lit(k), key), F.lit(1_000_000)) / 1_000_000
    cut = [text.substr((1 + F.floor(part * k + place(k) * (part - size))).cast("int"), F.lit(size)) for k in range(WINDOWS)]
    return F.when(F.length(text) <= SAMPLE_CHARS, text).otherwise(F.concat_ws("\n", *cut))


def training_rows(docs: DataFrame, fit_on: Column, text: str, lang: str, id_col: str, rows: int | None = None) -> DataFrame:
    """Labelled documents with ``lang``, ``text`` and ``part`` (0..9); rows of one id and language count as one (the smallest text).
    With ``rows``, only a bounded sample of them."""
    docs = docs.select(id_col, text, lang)
    labelled = docs.filter(fit_on & F.col(lang).isNotNull() & (F.length(text) > 0))
    part = F.pmod(F.xxhash64(F.lit("part"), id_col), F.lit(10)).alias("part")
    if rows is None:
        # Only the texts of repeated ids are moved to be compared.
        again = materialize(labelled.groupBy(id_col, lang).count().filter("count > 1").select(F.col(id_col).alias("_again"), F.col(lang).alias("_lang")), "repeated-ids")
        if not again.isEmpty():
            same = labelled[id_col].eqNullSafe(again["_again"]) & (labelled[lang] == again["_lang"])
            many = labelled.join(again, same, "left_semi").groupBy(id_col, lang).agg(F.min(text).alias(text))
            labelled = labelled.join(again, same, "left_anti").unionByName(many)
        return labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), part)
    counts = labelled.groupBy(lang).agg(F.approx_count_distinct(id_col).alias("count")).collect()
    if not counts:
        return docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.lit(0).alias("part")).limit(0)
    rate = F.create_map(*[F.lit(x) for r in counts for x in (r[lang], min(1.0, rows / r["count"]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1_000_000)) / 1_000_000
    drawn = labelled.filter(draw < rate[F.col(lang)]).groupBy(id_col, lang).agg(F.min(windows(F.col(text), F.col(id_col))).alias("_window"))
    return drawn.select(F.col(lang).alias("lang"), F.col("_window").alias("text"), part)



def train(docs: DataFrame, fit_on: Column, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
          rows: int | None = None) -> tuple[Model, dict[str, tuple[float, float, float]]]:
    """(model, per language: mean cross-entropy, its spread per square root of
    a character, and how far above it the best other model is), from all rows
    that ``fit_on`` admits or, with ``rows``, from a bounded sample of them."""
    sample = training_rows(docs, fit_on, text, lang, id_col, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text"):
            langs = np.asarray(b.column("lang").to_pylist(), object)
            texts = b.column("text").to_pylist()
            for name in sorted(set(langs)):
                key, n = np.unique(grams(*fold([texts[k] for k in np.flatnonzero(langs == name)])), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    # Each distinct gram of a language once: a number that levels off as texts are added.
    table = sample.filter("part > 0").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    coded = table["lang"].combine_chunks().dictionary_encode()
    langs, values = np.asarray(coded.indices), coded.dictionary.to_pylist()
    gram, n = np.asarray(table["gram"]).astype(_U), np.asarray(table["n"])
    names = sorted(values)
    counts = []
    for name in names:
        at = np.flatnonzero(langs == values.index(name))
        at = at[np.argsort(gram[at])]
        counts.append((gram[at], n[at]))
    model = Model(names, counts)

    def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text"):
            h, letters = model.entropy(b.column("text").to_pylist())
            own = np.array([names.index(x) if x in names else -1 for x in b.column("lang").to_pylist()])
            at = np.flatnonzero((letters > 0) & (own >= 0))
            other = h[at].copy()
            other[np.arange(len(at)), own[at]] = np.inf
            second = np.minimum(other.min(axis=1, initial=np.inf), np.log(UNSEEN))
            yield pa.RecordBatch.from_arrays([b.column("lang").take(pa.array(at)), pa.array(h[at, own[at]]), pa.array(second), pa.array(letters[at])], ["lang", "h", "second", "n"])

    limits = {}
    if names:
        spread = sample.filter("part = 0").mapInArrow(residuals, "lang string, h double, second double, n long")
        for r in spread.groupBy("lang").agg(F.avg("h").alias("m"), F.sum(F.col("h") * F.col("h") * F.col("n")).alias("s2"),
                                            F.sum(F.col("h") * F.col("n")).alias("s1"), F.sum("n").alias("s0"), F.avg("second").alias("other"), F.count(F.lit(1)).alias("k")).collect():
            mean = r["s1"] / r["s0"]
            # texts of n letters spread by sigma / sqrt(n): sigma^2 = mean of n (h - mean)^2
            sigma = max((r["s2"] - 2 * mean * r["s1"] + mean * mean * r["s0"]) / r["k"], 0.25) ** 0.5
            limits[r["lang"]] = (mean, sigma, max(r["other"] - mean, 0.0))
    return model, limits


RESULT = "lang_pred string, score double, rejected boolean"


def classify(texts: list[str], model: Model, limits: dict[str, tuple[float, float, float]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text."""
    h, letters = model.entropy(texts)
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    best = h.argmin(axis=1)
    low = h[np.arange(len(h)), best]
    # Posterior of the best language, with at most 200 characters' worth of evidence.
    score = 1 / np.exp(-(h - low[:, None]) * np.minimum(letters, 200)[:, None]).sum(axis=1)
    mean, sigma, gap = np.array([limits.get(x, (np.inf, 1.0, 0.0)) for x in model.languages]).T[:, best]
    rejected = (letters == 0) | (low > mean + np.maximum(REJECT * sigma / np.sqrt(np.maximum(letters, 1)), FOREIGN * gap))
    names = np.array(model.languages, object)[best]
    names[letters == 0] = "und"
    return names.tolist(), np.where(letters > 0, score, 0.0), rejected


def identify(docs: DataFrame, model: Model, limits: dict[str, tuple[float, float, float]], text: str = "text",
             prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (named with
    ``prefix``, in place of older columns so named) appended; texts that are null or without letters are ``und``,
    score 0, rejected."""
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")]
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast((model, limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in T.slices(batches, text):
            pred, score, rejected = classify(T.text_column(b, text).to_pylist(), *own)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)], [*b.schema.names, *names])

    schema = StructType([*docs.schema.fields, *(StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType())))])
    return docs.mapInArrow(run, schema)
