"""Operator 3: secret scans with a randomness test battery.

Three base patterns (fixed below) give spans by definition.  Other long tokens
are candidates: their encoding is inferred from the characters, and three
tests ask how a random string of that encoding would look:

* chi-squared: are the letters of the alphabet equally frequent?
* runs: does the sequence change between the alphabet's halves as often as chance?
* serial correlation: does a character say anything about the next?

Fisher's method joins the three p-values.  Random strings have uniform joint
p-values, ordinary text has small ones but, when short, not reliably.  So the
threshold is set for each encoding and length class by false-discovery
control: the corpus' p-values of the class are counted in bins, the share of
random strings is estimated from the upper half (where they are uniform and
text is rare), and the smallest threshold is taken whose accepted candidates
are text at a rate of at most ``q``.  Classes without such a threshold accept
none.  Only the bins (a fixed number) reach the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import text as T
from sluice.session import materialize

# The base patterns, their order, and the least sizes (of group 2, of the match, of the match).
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

CANDIDATE_LEAST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Encodings from the narrowest alphabet on; a candidate takes the first that holds all its characters.
ENCODINGS = {
    "hex": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base32lower": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "base36lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_INDEX = {name: {c: k for k, c in enumerate(alphabet)} for name, alphabet in ENCODINGS.items()}
LENGTH_CLASSES = (20, 24, 32, 48, 64)
BINS = 100
#: Chi-squared of five parts (four degrees of freedom) beyond which p-values are not spread evenly: 1 %.
UNEVEN = 13.28


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in code points."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
    return sorted(found, key=lambda s: (s[1], s[0]))


def infer_encoding(token: str) -> str | None:
    """The narrowest encoding of a token; None for words (one case only, or no letters)."""
    body = token.rstrip("=")
    if body.isdigit() or (body.isalpha() and (body.islower() or body.isupper() or body.istitle())):
        return None
    chars = set(body)
    return next((name for name, index in _INDEX.items() if chars <= index.keys()), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, encoding: str) -> tuple[float, float, float]:
    """p-values of the three tests for a random string of the encoding."""
    index = _INDEX[encoding]
    x = np.fromiter((index[c] for c in token.rstrip("=")), np.int64)
    n, k = len(x), len(index)
    counts = np.bincount(x, minlength=k)
    chi, df = float(((counts - n / k) ** 2).sum() * k / n), k - 1
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is near normal.
    uniform = _normal_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    high = x >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n0 and n1:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n0 * n1 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        run_p = 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        run_p = 2.0 ** (1 - n)
    d = x - x.mean()
    power = float((d * d).sum())
    r = float((d[1:] * d[:-1]).sum()) / power if power else 1.0
    serial = 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))
    return uniform, run_p, serial


def combine(ps: tuple[float, ...]) -> float:
    """Fisher's joint p-value of independent tests."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for k in range(1, len(ps)):
        term *= half / k
        total += term
    return min(1.0, math.exp(-half) * total)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(class number, start, end, joint p) of tokens outside the base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if any(a < e and s < b for _, a, b in taken):
            continue
        encoding = infer_encoding(m[0])
        if encoding is None or len(m[0].rstrip("=")) < CANDIDATE_LEAST:
            continue
        size = sum(e - s >= least for least in LENGTH_CLASSES) - 1
        out.append((list(ENCODINGS).index(encoding) * len(LENGTH_CLASSES) + size, s, e, combine(battery(m[0], encoding))))
    return out


_HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
_TOKEN_BYTES = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"))


def _with_run(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> np.ndarray:
    """Which texts hold a run of at least ``least`` member bytes."""
    out = np.zeros(len(offsets) - 1, bool)
    if len(data):
        stop = ~member[data]
        breaks = np.unique(np.concatenate([np.flatnonzero(stop), offsets[1:] - 1, [-1]]))
        # A text's last byte may be a member: its run ends just after it.
        length = np.diff(breaks) - stop[breaks[1:]]
        long = breaks[1:][length >= least]
        out[np.searchsorted(offsets, long, "right") - 1] = True
    return out


SPAN = "array<struct<kind:int,start:int,end:int>>"
CAND = "array<struct<cls:int,start:int,end:int,p:double>>"


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per text: ``doc_id``, ``base`` spans and ``cand`` (candidates
    with class and joint p).  Null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, text):
            col = T.text_column(b, text)
            data, off = T.utf8(col)
            long = _with_run(data, off, _HEX_BYTES, HEX_LEAST) | _with_run(data, off, _TOKEN_BYTES, CANDIDATE_LEAST)
            base, cand = [], []
            for t, flagged in zip(col.to_pylist(), long.tolist()):
                low = t.lower()
                if flagged or "akia" in low or "passw" in low or "secret" in low or "token" in low or "apikey" in low or "api_key" in low:
                    own = base_spans(t)
                    base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                    cand.append([{"cls": c, "start": s, "end": e, "p": p} for c, s, e, p in candidates(t, own)])
                else:
                    base.append([])
                    cand.append([])
            yield pa.RecordBatch.from_arrays([
                b.column(id_col).cast(pa.int64()),
                pa.array(base, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(cand, pa.list_(pa.struct([("cls", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))],
                ["doc_id", "base", "cand"])

    return docs.select(id_col, text).mapInArrow(run, f"doc_id long, base {SPAN}, cand {CAND}")


def _random_share(n: np.ndarray, above: np.ndarray, edge: int) -> float:
    """Random strings in each bin of p-values.  Theirs are spread evenly, so the
    upper half shows how many there are, if it is even (chi-squared, five parts).  If
    not, names and other text reach into it, and no more than the sparsest of
    its upper ends is sure to be random, less two standard deviations."""
    ends = np.linspace(edge, BINS, 6).astype(int)
    parts = np.array([n[a:b].sum() for a, b in zip(ends, ends[1:])])
    even = parts.sum() / 5
    if even and ((parts - even) ** 2).sum() / even > UNEVEN:
        return max(0.0, min((above[a] - 2 * math.sqrt(above[a])) / (BINS - a) for a in ends[:-1].tolist()))
    return above[edge] / (BINS - edge)


def thresholds(scanned: DataFrame, q: float = 0.05, random_from: float = 0.5) -> dict[int, float]:
    """Least joint p to accept, by class, at false-discovery rate ``q``."""
    rows = (scanned.select(F.explode("cand").alias("c"))
            .groupBy(F.col("c.cls").alias("cls"), F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).alias("bin"))
            .count().collect())
    counts: dict[int, np.ndarray] = {}
    for r in rows:
        counts.setdefault(r["cls"], np.zeros(BINS))[int(r["bin"])] = r["count"]
    out = {}
    for cls, n in counts.items():
        above = n[::-1].cumsum()[::-1]                       # candidates with p in this bin or a higher one
        per_bin = _random_share(n, above, int(BINS * random_from))
        text = np.maximum(above - per_bin * np.arange(BINS, 0, -1), 0)
        ok = np.flatnonzero((text <= q * above) & (above > 0))
        # Random strings with a joint p below 1 % are given up; bin 0 is where text lies.
        ok = ok[ok > 0]
        if len(ok):
            out[cls] = ok[0] / BINS
    return out


def accept(scanned: DataFrame, limits: dict[int, float]) -> DataFrame:
    """Adds ``spans``: base spans and accepted candidates, by start, then kind."""
    pairs = [F.lit(x) for c, t in sorted(limits.items()) for x in (c, t)]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<int,double>")
    good = F.filter("cand", lambda c: c["p"] >= F.coalesce(F.try_element_at(table, c["cls"]), F.lit(2.0)))
    extra = F.transform(good, lambda c: F.struct(F.lit(KINDS.index("random")).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    ordered = F.array_sort(F.transform(F.concat("base", extra), lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return scanned.withColumn("spans", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))


def find_secrets(docs: DataFrame, q: float = 0.05, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row.  Null and empty texts
    have no spans; repeated rows give repeated results."""
    scanned = materialize(scan(docs, text, id_col), "secret-scan")
    return accept(scanned, thresholds(scanned, q)).drop("cand")


def joined(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, q: float = 0.05, text: str = "text", id_col: str = "doc_id", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` and
    ``n_chars`` (if there) brought up to date; columns keep order and type.

    One pass finds the thresholds, the next finds the spans again where the
    text is and replaces them, so no text is joined or shuffled.
    """
    limits = thresholds(materialize(scan(docs, text, id_col).select("cand").filter(F.size("cand") > 0), "secret-candidates"), q)
    at = docs.columns.index(text)

    def clean(t: str) -> str:
        own = base_spans(t)
        spans = [(s, e) for _, s, e in own] + [(s, e) for c, s, e, p in candidates(t, own) if p >= limits.get(c, 2.0)]
        out, to = [], 0
        for s, e in sorted(spans):
            if s >= to:
                out += [t[to:s], mark]
            to = max(to, e)
        return "".join([*out, t[to:]]) if spans else t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, text):
            filled = T.text_column(b, text)
            data, off = T.utf8(filled)
            long = _with_run(data, off, _HEX_BYTES, HEX_LEAST) | _with_run(data, off, _TOKEN_BYTES, CANDIDATE_LEAST)
            new, changed = [], False
            for t, flagged, null in zip(filled.to_pylist(), long.tolist(), b.column(text).is_null().to_pylist()):
                low = t.lower()
                if not null and (flagged or "akia" in low or "passw" in low or "secret" in low or "token" in low or "apikey" in low or "api_key" in low):
                    c = clean(t)
                    changed |= c is not t
                    t = c
                new.append(None if null else t)
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type)) if changed else b

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
