"""Operator 13: document quality rules as a short-circuit cascade (DataFrame functions only).

Every document gets its base figures (words, symbols, repeated lines, words in
repeated three-word windows).  A document that the base rules reject is done.
The other rules run as one CASE expression, which stops at the first rule that
rejects; their order comes from a sample: every rule is timed on it and its
rejections are counted, and the rule that rejects most of what the rules
before it let through, for each second, goes next.  The order changes the cost
alone, never the verdict.

Null and empty texts have no words: all figures 0, rejected by the base rules.
Repeated rows are judged one by one; an empty table gives no rows; columns of
any name pass through unused.  A text is one row's value throughout, so a very
long one costs its task a small multiple of its size (words, three-word
hashes and their sort) and no other row.  Three-word windows are compared by
64-bit hashes, within one text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.text import fresh
from sluice.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Rows of the sample (about; drawn by chance at one rate everywhere) and timed runs of each rule.
SAMPLE_ROWS = 4000
RUNS = 2
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

Columns = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """``holds`` makes, of the columns text, words, lines (those with a word)
    and the base figures, a Boolean that is true for good documents."""

    name: str
    holds: Callable[[Columns], Column]


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def share_of(items: Column, pattern: str) -> Column:
    """Items that the pattern occurs in, as hundredths of all (at least one)."""
    return 100 * F.size(F.filter(items, lambda x: x.rlike(pattern))) / F.greatest(F.size(items), F.lit(1))


RULES = (
    Rule("mean_word_length", lambda c: c["word_chars"].between(3 * c["n_words"], 10 * c["n_words"])),
    Rule("symbols", lambda c: 10 * c["n_symbols"] <= c["n_words"]),
    Rule("repeated_lines", lambda c: 10 * c["n_dup_lines"] <= 3 * F.size(c["lines"])),
    Rule("words_with_letters", lambda c: share_of(c["words"], r"\p{L}") >= 80),
    Rule("capitals", lambda c: 10 * F.regexp_count(c["text"], F.lit(r"\p{Lu}")) <= 3 * c["word_chars"]),
    Rule("digits", lambda c: 10 * count_of(c["text"], "0123456789") <= 3 * c["word_chars"]),
    Rule("cut_off_lines", lambda c: share_of(c["lines"], r"(\.\.\.|…)[\x20\x09-\x0D]*\z") <= 30),
    Rule("bullet_lines", lambda c: share_of(c["lines"], r"\A[\x20\x09-\x0D]*[-*•‣▪]") <= 90),
    Rule("longest_word", lambda c: ~F.exists(c["words"], lambda x: F.char_length(x) > 1000)),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more."""
    def hashed(w: Column) -> Column:
        return F.when(F.size(w) < 3, F.array().cast("array<struct<h:bigint,p:int>>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))))

    def covered(windows: Column) -> Column:
        twice = F.filter(windows, lambda x, i: F.get(windows, i - 1)["h"].eqNullSafe(x["h"]) | F.get(windows, i + 1)["h"].eqNullSafe(x["h"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["p"])), start,
            lambda seen, p: F.struct((seen["n"] + F.least(F.lit(3), p - seen["last"])).alias("n"), p.alias("last")), lambda seen: seen["n"])

    return let(words, lambda w: let(F.sort_array(hashed(w)), covered))


def measure(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Columns]:
    """The rows with helper columns, and these by the names that rules use."""
    names = dict(zip(("text", "words", "lines", *BASE), fresh(docs, "_text", "_words", "_lines", *(f"_{b}" for b in BASE))))
    c = {k: F.col(v) for k, v in names.items()}
    split = docs.withColumn(names["text"], F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumns({
        names["words"]: F.regexp_extract_all(c["text"], F.lit(WORD), F.lit(0)),
        names["lines"]: F.filter(F.split(c["text"], "\n", -1), lambda x: x.rlike(WORD))})
    return split.withColumns({
        names["n_words"]: F.size(c["words"]).cast("long"),
        names["word_chars"]: F.char_length(F.translate(c["text"], SPACES, "")).cast("long"),
        names["n_symbols"]: count_of(c["text"], SYMBOLS).cast("long"),
        names["n_dup_lines"]: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long"),
        names["n_repeat_words"]: repeated_words(c["words"])}), c


def base_failed(c: Columns) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


@dataclass(frozen=True)
class Estimate:
    """What the sample says of a rule: seconds for the sample, and the share that it rejects."""

    rule: Rule
    cost: float
    rejects: float


def cascade_order(costs: Sequence[float], patterns: Sequence[tuple[tuple[bool, ...], int]]) -> list[int]:
    """Rule numbers by rejection per cost.  ``patterns`` counts the sample rows
    by the rules that they pass; rows that an earlier rule rejects no longer
    count for a later one.  Ties go to the cheaper rule, then to the first."""
    order: list[int] = []
    left = list(range(len(costs)))
    while left:
        still = [(p, n) for p, n in patterns if all(p[k] for k in order)]
        gain = {k: sum(n for p, n in still if not p[k]) / costs[k] for k in left}
        best = min(left, key=lambda k: (-gain[k], costs[k], k))
        order.append(best)
        left.remove(best)
    return order


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """The rules in their order, timed and counted on a sample of the
    documents that the base rules let through (all of a small table)."""
    n = docs.count()
    rate = 1.0 if n <= sample_rows else sample_rows / n
    drawn = docs.select(text) if rate == 1.0 else docs.select(text).sample(False, rate, 7)
    rows, c = measure(drawn, text)
    sample = materialize(rows, "rule-sample").filter(~base_failed(c))
    passes = [F.coalesce(r.holds(c), F.lit(False)) for r in rules]
    patterns = [(tuple(r[:-1]), r[-1]) for r in sample.groupBy(*(p.alias(f"r{k}") for k, p in enumerate(passes))).count().collect()]

    def seconds(condition: Column) -> float:
        taken = []
        for _ in range(RUNS):
            begun = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()
            taken.append(time.perf_counter() - begun)
        return min(taken)

    nothing = seconds(F.char_length(c["text"]) >= 0)
    costs = [max(seconds(p) - nothing, 1e-3) for p in passes]
    total = max(sum(k for _, k in patterns), 1)
    return [Estimate(rules[k], costs[k], sum(m for p, m in patterns if not p[k]) / total) for k in cascade_order(costs, patterns)]


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """Every row with ``n_words``, the other base figures, ``base_failed`` and
    ``kept``.  Without ``rules`` (in the order to use) the order is estimated.
    Columns of ``docs`` with these names are replaced."""
    rules = [e.rule for e in estimate(docs, text=text)] if rules is None else list(rules)
    rows, c = measure(docs, text)
    (failed,) = fresh(rows, "_base_failed")
    rows = rows.withColumn(failed, base_failed(c))
    kept = F.when(F.col(failed), F.lit(False))
    for rule in rules:
        kept = kept.when(~F.coalesce(rule.holds(c), F.lit(False)), F.lit(False))
    made = {b: c[b] for b in BASE} | {"base_failed": F.col(failed), "kept": kept.otherwise(F.lit(True))}
    return rows.select(*(F.col(x) for x in docs.columns if x.lower() not in made), *(v.alias(k) for k, v in made.items()))
