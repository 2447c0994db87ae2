"""Ranked search, hard negatives and the rule cascade against brute force, on
tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import math
import random
import re

import numpy as np
import pytest

from sluice.llm import hardneg, lexical, rulecascade
from sluice.llm import queries as Q

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _search(docs, items, k):
    held = [(i, t, len(t), {x: t.count(x) for x in set(t)}) for i, t in ((i, _terms(t)) for i, t in docs) if t]
    total, length = len(held), sum(n for _, _, n, _ in held)
    out = []
    for item, text in items:
        terms = set(_terms(text))
        w = {x: math.floor(1000 * math.log((2 * total + 2) / (2 * sum(x in tf for *_, tf in held) + 1))) for x in terms}
        scores = []
        for i, _, n, tf in held:
            m = 10 + (90 * n * total) // length
            s = sum(w[x] * (10**9 * tf[x] // (1000 * tf[x] + 8 * m)) for x in terms if x in tf)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_search(spark):
    Q.prepare(spark)
    rng = random.Random(4)
    words = ["the", "of", "Über", "naïve", "x1", "it's", "你好", "🙂", "a-b", "RUN", "run", "ÉTÉ", *(f"w{k}" for k in range(40))]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    docs = [(k, t) for k, t in enumerate(texts)] + [(200, None), (201, ""), (202, "!!! --"), (None, texts[3]), (5, texts[9]), (5, texts[5])]
    docs += [(300 + k, texts[0]) for k in range(15)] + [(400, " ".join(f"w{k % 40}" for k in range(20000)))]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for k in range(40)]
    items += [(0, "the of Über"), (41, None), (42, ""), (43, "nowhere"), (None, "run w1"), (44, texts[0]), (45, texts[0])]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item string").repartition(3)
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, n int").repartition(2)
    assert sorted((tuple(r) for r in lexical.search(d, b).collect()), key=str) == _search(docs, items, 10)
    assert lexical.search(d.limit(0), b).count() == 0
    assert lexical.search(d, b.limit(0)).count() == 0


def test_search_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_TERMS", 8)
    docs, items = [(k, f"a{k % 3} b{k % 5} c{k}") for k in range(30)], [(k, f"a{k % 3} b{k} c{k}") for k in range(9)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == _search(docs, items, 10)


def test_terms_do_not_depend_on_the_pieces():
    text = ("One two three " * 50 + "x" * 300 + " end\t" + "Ü" * 90 + ". tail").encode()
    data = np.frombuffer(text, np.uint8)
    starts = [m.start() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)]
    whole = np.concatenate([s for s, _ in lexical.term_hashes(data)])
    assert whole.tolist() == starts
    for limit in (16, 64, 1000):
        cut = [np.concatenate(x) for x in zip(*lexical.term_hashes(data, limit))]
        assert cut[0].tolist() == starts


def test_sharing_graph_sums_every_set_with_fewer_additions():
    rng = random.Random(8)
    common = [rng.sample(range(60), 12) for _ in range(4)]
    sets = [np.unique(rng.choice(common) + rng.choice(common) + rng.sample(range(60, 300), 6)) for _ in range(50)]
    sets += [sets[0], np.array([299], np.int64)]
    leaf, levels, ends, nodes = lexical.sharing_graph(sets)
    made = [set() for _ in range(int(leaf.max()) + 1)]
    for s in sets:
        for t in s:
            made[leaf[t]].add(int(t))
    for level in levels:
        for a, b in level:
            assert not made[a] & made[b]
            made.append(made[a] | made[b])
    assert len(made) == nodes
    assert [made[e] for e in ends] == [set(map(int, s)) for s in sets]
    assert ends[0] == ends[50]
    assert sum(map(len, levels)) < sum(len(s) - 1 for s in sets) / 2


def _mined(rows, positives=5, negatives=10):
    rows = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(rows):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, u)), j, m) for b, (j, m, u) in enumerate(rows) if b != a and len(u) == len(v)]
        for s, j, m in sorted(x for x in scored if x[2] == lab)[:positives]:
            fit = sorted((n, k) for n, k, m2 in scored if m2 != lab and -30 * s <= -100 * n <= -90 * s)[:negatives]
            out += [(i, j, r + 1, k, -s, -n) for r, (n, k) in enumerate(fit)]
    return sorted(out)


def _vectors():
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(6, 16))
    rows = [(k, [float(np.float32(x)) for x in middle[k % 6] * 2 + rng.normal(size=16) * 0.4], int(rng.integers(0, 4))) for k in range(900)]
    rows += [(1000 + k, rows[7][1], rows[7][2]) for k in range(20)] + [(1100, rows[7][1], rows[7][2]), (100, rows[3][1], 2)]     # ties, a repeated id
    rows += [(None, rows[1][1], 1), (1200, None, 1), (1300, rows[1][1], None), (1400, [1.0, None] * 8, 1), (1500, [float("nan")] * 16, 1),
             (1600, [float("inf")] * 16, 1), (1700, [], 1), (1800, [0.5, 1.0], 1), (1801, [0.5, 1.5], 1), (1802, [0.25, 1.0], 0)]
    return rows


def test_hard_negatives(spark):
    Q.prepare(spark)
    rows = _vectors()
    df = spark.createDataFrame([(i, v, lab, 3) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, rank int").repartition(3)
    assert sorted(tuple(r) for r in hardneg.mine(df).collect()) == _mined(rows)
    assert hardneg.mine(df.limit(0)).count() == 0
    assert hardneg.mine(df.filter("vec_id % 100 <> 0")).count() == 0


def test_hard_negatives_in_small_rounds(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    monkeypatch.setattr(hardneg, "ROUND_BYTES", 1500)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    assert sorted(tuple(r) for r in hardneg.mine(df).collect()) == _mined(rows)


def test_hard_negatives_beyond_exact_floats(spark):
    rows = [(k, [1e6 + k / 7, 5e6 + k % 11, float(k % 13)], k % 3) for k in range(201)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in hardneg.mine(df).collect()) == _mined(rows)


def test_tree_bounds_leave_candidates_unscored():
    rng = np.random.default_rng(2)
    middle = rng.integers(-400, 400, (40, 16))
    near = rng.integers(-4, 5, (60, 16)) + middle[0]       # anchors close to each other: tight bounds
    cand = (middle[rng.integers(0, 40, 3000)] + rng.integers(-5, 6, (3000, 16)))
    order, parent = hardneg.span(near)
    assert sorted(order.tolist()) == list(range(60)) and (parent[1:] < np.arange(1, 60)).all() and parent[0] == -1
    label = rng.integers(0, 3, 3000)
    block = hardneg.packed(16, 0, np.arange(3000), label, np.arange(3000), cand)
    tree = hardneg.packed(16, 0, np.arange(60), np.zeros(60), -1 - np.arange(60), near[order]) | {"parent": parent.tobytes()}
    best = hardneg.Best(5)
    scored = hardneg.positives_of(block, tree, best)
    assert scored < 0.5 * 60 * 3000
    for a in range(60):
        s = cand @ near[order[a]]
        own = np.flatnonzero(label == 0)
        want = own[np.lexsort((own, -s[own]))[:5]]
        assert best.rows[a][1].tolist() == want.tolist()


def _quality(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    n, chars, sym = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t)
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    share = lambda items, p: 100 * sum(map(p, items)) / max(len(items), 1)
    good = (3 * n <= chars <= 10 * n and 10 * sym <= n and 10 * dup <= 3 * len(lines) and share(words, lambda x: any(c.isalpha() for c in x)) >= 80
            and 10 * sum(c.isupper() for c in t) <= 3 * chars and 10 * sum(c in "0123456789" for c in t) <= 3 * chars
            and share(lines, lambda x: re.search(r"(\.\.\.|…)[\x20\x09-\x0d]*\Z", x) is not None) <= 30
            and share(lines, lambda x: re.match(r"[\x20\x09-\x0d]*[-*•‣▪]", x) is not None) <= 90 and all(len(x) <= 1000 for x in words))
    return n, chars, sym, dup, len(covered), failed, not failed and good


@pytest.fixture(scope="module")
def judged():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeéñü") for _ in range(rng.randint(2, 8)))
    plain = lambda n: " ".join(word() for _ in range(n))
    good = plain(120)
    return [None, "", " \n\t", "a b", "a b c", "a b c a b c", good, good, good.upper(), good + " " + "## $$ %% " * 30, "\n".join(["same line of words"] * 40),
            "\n".join([plain(9)] * 4 + [plain(9) for _ in range(12)]), "\n".join(plain(12) + "..." for _ in range(12)), "\n".join("- " + plain(9) for _ in range(12)),
            plain(80) + " " + "x" * 1500, " ".join(str(rng.randint(0, 99999)) for _ in range(90)), plain(60) + " | " * 60, "a " * 200, plain(49), plain(50),
            "\x0b".join(plain(10) for _ in range(9)), "你好 世界 " * 40, " ".join(f"w{k % 5003}" for k in range(20000)), plain(100) + "\x00nul #",
            *(plain(rng.randint(40, 300)) for _ in range(20))]


def test_rule_cascade(spark, judged):
    rows = [(k, t, "z", 1) for k, t in enumerate(judged)] + [(0, judged[6], "y", 2), (None, judged[6], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, _words int").repartition(3)
    want = sorted([(i, *_quality(t)) for i, t, *_ in rows], key=str)
    out = rulecascade.judge(df)
    assert "_words" in out.columns and dict(out.dtypes)["kept"] == "boolean"
    got = sorted((tuple(r) for r in out.select("doc_id", *rulecascade.BASE, "base_failed", "kept").collect()), key=str)
    assert got == want
    assert rulecascade.judge(df.limit(0)).count() == 0
    for order in (list(rulecascade.RULES), list(reversed(rulecascade.RULES))):       # the order changes no verdict
        again = rulecascade.judge(df, order).select("doc_id", *rulecascade.BASE, "base_failed", "kept")
        assert sorted((tuple(r) for r in again.collect()), key=str) == want


def test_cascade_order_is_by_rejection_per_cost():
    # Rule 1 rejects most for its cost; what it leaves makes rule 2 worth more than rule 0.
    patterns = [((False, False, True), 50), ((True, False, True), 20), ((False, True, True), 5), ((True, True, False), 20), ((True, True, True), 5)]
    assert rulecascade.cascade_order([1.0, 1.0, 1.0], patterns) == [1, 2, 0]
    assert rulecascade.cascade_order([1.0, 100.0, 1.0], patterns) == [0, 2, 1]
    assert rulecascade.cascade_order([2.0, 1.0], []) == [1, 0]


def test_cascade_stops_at_the_first_rejection(spark):
    """A rule that would fail on a document is not run once another one rejected it."""
    from pyspark.sql import functions as F

    raises = rulecascade.Rule("raises", lambda c: F.assert_true(c["n_symbols"] == 0).isNull())
    text = " ".join(f"word{k}" for k in range(60))
    df = spark.createDataFrame([(1, text), (2, text + " ###### ######")], "doc_id long, text string")
    symbols = next(r for r in rulecascade.RULES if r.name == "symbols")
    assert {r["doc_id"]: r["kept"] for r in rulecascade.judge(df, [symbols, raises]).collect()} == {1: True, 2: False}
