"""Models and search: held-out accuracy on the driver's tables, exactness
against brute force, and defined results at the edges."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.llm import graph, langid, quality, topk, toxicity
from sluice.llm import queries as Q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data():
    if not os.path.exists(SF):
        pytest.skip("driver tables not present")
    return pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/labels.parquet")


EDGE = [(1, None, 9, "en"), (2, "", 9, None), (3, " \n\n ", 9, "xx"), (4, "123 !!", 9, None), (5, "x " * 60_000, 9, None), (5, "x " * 60_000, 9, None)]


def test_language_id_held_out(spark, data):
    got = Q.op7_language_id(spark, SF).toPandas().merge(data[0], on="doc_id")
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97
    assert held["rejected"].mean() < 0.01 and held["score"].between(0, 1).all()


def test_language_model_is_a_distribution():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcde ") for _ in range(200)) for _ in range(20)]
    keys, n = np.unique(langid.grams(*langid.fold(texts)), return_counts=True)
    model = langid.Model(["one"], [(keys, n)])
    context = langid.grams(*langid.fold(["abc"]))[-1] << np.uint64(16)
    total = np.exp(model._score(np.array([context | np.uint64(c) for c in range(langid.UNSEEN)], np.uint64) & np.uint64(2**64 - 1))).sum()
    assert abs(total - 1) < 1e-2


def test_language_edges(spark):
    Q.prepare(spark)
    rows = [(k, t, 1, lang) for k, (t, lang) in enumerate([("the cat sat on the mat and the dog", "en"), ("der hund und die katze sind da", "de")] * 30)]
    train = spark.createDataFrame(rows, "doc_id long, text string, score int, lang string")
    model, limits = langid.train(train, F.lit(True))
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(EDGE + [(9, "THE DOG AND THE CAT", 9, None)], "doc_id long, text string, score int, lang string"), model, limits).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and got[k]["rejected"] for k in (1, 2, 3, 4))
    assert got[9]["lang_pred"] == "en" and 0 <= got[5]["score"] <= 1
    none, _ = langid.train(train.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(train, none, {}).collect()} == {"und"}
    assert langid.identify(train.limit(0), model, limits).count() == 0


def test_language_of_long_texts_only(spark):
    Q.prepare(spark)
    rng = random.Random(2)
    word = {"en": "the cat sat on mat and dog with its bone".split(), "de": "der hund und die katze sind heute nicht da gewesen".split(),
            "fi": "koira kissa istuu matolla eikä tänään ollut täällä".split()}
    text = lambda lang, n: " ".join(rng.choices(word[lang], k=n))
    schema = "doc_id long, text string, lang string"
    long = lambda lang: text(lang, 5000)
    assert len(long("fi")) > langid.SAMPLE_CHARS
    mixed = [(k, long("fi") if k % 3 == 2 else text(("en", "de")[k % 3], 40), ("en", "de", "fi")[k % 3]) for k in range(90)]
    only = [(k, long(x), x) for k in range(40) for x in [("en", "de")[k % 2]]]
    for rows in (mixed, only):
        df = spark.createDataFrame(rows, schema)
        model, limits = langid.train(df, F.lit(True))
        got = langid.identify(df, model, limits, prefix="p_").toPandas()
        assert (got["lang"] == got["p_lang_pred"]).all() and not got["p_rejected"].any()


def test_training_windows(spark):
    text = "".join(chr(0x4e00 + k) for k in range(20_000)) + "abc"      # every character stands for its place
    got = spark.createDataFrame([(7, text), (8, text[:20_000]), (9, "")], "id long, text string").select("id", langid.windows(F.col("text"), F.col("id")).alias("w")).collect()
    got = {r["id"]: r["w"] for r in got}
    assert got[8] == text[:20_000] and got[9] == ""
    parts = got[7].split("\n")
    places = [text.index(p) for p in parts]
    assert all(len(p) == 2000 for p in parts) and all(b - a >= 2000 for a, b in zip(places, places[1:])) and len(parts) == langid.WINDOWS


def test_quality_of_long_texts_only(spark):
    Q.prepare(spark)
    rng = random.Random(4)
    good = lambda: " ".join(rng.choices("we went home and then had some tea with them".split(), k=9)).capitalize() + "."
    bad = lambda: " ".join(rng.choices("### $$ 99 >> BUY || 00 %% @@".split(), k=9))
    rows = [(k, "\n".join((good if k % 2 else bad)() for _ in range(quality.SAMPLE_LINES + 1 + 7 * k))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(k, 1) for k in range(1000, 9000)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.col("doc_id") != 0)
    got = quality.score(docs, model).toPandas()
    assert ((got["score"] >= 0.7) == (got["doc_id"] % 2 == 1)).all()
    for n in (0, 1, 200, 201, 205, 5000):
        runs = quality.runs_of(n, -n)
        assert sum(z - a for a, z in runs) == min(n, 200) and all(a <= z <= n for a, z in runs) and all(x[1] <= y[0] for x, y in zip(runs, runs[1:]))


def test_quality_held_out(spark, data):
    got = Q.op8_quality(spark, SF).toPandas().merge(data[1], on="doc_id")
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    assert (got[got["quality"] == 1]["predicted"] == 1).mean() > 0.98


def test_quality_edges(spark):
    Q.prepare(spark)
    model = (np.zeros((quality.WIDTH, 2)), np.zeros((2, 2)), 1.0, 0.0)
    df = spark.createDataFrame(EDGE, "doc_id long, text string, score int, lang string")
    assert {round(r["score"], 6) for r in quality.score(df, model).collect()} == {0.5}
    assert quality.score(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(df, labels, F.lit(True)) is None


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    unary, trans = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))
    per_doc = np.array([1, 4, 2])
    p, pairs = quality.marginals(unary, trans, per_doc, np.ones(7))
    at, links = 0, np.zeros((2, 2))
    for k in per_doc:
        weights = {}
        for code in range(2**k):
            y = [(code >> j) & 1 for j in range(k)]
            weights[tuple(y)] = np.exp(sum(unary[at + j, y[j]] for j in range(k)) + sum(trans[y[j], y[j + 1]] for j in range(k - 1)))
        z = sum(weights.values())
        for j in range(k):
            assert abs(p[at + j, 1] - sum(w for y, w in weights.items() if y[j]) / z) < 1e-9
        for y, w in weights.items():
            for j in range(k - 1):
                links[y[j], y[j + 1]] += w / z
        at += k
    assert np.allclose(pairs, links)


def test_line_features_by_hand():
    own, per_doc, size = quality.line_features(np.frombuffer("Ab cd\nx! x! x!é\n".encode() + b"" + b"zz", np.uint8), np.array([0, 17, 17, 19]))
    f = {n: own[:, k] for k, n in enumerate(quality.FEATURES)}
    assert per_doc.tolist() == [3, 1, 1] and size.tolist() == [5, 10, 0, 0, 2]
    assert f["upper"][0] == 0.25 and f["blank"].tolist() == [0, 0, 1, 1, 0]
    assert f["repeat"][0] == 0 and abs(f["repeat"][1] - 1 / 3) < 1e-9


def test_toxicity_held_out(spark, data):
    got = Q.op6_toxicity(spark, SF).toPandas().merge(data[1], on="doc_id")
    held = got[got["held_out"]]
    assert (held[held["toxic"] == 0]["predicted"] == 0).mean() > 0.98
    assert (held[held["toxic"] == 1]["predicted"] == 1).mean() > 0.5


def _toxic_table(spark, words_of, toxic=3000, seed=5):
    """(documents, labels): as many clean rows as toxic ones, all of filler,
    the toxic ones with the words that ``words_of(random, k)`` gives."""
    rng = random.Random(seed)
    rows, marks = [], []
    for k in range(2 * toxic):
        words = [f"filler{rng.randrange(400)}" for _ in range(40)]
        for w in words_of(rng, k) if k % 2 else ():
            words.insert(rng.randrange(len(words)), w)
        rows.append((k, " ".join(words)))
        marks.append((k, k % 2))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_many_rare_words(spark):
    Q.prepare(spark)
    rare = ["".join(random.Random(k).choices("bcdfghklmnprst", k=7)) for k in range(150)]
    docs, labels = _toxic_table(spark, lambda rng, k: rng.sample(rare, 2))      # each in 1.3 % of the toxic rows
    lexicon, w = toxicity.train(docs, labels, F.col("doc_id") < 5000)
    assert len({e for e, _ in lexicon} & {f"{x}$" for x in rare}) > 140
    assert not any(e.startswith("filler") for e, _ in lexicon)
    held = toxicity.score(docs.filter("doc_id >= 5000"), (lexicon, w)).toPandas()
    assert ((held["score"] >= 0.7) == (held["doc_id"] % 2 == 1)).mean() > 0.95


def test_toxicity_inflected_words(spark):
    Q.prepare(spark)
    forms = ["idiot", "idiots", "idiotic", "moron", "morons"]
    docs, labels = _toxic_table(spark, lambda rng, k: [rng.choices(forms, [6, 1, 1, 6, 1])[0]], 1200)
    model = toxicity.train(docs, labels, F.lit(True))
    assert {f"{x}$" for x in forms} <= {e for e, _ in model[0]}
    tried = spark.createDataFrame([(k, f"filler1 filler2 {x} filler3 filler4") for k, x in enumerate(forms)] + [(9, "filler1 filler2 filler3")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.score(tried, model).collect()}
    assert min(score[k] for k in range(5)) >= 0.7 > score[9]


def test_label_model_discounts_correlated_voters():
    rng = np.random.default_rng(3)
    y = rng.random(6000) < 0.2
    vote = lambda hit, false: np.where(y, rng.random(6000) < hit, rng.random(6000) < false)
    echo = vote(0.5, 0.03)
    v = np.stack([vote(0.6, 0.02), vote(0.5, 0.02), vote(0.4, 0.01), vote(0.5, 0.02), echo, echo, echo], axis=1)
    model = toxicity.LabelModel(0.2)
    q = model.fit(v)
    assert model.weight[:4].min() > 0.7 and model.weight[4:].max() < 0.6
    assert ((q > 0.5) == y).mean() > 0.93
    assert abs(model.p1[0] - 0.6) < 0.1 and model.p0[0] < 0.06


def test_toxicity_edges(spark):
    Q.prepare(spark)
    df = spark.createDataFrame(EDGE, "doc_id long, text string, score int, lang string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels, F.lit(True))
    scores = [r["score"] for r in toxicity.score(df, model).collect()]
    assert len(scores) == 6 and all(0 <= s < 0.7 for s in scores)
    assert toxicity.score(df.limit(0), model).count() == 0


def _top(rows, k, every):
    out = []
    usable = [(i, [int(np.floor(np.float64(x) * 256)) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for n, (i, q) in enumerate(usable):
        if i % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(usable) if m != n and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_top_k(spark):
    Q.prepare(spark)
    rng = np.random.default_rng(0)
    rows = [(int(k), [float(np.float32(x)) for x in rng.normal(size=24)]) for k in range(300)]
    rows += [(400 + k, rows[50][1]) for k in range(7)]                       # ties
    rows += [(100, rows[3][1]), (None, rows[1][1]), (500, None), (550, [1.0, None] * 12), (600, [float("nan")] * 24), (650, [float("inf")] * 24), (700, []),
             (750, [0.5, -1.0]), (800, [2.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df).collect())
    assert got == _top(rows, 5, 50)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_many_blocks_and_rounds(spark, monkeypatch):
    """Small blocks and rounds: floors are carried over blocks, ties lie in different ones."""
    Q.prepare(spark)
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "ROUND_BYTES", 700)
    rng = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in rng.normal(size=40)]) for k in range(400)]
    rows += [(1000 + k, rows[50][1]) for k in range(30)] + [(2000 + 50 * k, [1.0, -0.5]) for k in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == _top(rows, 5, 50)
    assert topk.top_k(df.filter("vec_id % 50 != 0")).count() == 0


def test_top_k_beyond_exact_floats(spark):
    Q.prepare(spark)
    rows = [(k, [1e6 + k / 7, -5e6 + k, float(k)]) for k in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == _top(rows, 5, 50)


def test_components(spark):
    rng = random.Random(6)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)] + [(900, 900 + k) for k in range(1, 80)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sparse_votes_equal_dense_ones():
    rng = np.random.default_rng(5)
    toxic = rng.random(600) < 0.3
    v = rng.random((600, 9)) < np.where(toxic[:, None], 0.4, 0.02)
    v[:, 8] = v[:, 7]                                            # two voters that always agree
    votes = toxicity.Votes.of(v)
    w, q = rng.normal(size=9), rng.random(600)
    assert np.allclose(votes.sums(w), v @ w) and np.allclose(votes.totals(q), q @ v)
    i, j, n = votes.pairs()
    both = v.T.astype(int) @ v.astype(int)
    assert {(a, b): k for a, b, k in zip(i.tolist(), j.tolist(), n.tolist())} == {(a, b): both[a, b] for a in range(9) for b in range(a + 1, 9) if both[a, b]}
    model = toxicity.LabelModel(0.3)
    post = model.fit(votes)
    assert ((post > 0.5) == toxic).mean() > 0.9
    r = v - (post[:, None] * model.p1 + (1 - post)[:, None] * model.p0)
    cov = r.T @ r / len(v)
    want = cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov)))
    for a, b, c in zip(*model.correlation):
        assert abs(want[a, b] - c) < 0.05
    assert model.weight[7] < 0.6 and model.weight[8] < 0.6 and model.weight[0] > 0.8


def test_a_thousand_toxic_words_are_all_voters(spark):
    Q.prepare(spark)
    rng = random.Random(1)
    words, plain = [f"bad{'abcdefghij'[k % 10]}{k}x" for k in range(1000)], [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(rng.choice(plain) for _ in range(30)), 0) for k in range(1500)]
    for k in range(1500):
        text = [rng.choice(plain) for _ in range(30)]
        for x in rng.sample(words, 12):
            text.insert(rng.randint(1, 30), x)
        rows.append((2000 + k, " ".join(text), 1))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    lexicon = toxicity.mine_lexicon(toxicity.sample_rows(docs, labels, F.lit(True), "text", "doc_id", "toxic", 5000).cache())
    assert sum(e.rstrip("$") in set(words) for e, _ in lexicon) > 900


def test_samples_count_a_repeated_id_once(spark):
    Q.prepare(spark)
    many = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word text "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    few = spark.range(40).select((F.col("id") + 100).alias("doc_id"), F.lit("other text here").alias("text"), F.lit("en").alias("lang"))
    docs = many.unionByName(few)
    labels = docs.select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), (F.col("doc_id") % 2).cast("int").alias("quality"))
    assert toxicity.sample_rows(docs, labels, F.lit(True), "text", "doc_id", "toxic", 100).count() == 41
    assert langid.training_rows(docs, F.lit(True), "text", "lang", "doc_id", 100).count() == 41
    assert quality.train(docs, labels, F.lit(True), rows=100) is not None


def test_a_text_of_marks_alone_has_no_language(spark):
    Q.prepare(spark)
    docs = spark.createDataFrame([(k, "les mots de la phrase", "fr") for k in range(30)] + [(k + 50, "words of the sentence", "en") for k in range(30)]
                                 + [(900, "́̀ ̈", None), (901, "é", None)], "doc_id long, text string, lang string")
    model, limits = langid.train(docs, F.lit(True))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs.drop("lang"), model, limits).collect()}
    assert got[900] == "und" and got[901] != "und"


def test_language_models_are_trained_on_every_row(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: "".join(letters[k // 26 ** j % 26] for j in range(4))
    n = langid.SAMPLE_ROWS + 700
    rows = [(k, word(7 * k), "en") for k in range(n)] + [(n, " ".join(word(7 * k) for k in range(n, n + 6000)), "fi")]
    rows.append((3, "zzzz", "en"))          # a repeated id counts once, with its smallest text
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, limits = langid.train(docs, F.lit(True))
    kept = docs.filter(F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(10)) > 0).filter("text <> 'zzzz'").toPandas()
    assert len(kept) > langid.SAMPLE_ROWS
    want = {lang: set(langid.grams(*langid.fold(part["text"].tolist())).tolist()) for lang, part in kept.groupby("lang")}
    assert set(model.keys[langid.ORDER].tolist()) == set().union(*want.values())
    assert model.languages == sorted(want)
