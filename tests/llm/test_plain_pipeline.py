"""The pipeline's stages against plain versions: each stage's rows and texts
are worked out again, document by document, from the stage's own input."""

import math
import os
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline as C
from sluice.llm import langid, quality, secretscan
from sluice.llm import queries as Q
from sluice.llm import text as T
from sluice.session import materialize

SF = "/root/testdata/sf0.001"
FOREIGN = 20_000


# ── language models by the formula ────────────────────────────────────────
def squeeze(text: str) -> str:
    """A blank and the folded words, single blanks between."""
    low = (c.lower() if len(c.lower()) == 1 else c for c in text)
    kept = "".join(c if unicodedata.category(old)[0] in "LM" else " " for c, old in zip(low, text))
    return " " + " ".join(w for w in kept.split(" ") if w)


def grams_of(text: str) -> list[str]:
    s = squeeze(text)
    return [(" " * langid.ORDER + s)[k + 1: k + 1 + langid.ORDER] for k in range(len(s))]


class PlainModel:
    """Interpolated Kneser-Ney of one language, straight from its formula."""

    def __init__(self, texts):
        self.n = {langid.ORDER: Counter(g for t in texts for g in grams_of(t))}
        for order in range(langid.ORDER, 1, -1):
            self.n[order - 1] = Counter(g[1:] for g in self.n[order])       # how many characters it follows
        self.total, self.kinds, self.discount, self.memo = {}, {}, {}, {}
        for order, counts in self.n.items():
            self.total[order], self.kinds[order] = Counter(), Counter()
            for g, n in counts.items():
                self.total[order][g[:-1]] += n
                self.kinds[order][g[:-1]] += 1
            once, twice = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
            self.discount[order] = once / (once + 2 * twice) if once and twice else 0.5

    def p(self, gram: str) -> float:
        order = len(gram)
        if order == 0:
            return 1 / langid.UNSEEN
        if gram not in self.memo:
            context, below = gram[:-1], self.p(gram[1:])
            total = self.total[order][context]
            d = self.discount[order]
            self.memo[gram] = (max(self.n[order][gram] - d, 0) + d * self.kinds[order][context] * below) / total if total else below
        return self.memo[gram]

    def entropy(self, text: str) -> float:
        grams = grams_of(text)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def test_language_models_by_their_formula():
    texts = {"a": ["The cat sat on the mat.", "A dog, a cat & 3 hens!", "the the the"], "b": ["Der Hund saß im Haus", "ÄRGER über Öl", "das Haus"]}
    counts = []
    for own in texts.values():
        key, n = np.unique(langid.grams(*langid.fold(own)), return_counts=True)
        counts.append((key, n))
    model = langid.Model(list(texts), counts)
    asked = ["the house", "Das Öl", "zzz qqq", "cat", "", "1 2 3", "Ωμέγα", "a"]
    h, letters = model.entropy(asked)
    for k, t in enumerate(asked):
        assert letters[k] == sum(unicodedata.category(c)[0] == "L" for c in t)
        for j, own in enumerate(texts.values()):
            assert h[k, j] == pytest.approx(PlainModel(own).entropy(t), rel=1e-4)


# ── the stages ────────────────────────────────────────────────────────────
@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output, the foreign text joining before the language stage."""
    if not os.path.exists(SF):
        pytest.skip("driver tables not present")
    Q.prepare(spark)
    d = str(tmp_path_factory.mktemp("plain"))
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    first, longest = docs.iloc[0], docs.loc[docs["text"].str.len().idxmax()]
    more = [(10_001, first.text, "en", "s", 1), (10_002, None, None, "s", 0), (10_003, "", "en", "s", 0), (0, first.text, "en", "s", 1),
            (10_004, longest.text.upper(), "en", "s", 1), (10_005, longest.text + " one more word here", "en", "s", 1)]
    both = pd.concat([docs, pd.DataFrame(more, columns=docs.columns)], ignore_index=True)
    both.astype({"doc_id": "int64", "n_chars": "int64"}).to_parquet(f"{d}/documents.parquet")
    pd.read_parquet(f"{SF}/labels.parquet").to_parquet(f"{d}/labels.parquet")
    foreign = " ".join("".join(chr(0x3B1 + (k * k * 7 + j * 5 + k) % 24) for j in range(3 + k % 6)) + ("." if k % 11 == 10 else "") for k in range(300))
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in C.STAGES:
        if name == "language_id":
            row = spark.createDataFrame([(FOREIGN, foreign, None, "s", len(foreign))], docs.schema)
            docs = materialize(docs.unionByName(row), "with-foreign")
        before = docs
        docs = materialize(stage(spark, docs, d), name)
        out[name] = (before, docs, d)
    return out


def ids(df) -> list:
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_quality_stage(spark, steps):
    before, after, d = steps["quality_classifier"]
    w, t, slope, intercept = quality.train(before, spark.read.parquet(f"{d}/labels.parquet"), C.crc_bucket("doc_id", 4) != 2)
    kept, near = [], 0
    for r in before.collect():
        own, per_doc, size = quality.line_features(*T.utf8(pa.array([r.text or ""])))
        unary = quality.with_neighbours(own, per_doc) @ w
        add = lambda x: np.logaddexp.reduce(x, axis=0)
        fore, back = [unary[0]], [np.zeros(2)]
        for u in unary[1:]:
            fore.append(u + add(fore[-1][:, None] + t))
        for u in unary[:0:-1]:
            back.insert(0, add((t + u + back[0]).T))
        both = np.array(fore) + np.array(back)
        good = np.exp(both[:, 1] - add(both.T))
        q = min(max(float((good * (size + 1e-6)).sum() / (size + 1e-6).sum()), 1e-4), 1 - 1e-4)
        score = 1 / (1 + math.exp(-min(max(slope * math.log(q / (1 - q)) + intercept, -30), 30)))
        near += abs(score - C.LEAST_QUALITY) < 1e-6
        if score >= C.LEAST_QUALITY:
            kept.append(r.doc_id)
    assert near == 0 and ids(after) == sorted(kept) and 0.6 * before.count() < len(kept) < before.count()


def test_language_stage(spark, steps):
    before, after, _ = steps["language_id"]
    fold = C.crc_bucket("doc_id", 5) != 0
    sample = langid.training_rows(before, fold, "text", "lang", "doc_id", langid.SAMPLE_ROWS).filter("part > 0").toPandas()
    plain = {name: PlainModel(own["text"]) for name, own in sample.groupby("lang")}
    model, limits = langid.train(before, fold)
    assert model.languages == sorted(plain)
    kept = []
    for r in before.collect():
        letters = sum(unicodedata.category(c)[0] == "L" for c in r.text or "")
        if not letters:
            continue
        h = {name: m.entropy(r.text) for name, m in plain.items()}
        best = min(h, key=h.get)
        mean, sigma, gap = limits[best]
        if h[best] <= mean + max(langid.REJECT * sigma / math.sqrt(letters), langid.FOREIGN * gap):
            kept.append(r.doc_id)
    assert ids(after) == sorted(kept)
    assert FOREIGN in ids(before) and FOREIGN not in kept
    assert len(kept) >= 0.97 * (before.count() - 3)


def test_jaccard_stage(steps):
    before, after, _ = steps["ngram_jaccard_join"]
    rows = before.toPandas()
    sets = []
    for text in rows["text"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(words[k: k + 4]) for k in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set())
    own = list(range(len(rows)))

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    own[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(int(rows["doc_id"][k]))
    wanted = sorted(min(g) for g in groups.values())
    assert ids(after) == wanted and len(wanted) < len(rows)
    texts = dict(zip(rows["doc_id"], rows["text"]))
    assert all(texts[r.doc_id] == r.text for r in after.collect())


def test_secret_stage(steps):
    before, after, _ = steps["secret_scans"]
    found = {r.doc_id: r.spans for r in secretscan.find_secrets(before).collect()}
    now = {r.doc_id: r for r in after.collect()}
    changed = 0
    for r in before.collect():
        text, to, out = r.text or "", 0, []
        for s in sorted(found[r.doc_id], key=lambda s: (s.start, s.end)):
            if s.start >= to:
                out += [text[to: s.start], "[SECRET]"]
            to = max(to, s.end)
        out = "".join([*out, text[to:]])
        changed += out != text
        assert (now[r.doc_id].text or "") == out and now[r.doc_id].n_chars == len(out)
        for m in re.finditer(r"AKIA[A-Z0-9]+", text):
            assert len(m.group()) < 18 or m.group() not in out
        for m in re.finditer(r"[0-9a-f]+", text):
            assert len(m.group()) < 16 or m.group() not in out
    assert len(now) == before.count() and changed > 0


def test_packing_stage(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    before, after, _ = steps["best_fit_packing"]
    got = after.toPandas()
    for r in before.collect():
        whole = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        own = got[got["doc_id"] == r.doc_id].sort_values("piece")
        assert own["piece"].tolist() == list(range(-(-len(whole) // 2048)))
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist() and own["length"].sum() == len(whole)
        assert (own["length"].iloc[1:] == 2048).all()
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(whole[p.start: p.start + p.length].tobytes())
    assert set(got["doc_id"]) == set(ids(before))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == (s["length"].cumsum() - s["length"]).tolist() and s["length"].sum() <= 2048
