"""Operator 5: byte-level BPE encoding by speculation and verification.

Texts are cut into words by a vectorised form of the byte-level split pattern
(class runs over code points), each batch keeps one copy of every distinct
word, and only words unseen by the task are encoded:

1. *speculate*: greedy longest match proposes tokens for each new word;
2. *verify*: every adjacent pair of proposed tokens is tested for
   compatibility (would exact merging keep that border?), all pairs of the
   batch at once; a sequence whose adjacent pairs are all compatible is the
   exact encoding;
3. *repair*: only words with an incompatible pair undergo exact merging.

``WordEncoder`` takes the function that encodes new words, so the packing and
file operators reuse the splitting and the word table with the tokenizers
library as that function.  The tokenizer file is a path parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm import text as T

#: Words that a worker's table keeps; it starts anew beyond that (bounded memory).
WORD_TABLE = 1_500_000
_LETTER, _NUMBER, _OTHER, _SPACE, _END = range(5)
_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of every code point for the byte-level split pattern.

    Two Unicode tables are at hand and may be of different versions; where
    they disagree, the library's own splitter says which class it uses.
    """
    global _classes
    if _classes is None:
        import regex
        from tokenizers import pre_tokenizers

        points = np.arange(0x110000, dtype="<u4")
        points[0xD800:0xE000] = 0x21
        whole = points.tobytes().decode("utf-32-le")
        table = np.full(0x110000, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, whole):
                table[m.start(): m.end()] = kind
        kinds = {"L": _LETTER, "N": _NUMBER}
        other = np.fromiter((kinds.get(c[0], _OTHER) for c in map(unicodedata.category, whole)), np.uint8, len(whole))
        splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        for at in np.flatnonzero((table != other) & (table != _SPACE)).tolist():
            joins = [len(splitter.pre_tokenize_str(lead + whole[at])) == 1 for lead in "a1!"]
            table[at] = joins.index(True) if any(joins) else _SPACE
        _classes = table
    return _classes


def split_words(cp: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Word starts of code points ``cp``; ``cls`` marks segment ends as _END
    (each end is a word of its own)."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64)
    run = np.ones(n, bool)
    run[1:] = cls[1:] != cls[:-1]
    space = cls == _SPACE
    blank = space & (cp == 32)
    end = cls == _END
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    start = run & ~(after_blank & ~space & ~end)
    start |= end
    # The last white space before a word is its own start (a blank joins that word).
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~end[1:]
    start |= last
    # Contractions: a lone apostrophe at a word start takes its letters along.
    ap = np.flatnonzero((cp[:-1] == 39) & start[:-1] & (cls[1:] == _LETTER)) if n > 1 else []
    if len(ap):
        c1 = cp[ap + 1]
        c2 = np.where(ap + 2 < n, cp[np.minimum(ap + 2, n - 1)], 0)
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        size = np.where(one, 2, np.where(two, 3, 0))
        ap, size = ap[size > 0], size[size > 0]
        start[ap + 1] = False
        rest = ap + size
        rest = rest[rest < n]
        start[rest] = True
    return np.flatnonzero(start)


class WordEncoder:
    """Encodes batches of texts; only words new to the table meet ``encode_words``.

    The table is a few sorted hash arrays (each new batch of words is one; the
    last two merge while they are of like size), with the ids in one buffer.
    """

    def __init__(self, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], specials: dict[str, int]):
        self.encode_words, self.specials = encode_words, specials
        self._clear()

    def _clear(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids, self.used, self.words = np.zeros(1 << 16, np.uint32), 0, 0

    def _find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of each word; place -1 if unknown."""
        at, size = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
        for keys, where, count in self.levels:
            spot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = np.flatnonzero(keys[spot] == key)
            at[hit], size[hit] = where[spot[hit]], count[spot[hit]]
        return at, size

    def _learn(self, keys: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = self.encode_words(words)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(self.ids), len(flat)), np.uint32)])
        at = np.cumsum(sizes) - sizes + self.used
        self.ids[self.used: self.used + len(flat)] = flat
        self.used += len(flat)
        self.words += len(keys)
        new = (keys, at, sizes)
        while self.levels and len(self.levels[-1][0]) < 2 * len(new[0]):
            old = self.levels.pop()
            order = np.argsort(np.concatenate([old[0], new[0]]), kind="stable")
            new = tuple(np.concatenate([x, y])[order] for x, y in zip(old, new))
        self.levels.append(new)
        return at, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of each text in them)."""
        segments, kinds = [], []
        for t in texts:
            special = [(s, i) for s, i in self.specials.items() if s in t]
            if special:
                import re

                by = dict(special)
                parts = re.split("(" + "|".join(re.escape(s) for s in sorted(by, key=len, reverse=True)) + ")", t)
                segments += parts[::2]
                kinds += [by[p] for p in parts[1::2]] + [-1]
            else:
                segments.append(t)
                kinds.append(-1)
        joined = "\n".join([*segments, ""])
        cp = T.code_points(joined)
        cls = char_classes()[cp]
        ends = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)) + 1) - 1
        cls[ends] = _END
        starts = split_words(cp, cls)
        lens = np.diff(np.append(starts, len(cp)))
        is_end = cls[starts] == _END
        real = np.flatnonzero(~is_end)
        key, first, inverse = np.unique(T.span_hash(cp, starts, lens)[real], return_index=True, return_inverse=True)
        if self.words + len(key) > WORD_TABLE:
            self._clear()
        at_key, size_key = self._find(key)
        new = np.flatnonzero(at_key < 0)
        if len(new):
            where = real[first[new]]
            at_key[new], size_key[new] = self._learn(key[new], [joined[s: s + n] for s, n in zip(starts[where].tolist(), lens[where].tolist())])
        at, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        at[real], size[real] = at_key[inverse], size_key[inverse]
        ids = self.ids
        kinds = np.asarray(kinds, np.int64)
        tags = np.flatnonzero(is_end)
        if (kinds >= 0).any():   # special tokens stand where a segment ends
            special = kinds >= 0
            at[tags[special]] = len(ids) + np.arange(int(special.sum()))
            size[tags[special]] = 1
            ids = np.concatenate([ids, kinds[special].astype(np.uint32)])
        total = np.cumsum(size)
        flat = ids[np.repeat(at - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        return flat, np.concatenate([[0], total[tags[kinds < 0]]]).astype(np.int64)


_encoders: dict[tuple[str, str], WordEncoder] = {}


def worker_encoder(kind: str, path: str) -> WordEncoder:
    """The encoder of this Python worker: tasks of one worker share its table."""
    if (kind, path) not in _encoders:
        if kind == "library":
            _encoders[kind, path] = library_encoder(path)
        else:
            bpe = SpeculativeBpe(path)
            _encoders[kind, path] = WordEncoder(bpe.encode_words, bpe.special)
            _encoders[kind, path].bpe = bpe
    return _encoders[kind, path]


def library_encoder(path: str) -> WordEncoder:
    """New words are encoded by the tokenizers library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    newline = tok.encode("\n", add_special_tokens=False).ids[0]

    def words(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words go to the library in lines of 128: a line break never joins
        the word before or after it.  White space goes one by one."""
        flat: list[np.ndarray] = [np.zeros(0, np.uint32)]
        sizes = np.zeros(len(batch), np.int64)
        blank = np.fromiter(map(str.isspace, batch), bool, len(batch))
        solid = np.flatnonzero(~blank)
        lines = [solid[a: a + 128] for a in range(0, len(solid), 128)]
        order = []
        for a in range(0, len(lines), 64):
            texts = ["\n".join([*(batch[k] for k in line.tolist()), ""]) for line in lines[a: a + 64]]
            for line, e in zip(lines[a:], tok.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.asarray(e.ids, np.uint32)
                brk = np.flatnonzero(ids == newline)
                if len(brk) != len(line):
                    raise ValueError("the tokenizer does not keep line breaks apart")
                sizes[line] = np.diff(brk, prepend=-1) - 1
                flat.append(np.delete(ids, brk))
                order.append(line)
        for k in np.flatnonzero(blank).tolist():
            ids = np.asarray(tok.encode(batch[k], add_special_tokens=False).ids, np.uint32)
            sizes[k] = len(ids)
            flat.append(ids)
            order.append(np.array([k]))
        # Back from the order of encoding to the order of the words.
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        ids, got = np.concatenate(flat), sizes[order]
        at = np.zeros(len(batch), np.int64)
        at[order] = np.cumsum(got) - got
        total = np.cumsum(sizes)
        return ids[np.repeat(at - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)], sizes

    return WordEncoder(words, specials(path))


def specials(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


class SpeculativeBpe:
    """Exact BPE of single words by speculate, verify, repair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = token.encode() if token in self.special else bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.id_of = {b: i for i, b in enumerate(self.bytes_of) if b and i not in self.special.values()}
        self.longest = max(map(len, self.id_of))
        n = self.n = len(self.bytes_of)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank_of = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        # A token's birth: the rank of the merge that makes it (0 for single bytes), its two halves, and the merge table by pair.
        self.birth = np.zeros(n, np.int64)
        self.halves = np.stack([np.arange(n), np.arange(n)])
        for r in range(len(merges) - 1, -1, -1):
            self.birth[made[r]], self.halves[0, made[r]], self.halves[1, made[r]] = r + 1, left[r], right[r]
        pairs = left * n + right
        order = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[order], order + 1
        self.known = np.zeros(0, np.int64)
        self.verdict = np.zeros(0, bool)
        self.repaired = self.seen = 0

    # -- speculate -----------------------------------------------------------
    def greedy(self, word: bytes) -> list[int]:
        out, at, n, id_of, longest = [], 0, len(word), self.id_of, self.longest
        while at < n:
            to = min(n, at + longest)
            while (i := id_of.get(word[at:to])) is None:
                to -= 1
            out.append(i)
            at = to
        return out

    # -- verify --------------------------------------------------------------
    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does exact merging of their joined bytes
        keep the border between them?

        Undo the later-born of the two inner tokens step by step; the border
        breaks if, at some moment of the merge history, the two tokens that
        stand at the border form a merge that comes before the merge that
        would consume the one undone last.  (Ties: the left merge goes first.)
        """
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        # Merges at the border must come before this time to happen: births, doubled to order ties.
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            x, y = a[live], b[live]
            key = x * self.n + y
            spot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            time = np.where(self.pairs[spot] == key, 2 * self.pair_rank[spot], np.iinfo(np.int64).max)
            broken = time < limit[live]
            ok[live[broken]] = False
            bx, by = self.birth[x], self.birth[y]
            alive = ~broken & ((bx > 0) | (by > 0))
            live, x, y, bx, by = live[alive], x[alive], y[alive], bx[alive], by[alive]
            left = bx > by
            # The left token's last merge stands before the border: it wins a tie; the right one's comes after it.
            limit[live] = np.where(left, 2 * bx, 2 * by + 1)
            a[live] = np.where(left, self.halves[1, x], x)
            b[live] = np.where(left, y, self.halves[0, y])
        return ok

    def _check(self, key: np.ndarray) -> np.ndarray:
        """Compatibility of distinct sorted pair keys, remembered across batches."""
        spot = np.searchsorted(self.known, key)
        have = np.zeros(len(key), bool)
        inside = spot < len(self.known)
        have[inside] = self.known[spot[inside]] == key[inside]
        out = np.zeros(len(key), bool)
        out[have] = self.verdict[spot[have]]
        new = key[~have]
        if len(new):
            out[~have] = res = self.compatible(new // self.n, new % self.n)
            if len(self.known) > 2_000_000:
                self.known, self.verdict = new, res
            else:
                joined = np.concatenate([self.known, new])
                order = np.argsort(joined)
                self.known, self.verdict = joined[order], np.concatenate([self.verdict, res])[order]
        return out

    # -- repair --------------------------------------------------------------
    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost on ties."""
        n = len(word)
        tok: list[int] = [self.id_of[word[i: i + 1]] for i in range(n)]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank_of
        heap = [(r[0], i, tok[i], tok[i + 1], r[1]) for i in range(n - 1) if (r := rank.get((tok[i], tok[i + 1])))]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, x, y, m = heapq.heappop(heap)
            j = nxt[i]
            if gone[i] or tok[i] != x or j >= n or tok[j] != y:
                continue
            tok[i], gone[j] = m, True
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if r := rank.get((m, tok[k])):
                    heapq.heappush(heap, (r[0], i, m, tok[k], r[1]))
            if (p := prv[i]) >= 0 and (r := rank.get((tok[p], m))):
                heapq.heappush(heap, (r[0], p, tok[p], m, r[1]))
        return [tok[i] for i in range(n) if not gone[i]]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [w.encode("utf-8", "replace") for w in words]
        guess = [self.greedy(w) for w in raw]
        sizes = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter((i for g in guess for i in g), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        self.seen += len(words)
        if len(flat) < 2:
            return flat, sizes
        inner = np.ones(len(flat) - 1, bool)
        inner[(ends[:-1][ends[:-1] > 0] - 1)] = False
        at = np.flatnonzero(inner)
        key, inverse = np.unique(flat[at] * self.n + flat[at + 1], return_inverse=True)
        bad = at[~self._check(key)[inverse]]
        if not len(bad):
            return flat, sizes
        failing = np.unique(np.searchsorted(ends, bad, "right"))
        self.repaired += len(failing)
        for k in failing.tolist():
            guess[k] = self.merge(raw[k])
            sizes[k] = len(guess[k])
        return np.fromiter((i for g in guess for i in g), np.int64, int(sizes.sum())), sizes


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {chr(b): b for b in shown}, 0
    for b in range(256):
        if b not in shown:
            table[chr(0x100 + extra)] = b
            extra += 1
    return table


class Joined:
    """Per-id byte strings as one buffer: joins the strings of many ids at once."""

    def __init__(self, parts: list[bytes]):
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def join(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[ids]
        total = np.cumsum(size)
        src = np.repeat(self.at[ids] - (total - size), size) + np.arange(total[-1] if len(total) else 0)
        return self.data[src], np.concatenate([[0], total])[offsets]


def encode_decode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Encode every text, decode the ids again, and digest both.

    One row per input row: the id, ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by commas) and ``decoded_sha256``.  Null text is empty (0 tokens);
    repeated rows give repeated results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder("speculative", path)
        bpe = enc.bpe
        raw, digits = Joined(bpe.bytes_of), Joined([b"%d," % i for i in range(bpe.n)])
        for b in T.slices(batches, text):
            ids, off = enc.encode(T.text_column(b, text).to_pylist())
            back, boff = raw.join(ids, off)
            nums, noff = digits.join(ids, off)
            back, nums = back.tobytes(), nums.tobytes()
            yield pa.RecordBatch.from_arrays([
                b.column(id_col).cast(pa.int64()),
                pa.array(np.diff(off)),
                pa.array([hashlib.sha256(nums[s: max(s, e - 1)]).hexdigest() for s, e in zip(noff[:-1].tolist(), noff[1:].tolist())], pa.string()),
                pa.array([hashlib.sha256(back[s:e].decode("utf-8", "replace").encode()).hexdigest() for s, e in zip(boff[:-1].tolist(), boff[1:].tolist())], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
