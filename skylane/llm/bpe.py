"""BPE encoding and decoding by speculation.

A word's tokens are first guessed by greedy longest match. The guess is the
exact result if every pair of neighbours is compatible: merging the two
tokens' symbols alone would never join anything across their border. All new
pairs of a batch are tested together, stepping both tokens back through their merges
in arrays. Only words with a failing pair are merged exactly.

Which words a text has follows the tokenizer file: its added tokens, its normaliser
and its pre-tokenizer, which the library applies to a spelling; spellings of printable
ASCII take the same rules as a pattern here. White space never joins words, so
each spelling between ASCII white space is worked out once and remembered (at
most twice ``CACHE`` spellings a worker).

Defined results: null text counts as empty, which has no ids and decodes to "".
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skylane.llm.common import pieces, ship

CACHE = 300_000
SPELLING = re.compile(r"[^ \t\n\r\x0b\x0c]+")
PLAIN = re.compile(r"[!-~]+\Z")
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
LONG_WORD = 2000
_NONE = np.iinfo(np.int64).max
_loaded: dict[str, SpeculativeBPE] = {}


class SpeculativeBPE:
    """Encoder and decoder of a lower-case word-end BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.size = size
        self.name = [""] * size
        for t, i in [*self.vocab.items(), *self.added.items()]:
            self.name[i] = t
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # of each token its parts and the rank of the merge that makes it, -1 for a single symbol
        self.left, self.right, self.rank = np.arange(size), np.arange(size), np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            i, j, k = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge[i, j] = (r, k)
            if self.rank[k] < 0:
                self.left[k], self.right[k], self.rank[k] = i, j, r
        key = np.array([i * size + j for i, j in self.merge], np.int64)
        order = np.argsort(key)
        self.pair_key, self.pair_rank = key[order], np.array([r for r, _ in self.merge.values()], np.int64)[order]
        # a token that its own symbols would not merge into must not be guessed
        parts = np.flatnonzero(self.rank >= 0)
        sound = np.ones(size, bool)
        sound[parts] = self._joins_first(self.left[parts], self.right[parts], self.rank[parts])
        for k in sorted(parts, key=self.rank.__getitem__):
            sound[k] &= sound[self.left[k]] and sound[self.right[k]]
        self.guess = {t: i for t, i in self.vocab.items() if sound[i]}
        self.made = np.zeros(max(len(merges), 1), np.int64)
        for r, (a, b) in enumerate(merges):
            self.made[r] = self.vocab[a + b]
        # single symbols by code point, and the same at a word's end
        single = {ord(t): i for t, i in self.vocab.items() if len(t) == 1}
        self.symbol, self.symbol_end = np.zeros(max(single) + 1, np.int64), np.zeros(size, np.int64)
        for c, i in single.items():
            self.symbol[c], self.symbol_end[i] = i, self.vocab[chr(c) + self.end]
        self.reach: dict[str, int] = {}
        for t in self.guess:
            t = t.removesuffix(self.end)
            self.reach[t[:2]] = max(self.reach.get(t[:2], 1), len(t))
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    @classmethod
    def at(cls, path: str) -> SpeculativeBPE:
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether nothing would be merged across the border of each pair of tokens."""
        return self._walk(a, b, np.full(len(a), _NONE))

    def _joins_first(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether the merge of ``rank`` is the first across the border of each pair."""
        return self._walk(a, b, rank)

    def _walk(self, a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
        """No merge across the border with a rank under ``before`` happens while both sides stand.

        Going back in time, the side that was merged last is undone. What stood
        before could only have met the other side earlier than that merge; at one
        rank the left border merges first.
        """
        ok = np.ones(len(a), bool)
        at, a, b, limit = np.arange(len(a)), a.copy(), b.copy(), before.copy()
        while len(at):
            met = self._pair_ranks(a, b)
            bad = (met < limit) & (met != _NONE)
            ok[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            more = ~bad & ((ra >= 0) | (rb >= 0))
            at, a, b, ra, rb = at[more], a[more], b[more], ra[more], rb[more]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def greedy(self, word: str) -> list[int]:
        """Longest token first, from the left; [] where no sound token fits."""
        out, i, n, guess, end, reach = [], 0, len(word), self.guess, self.end, self.reach
        while i < n:
            top = min(n, i + reach.get(word[i : i + 2], 1))
            t = guess.get(word[i:] + end) if top == n else None
            if t is not None:
                out.append(t)
                return out
            for j in range(top if top < n else n - 1, i, -1):
                t = guess.get(word[i:j])
                if t is not None:
                    out.append(t)
                    i = j
                    break
            else:
                return []
        return out

    def exact(self, words: list[str]) -> list[list[int]]:
        """Merge words by rank, leftmost first: one round makes each word's next merge, for all words at once."""
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        if long:
            out = self.exact([w if len(w) <= LONG_WORD else "" for w in words])
            for k in long:
                out[k] = self._exact_long(words[k])
            return out
        n = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        owner = np.repeat(np.arange(len(words)), n)
        if not len(ids):
            return [[] for _ in words]
        last = np.append(owner[1:] != owner[:-1], True)
        ids[last] = self.symbol_end[ids[last]]
        done_owner, done_ids = [], []
        while len(ids):
            rank = np.full(len(ids), _NONE)
            side = np.flatnonzero(owner[1:] == owner[:-1])
            rank[side] = self._pair_ranks(ids[side], ids[side + 1])
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(start, len(ids)))
            low = np.repeat(np.minimum.reduceat(rank, start), size)
            over = low == _NONE
            if over.any():
                done_owner.append(owner[over])
                done_ids.append(ids[over])
                ids, owner, rank, low = ids[~over], owner[~over], rank[~over], low[~over]
                if not len(ids):
                    break
            hit = rank == low
            at = np.arange(len(ids))
            fresh = hit & ~np.append(False, hit[:-1])
            run = np.maximum.accumulate(np.where(fresh, at, 0))
            take = hit & ((at - run) % 2 == 0)  # of overlapping equal pairs the left one merges
            ids = np.where(take, self.made[np.where(take, rank, 0)], ids)
            stay = ~np.append(False, take[:-1])
            ids, owner = ids[stay], owner[stay]
        owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
        order = np.argsort(owner, kind="stable")
        cut = np.cumsum(np.bincount(owner, minlength=len(words)))
        flat = ids[order].tolist()
        return [flat[a:b] for a, b in zip([0, *cut.tolist()], cut.tolist())]

    def _exact_long(self, word: str) -> list[int]:
        """The same for one very long word, with a heap over a linked list."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.end]]
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*merge[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merge]
        heapq.heapify(heap)
        while heap:
            _, made, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or merge.get((ids[i], ids[j]), (0, -1))[1] != made:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (m := merge.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (*m, a))
        return [t for t in ids if t >= 0]

    def words(self, spelling: str) -> list[str | int]:
        """Pre-tokenized words (byte-level characters) of a spelling; added tokens as their ids."""
        out: list[str | int] = []
        for part in self.special.split(spelling) if self.special else [spelling]:
            if part in self.added:
                out.append(self.added[part])
            elif part and PLAIN.match(part):
                out += ASCII_WORD.findall(part.lower())
            elif part:
                out += [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(part))]
        return out

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        ids = [self.greedy(w) for w in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((t for row in ids for t in row), np.int64, int(n.sum()))
        owner = np.repeat(np.arange(len(ids)), n)
        side = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, np.int64)
        key, back = np.unique(flat[side] * self.size + flat[side + 1], return_inverse=True)
        known = np.fromiter((self.fits.get(k, -1) for k in key.tolist()), np.int8, len(key))
        new = known < 0
        if new.any():
            tested = self.compatible(key[new] // self.size, key[new] % self.size)
            known[new] = tested
            if len(self.fits) > 4 * CACHE:
                self.fits.clear()
            self.fits.update(zip(key[new].tolist(), map(bool, tested)))
        failing = set(owner[side][known[back] == 0].tolist()) | set(np.flatnonzero(n == 0).tolist())
        failing = sorted(failing)
        for k, row in zip(failing, self.exact([words[k] for k in failing])):
            ids[k] = row
        return ids

    def learn(self, spellings: list[str]) -> None:
        """Work out spellings and remember their ids and decoded text."""
        split = [self.words(s) for s in spellings]
        new = list({w for row in split for w in row if isinstance(w, str)})
        of = dict(zip(new, self._encode_words(new)))
        name = self.name
        for s, row in zip(spellings, split):
            ids = [t for w in row for t in (of[w] if isinstance(w, str) else (w,))]
            self.known[s] = (np.array(ids, "<u4").tobytes(), " ".join([name[t] for t in ids]))

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        if len(self.known) > CACHE:  # what is still met moves over from the older half
            self.known, self.older = {}, self.known
        rows = [SPELLING.findall(t) if t else [] for t in texts]
        known, older = self.known, self.older
        new = []
        for s in {s for row in rows for s in row if s not in known}:
            if s in older:
                known[s] = older[s]
            else:
                new.append(s)
        for lo in range(0, len(new), 50_000):
            self.learn(new[lo : lo + 50_000])
        out = []
        for row in rows:
            got = [known[s] for s in row]
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])))
        return out

    def decode(self, ids: bytes) -> str:
        """Token texts joined by one space, as the file has no decoder."""
        return " ".join([self.name[t] for t in np.frombuffer(ids, "<u4")])


def _batches(path: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = SpeculativeBPE.at(path)
        for batch in batches:
            for part in pieces(batch, "text"):
                got = bpe.encode(part.column("text").to_pylist())
                made = {"ids": pa.array([g[0] for g in got], pa.binary()), "n_tokens": pa.array([len(g[0]) // 4 for g in got], pa.int64()), "decoded": pa.array([g[1] for g in got], pa.string())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names)

    return run


def bpe_encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ids (binary, little-endian 32-bit), n_tokens and decoded.

    Other columns are passed on; columns of these names are replaced.
    """
    ship(docs.sparkSession)
    src = docs.drop("ids", "n_tokens", "decoded")
    schema = T.StructType([*src.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())])
    return src.mapInArrow(_batches(path or public_tokenizers.path("word_bpe_49k.json"), schema.names), schema)
