"""Language identification by unigrams over a fixed vocabulary, marginalised over segmentations.

A language is a distribution over the byte pieces of a public vocabulary. The probability of
a word is the sum over all ways to cut it into pieces, which a forward algorithm adds up
from left to right; a text is its words, each a run of letters in lower case behind one
space. Nothing is ever tokenised one way: every segmentation counts with its weight.

The piece probabilities are learned by expectation maximisation over the words of a sample:
about ``sample`` rows of each language, equal texts once, chosen by a hash; that is the
documented bound of the fit. Expected counts are summed as integers, so the model does not depend on
how the rows are spread. Prediction covers every row and whole texts.

The model holds languages x pieces numbers, which is what every task receives. A run of
letters over ``STRETCH`` bytes counts as several stretches, so memory does not follow it.

Defined results: null text and text without a letter are ``und`` with score 0, and so is
everything where nothing was learned; rows without text or language are not learned from;
of equally likely languages the first by name is predicted; repeated rows get equal
results; the score is the predicted language's posterior.
"""

from __future__ import annotations

import base64
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.llm.common import Stash, pieces, ship

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
STRETCH = 64
UNIT = 1 << 16
SMOOTH = 0.01
#: No piece is less likely than this, give or take the division by the sum.
FLOOR = 1e-10
#: Each byte of a piece lifts its weight by this factor, so that products of a word stay in range.
LIFT = 64.0


def read_vocabulary(path: str) -> list[bytes]:
    """The pieces of a tiktoken rank file."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


def stretches(word: str) -> list[bytes]:
    """A word's bytes behind a space, in stretches of at most ``STRETCH`` bytes."""
    b = b" " + word.lower().encode()
    return [b] if len(b) <= STRETCH else [b[i : i + STRETCH] for i in range(0, len(b), STRETCH)]


def text_words(text: str | None) -> Counter:
    """How often each stretch stands in a text."""
    out: Counter = Counter()
    for word, n in Counter(LETTERS.findall(text or "")).items():
        for s in stretches(word):
            out[s] += n
    return out


class Lattice:
    """All segmentations of words over a vocabulary.

    The vocabulary is a trie of bytes. Its steps (node, byte) -> node lie in an open-addressed
    table, so many words walk it at once; a walk ends where no piece goes on.
    """

    def __init__(self, vocabulary: list[bytes]):
        self.size = len(vocabulary)
        self.longest = max(map(len, vocabulary))
        self.lift = LIFT ** np.array([len(p) for p in vocabulary], np.float64)
        step: dict[int, int] = {}
        piece = {}
        for k, p in enumerate(vocabulary):
            node = 0
            for b in p:
                node = step.setdefault(node << 8 | b, len(step) + 1)
            piece[node] = k
        self.piece = np.full(len(step) + 1, -1, np.int64)
        self.piece[list(piece)] = list(piece.values())
        bits = max(4, (4 * len(step)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        keys, nodes = np.array(list(step), np.uint64), np.array(list(step.values()), np.int64)
        self.key, self.node = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.key[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            at = free[first]
            self.key[slot[at]], self.node[slot[at]] = keys[at].astype(np.int64), nodes[at]
            todo = todo[self.key[slot[todo]] != keys[todo].astype(np.int64)]
            slot[todo] = (slot[todo] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _step(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node behind each node and byte; -1 where there is none."""
        want = nodes << 8 | byte
        slot = self._slot(want.astype(np.uint64))
        out = np.full(len(want), -1, np.int64)
        todo = np.arange(len(want))
        while len(todo):
            there = self.key[slot[todo]]
            hit = there == want[todo]
            out[todo[hit]] = self.node[slot[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
            slot[todo] = (slot[todo] + 1) & self.last
        return out

    def edges(self, words: list[bytes], n: int) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end 0..n of words of ``n`` bytes: (start, rows, pieces) where pieces end there."""
        byte = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n).astype(np.int64)
        out: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            rows, node = np.arange(len(words)), np.zeros(len(words), np.int64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                node = self._step(node, byte[rows, j - 1])
                on = node >= 0
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
                piece = self.piece[node]
                is_piece = piece >= 0
                if is_piece.any():
                    out[j].append((i, rows[is_piece], piece[is_piece]))
        return out

    def weights(self, p: np.ndarray) -> np.ndarray:
        """Lifted weights of (pieces, languages)."""
        return p * self.lift[:, None]

    def log_likelihood(self, words: list[bytes], weights: np.ndarray, part: int = 16384) -> np.ndarray:
        """(words, languages): log of the sum over all segmentations."""
        out = np.empty((len(words), weights.shape[1]))
        for n, at in by_length(words, part):
            alpha = np.zeros((n + 1, len(at), weights.shape[1]))
            alpha[0] = 1.0
            scale = np.full(alpha[0].shape, -n * np.log(LIFT))
            for j, ending in enumerate(self.edges([words[k] for k in at], n)):
                for i, rows, piece in ending:
                    alpha[j][rows] += alpha[i][rows] * weights[piece]
                if (small := alpha[j] < 1e-100).any():
                    # all sums that later ones build on are lifted alike
                    lift = np.where(small & (alpha[j] > 0), alpha[j], 1.0)
                    alpha[max(0, j - self.longest) : j + 1] /= lift
                    scale += np.log(lift)
            out[at] = np.log(alpha[n]) + scale
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, weights: np.ndarray, part: int = 16384) -> np.ndarray:
        """Expected uses of each piece by words of one language, in units of 1 / UNIT, from sums over both sides."""
        out = np.zeros(self.size, np.int64)
        for n, at in by_length(words, part):
            edges = self.edges([words[k] for k in at], n)
            alpha, beta = np.zeros((n + 1, len(at))), np.zeros((n + 1, len(at)))
            alpha[0] = beta[n] = 1.0
            for j, ending in enumerate(edges):
                for i, rows, piece in ending:
                    alpha[j][rows] += alpha[i][rows] * weights[piece]
            # a word beyond the range of doubles teaches nothing
            scale = np.divide(counts[at] * UNIT, alpha[n], out=np.zeros(len(at)), where=alpha[n] > 0)
            for j in range(n, 0, -1):
                for i, rows, piece in edges[j]:
                    w = weights[piece] * beta[j][rows]
                    beta[i][rows] += w
                    np.add.at(out, piece, np.rint(alpha[i][rows] * w * scale[rows]).astype(np.int64))
        return out


def by_length(words: list[bytes], part: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of words of one length, at most ``part`` of them and fewer for long words."""
    groups = defaultdict(list)
    for k, w in enumerate(words):
        groups[len(w)].append(k)
    for n, at in groups.items():
        step = max(1, part * 64 // (n * n))
        for lo in range(0, len(at), step):
            yield n, np.array(at[lo : lo + step])


@dataclass
class LanguageModel:
    """Piece probabilities (pieces, languages) and the share of each language."""

    vocabulary: list[bytes]
    languages: list[str] = field(default_factory=list)
    probabilities: np.ndarray | None = None
    shares: np.ndarray | None = None


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                seen[lang].update(text_words(text))
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])


def _expected_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, languages, p = shared.value
        lattice = Lattice(vocabulary)
        weights = lattice.weights(p)
        total = np.zeros((len(languages), lattice.size), np.int64)
        at = {lang: k for k, lang in enumerate(languages)}
        for batch in batches:
            groups: dict[str, list] = defaultdict(list)
            for lang, w, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                groups[lang].append((w, n))
            for lang, rows in groups.items():
                words, counts = zip(*rows)
                total[at[lang]] += lattice.expected(list(words), np.array(counts, np.float64), np.ascontiguousarray(weights[:, at[lang]]))
        k, piece = np.nonzero(total)
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[k, piece])], ["k", "piece", "units"])

    return run


def fit_language_id(docs: DataFrame, vocabulary: str | None = None, sample: int = 4000, rounds: int = 3) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of ``docs``; about ``sample`` rows of each language are read for it."""
    spark = docs.sparkSession
    ship(spark)
    model = LanguageModel(read_vocabulary(vocabulary or public_tokenizers.path(VOCABULARY)))
    rows = docs.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return model
    model.languages = sorted(counts, key=str.encode)
    model.shares = np.array([counts[c] for c in model.languages], np.float64) / sum(counts.values())
    share = spark.createDataFrame([(c, min(1.0, sample / counts[c])) for c in model.languages], "lang string, share double")
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    some = rows.join(F.broadcast(share), "lang").filter(draw).groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    stash = Stash(spark)
    words = some.select("lang", "text").mapInArrow(_word_batches, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stash.write(words)
    p = np.full((len(model.vocabulary), len(model.languages)), 1 / len(model.vocabulary))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((model.vocabulary, model.languages, p))
        got = words.mapInArrow(_expected_batches(shared), "k int, piece int, units long").groupBy("k", "piece").agg(F.sum("units").alias("units"))
        units = np.zeros_like(p)
        for r in got.collect():  # languages x pieces at most
            units[r["piece"], r["k"]] = r["units"]
        shared.unpersist()
        units = units / UNIT + SMOOTH
        p = units / units.sum(axis=0) + FLOOR
        p /= p.sum(axis=0)
    stash.drop(words)
    model.probabilities = p
    return model


class LanguageScorer:
    """Posteriors of texts; words met before are looked up, as many as fit about ``memory`` bytes."""

    def __init__(self, model: LanguageModel, memory: int = 64 << 20):
        self.lattice = Lattice(model.vocabulary)
        self.weights = self.lattice.weights(model.probabilities)
        self.prior = np.log(model.shares)
        self.keep = max(1, memory // (8 * len(model.languages) + 200))
        self.known: dict[str, np.ndarray] = {}

    def learn(self, words: list[str]) -> None:
        cut = [stretches(w) for w in words]
        at = {s: k for k, s in enumerate(dict.fromkeys(s for c in cut for s in c))}
        found = self.lattice.log_likelihood(list(at), self.weights)
        for w, c in zip(words, cut):
            self.known[w] = found[at[c[0]]] if len(c) == 1 else found[[at[s] for s in c]].sum(axis=0)

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) posteriors, and whether a text has a letter at all."""
        words = [Counter(LETTERS.findall(t or "")) for t in texts]
        if len(self.known) > self.keep:
            for w in list(self.known)[: len(self.known) // 2]:
                del self.known[w]
        known = self.known
        self.learn([w for w in dict.fromkeys(w for c in words for w in c) if w not in known])
        total = np.tile(self.prior, (len(texts), 1))
        for k, c in enumerate(words):
            if c:
                total[k] += np.array(list(c.values()), np.float64) @ np.array([known[w] for w in c])
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True), np.array([bool(c) for c in words], bool)


def _predict_batches(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = LanguageScorer(model)
        langs = np.array(model.languages, object)
        for batch in batches:
            for part in pieces(batch, "text"):
                p, some = scorer.posteriors(part.column("text").to_pylist())
                best = p.argmax(axis=1)
                made = {
                    "lang_pred": pa.array(np.where(some, langs[best], "und"), pa.string()),
                    "score": pa.array(np.where(some, p[np.arange(len(best)), best], 0.0)),
                }
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names)

    return run


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score; only the text is read for them.

    Other columns are passed on; columns of these names are replaced.
    """
    src = docs.drop("lang_pred", "score")
    if not model.languages:
        return src.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    spark = docs.sparkSession
    ship(spark)
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # languages x pieces numbers, whatever the input's size
    shared = spark.sparkContext.broadcast(model)
    return src.mapInArrow(_predict_batches(shared, schema.names), schema)


def held_out_third(doc_id: Column) -> Column:
    """Rows that no language is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
