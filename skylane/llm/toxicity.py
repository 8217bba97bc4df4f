"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers read the words of a clause one after another:

- insult: marks insulting words, stronger after an intensifier;
- target: remembers a person addressed or named in the last words;
- threat: intention, then harm, then a person;
- negation: turns off what follows within a few words;
- reported speech: from a speech verb or a quote on, words are somebody else's.

They are composed into one machine whose state is the tuple of their states; each
step emits the pattern that the whole state stands for (an insult at a target,
a negated insult, a reported threat, ...). A clause's patterns become a document's
features, and a logistic model fitted on labelled rows weighs the patterns.

The word classes start from the lists below. Words are also learned: words and word
stems that labelled toxic texts have and clean ones lack. They pass through the same states
as insults, so a negated or reported one counts as such, and weigh by their clause. The
fitted weights stay near a multiple of the start weights and keep their order (at a target,
plain, reported, negated), so no sample can turn it round. Both fits use at most
``sample`` labelled rows (those with the smallest hash of their id), equal texts
once; that is their documented bound. Scoring covers every document.

Defined results: null text counts as empty, which scores like a text without
patterns; labels null or missing are not learned from; without labels of both
kinds the weights below are used as they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.llm.common import pieces, ship

WORDS = {
    "insult": "idiot idiots moron morons stupid loser losers scum trash garbage clown pathetic worthless disgusting dumb dumbass fool imbecile jerk creep pig filthy vermin bastard bitch asshole".split(),
    "intensifier": "so such really very utterly totally absolute absolutely complete fucking damn bloody total".split(),
    "target": "you your you're youre ur u he she they them him her everyone people these those".split(),
    "intent": "will gonna going should shall must ought i'll ill we'll let's want deserve deserves".split(),
    "harm": "kill hurt beat destroy die shoot stab burn hang attack punch murder rape strangle".split(),
    "negation": "not no never isn't aren't wasn't weren't don't doesn't didn't won't can't cannot without nobody".split(),
    "report": "said says say called calls wrote writes claimed claims quoted tweeted shouted heard read reported alleged".split(),
}
#: Weights before any label is seen. Words that labels taught stand in the same forms as insults.
START_WEIGHTS = {
    "insult": 2.0, "strong_insult": 2.5, "insult_at_target": 3.0, "negated_insult": -0.5, "reported_insult": 0.3,
    "threat": 3.0, "negated_threat": -0.5, "reported_threat": 0.3,
    "learned": 1.0, "learned_at_target": 1.5, "negated_learned": -0.25, "reported_learned": 0.15,
}
PATTERNS = tuple(START_WEIGHTS)
#: No fit may turn these round: each pattern weighs at most as much as the next.
CHAINS = (
    ("negated_insult", "reported_insult", "insult", "strong_insult"),
    ("negated_insult", "reported_insult", "insult", "insult_at_target"),
    ("negated_threat", "reported_threat", "threat"),
    ("negated_learned", "reported_learned", "learned", "learned_at_target"),
)
BIAS = -2.5
CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[\"“”«»]")
REACH = {"target": 6, "negation": 3, "threat": 6}
LEARNED = 200
STEMS = (5, 4)


def keys(word: str) -> list[str]:
    """What a word is looked up by: itself, then its stems (marked with a star)."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


class Grammar:
    """The composed machine; ``step`` is its transition function, made once for each state and class."""

    def __init__(self, learned: dict[str, float]):
        self.classes: dict[str, str] = {w: c for c, ws in WORDS.items() for w in ws}
        self.learned = {w: x for w, x in learned.items() if self.classes.get(w) is None}
        self.classes.update(dict.fromkeys(self.learned, "learned"))
        self.classes.update(dict.fromkeys('"“”«»', "report"))
        self.cues = {w for w, c in self.classes.items() if c in ("insult", "harm", "learned")}
        self.cues_by_stem = {n: {w[:-1] for w in self.learned if w.endswith("*") and len(w) == n + 1} for n in STEMS}
        self.moves: dict[tuple, tuple[tuple, str | None]] = {}

    # each transducer: (its state, word class) -> its state
    @staticmethod
    def _count_down(state: int, kind: str, opens: str) -> int:
        return REACH[opens] if kind == opens else max(state - 1, 0)

    def step(self, state: tuple, kind: str) -> tuple[tuple, str | None]:
        """(state after, pattern emitted) of the composition."""
        if (state, kind) in self.moves:
            return self.moves[state, kind]
        target, negation, report, intensified, stage, left = state
        emitted = None
        target = self._count_down(target, kind, "target")
        negation = self._count_down(negation, kind, "negation")
        report = report or kind == "report"
        if kind == "intent":
            stage, left = 1, REACH["threat"]
        elif kind == "harm" and stage == 1:
            stage, left = 2, REACH["threat"]
        elif kind == "target" and stage == 2:
            emitted, stage, left = "threat", 0, 0
        else:
            left = max(left - 1, 0)
            stage = stage if left else 0
        base = "threat" if emitted else kind if kind in ("insult", "learned") else None
        if base and not emitted:
            emitted = f"{base}_at_target" if target else "strong_insult" if intensified and base == "insult" else base
        if base:
            emitted = f"negated_{base}" if negation else f"reported_{base}" if report else emitted
        out = ((target, negation, report, kind == "intensifier", stage, left), emitted)
        self.moves[state, kind] = out
        return out

    def clauses(self, text: str) -> Iterator[list[tuple[str, str]]]:
        """(pattern, word) lists of the clauses that hold a cue."""
        for clause in CLAUSE.split(text.lower().replace("’", "'")):
            words = TOKEN.findall(clause)
            if self.cues.isdisjoint(words) and not any(self.cues_by_stem[n] and not self.cues_by_stem[n].isdisjoint([w[:n] for w in words]) for n in STEMS):
                continue
            state, found = (0, 0, False, False, 0, 0), []
            for w in words:
                key = next((k for k in keys(w) if k in self.classes), "")
                state, pattern = self.step(state, self.classes.get(key, "other"))
                if pattern:
                    found.append((pattern, key))
            if found:
                yield found

    def features(self, text: str | None) -> np.ndarray:
        """How much clauses match each pattern (log): a clause counts once, a learned word once, by its weight."""
        out = np.zeros(len(PATTERNS))
        seen = set()
        for found in self.clauses(text or ""):
            for p, w in dict.fromkeys((p, w if w in self.learned else "") for p, w in found):
                if not w or (p, w) not in seen:
                    seen.add((p, w))
                    out[PATTERNS.index(p)] += self.learned.get(w, 1.0)
        return np.log1p(out)


@dataclass
class ToxicityModel:
    learned: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: list(START_WEIGHTS.values()))
    bias: float = BIAS

    def scores(self, texts: list[str | None], grammar: Grammar | None = None) -> np.ndarray:
        grammar = grammar or Grammar(self.learned)
        x = np.array([grammar.features(t) for t in texts]).reshape(len(texts), len(PATTERNS))
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _newton(a: np.ndarray, y: np.ndarray, at: np.ndarray, penalty: np.ndarray, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """The minimum of a logistic loss with a ridge towards ``at``: Newton steps, each halved until the loss falls.

    Classes that the patterns part cleanly leave next to no curvature, where whole steps would run away.
    """

    def loss(w: np.ndarray) -> float:
        z = a @ w + offset
        return float((np.logaddexp(0, z) - y * z).sum() + (penalty * (w - at) ** 2).sum() / 2)

    w, now = at.copy(), loss(at)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w + offset, -500, 500)))
        slope = a.T @ (p - y) + penalty * (w - at)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), -slope)
        size = 1.0
        while (after := loss(w + size * step)) > now and size > 1e-10:
            size /= 2
        if after >= now:
            break
        w, was, now = w + size * step, now, after
        if was - now < 1e-9 * max(1.0, now):
            break
    return w


def _in_order(w: np.ndarray, support: np.ndarray) -> np.ndarray:
    """``w`` with the order of ``CHAINS``: neighbours that break it take their mean, weighted by support."""
    w = w.copy()
    for _ in range(100):
        was = w.copy()
        for chain in CHAINS:
            ks = [PATTERNS.index(p) for p in chain]
            for lo, hi in zip(ks, ks[1:]):
                if w[lo] > w[hi]:
                    w[[lo, hi]] = np.average(w[[lo, hi]], weights=support[[lo, hi]])
        if np.abs(w - was).max() < 1e-9:
            break
    for chain in CHAINS:  # what the last rounds left of a violation
        ks = [PATTERNS.index(p) for p in chain]
        w[ks[0]] = min(w[ks[0]], 0.0)
        w[ks] = np.maximum.accumulate(w[ks])
    return w


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[list[float], float]:
    """Weights near a multiple of the start weights, in their order, and the bias that goes with them.

    The multiple is fitted, so a pattern without examples keeps its place among the others.
    """
    start, one = np.array(list(START_WEIGHTS.values())), np.ones((len(x), 1))
    a = np.column_stack([x @ start, x, one])
    first = np.concatenate([[1.0], np.zeros(len(start)), [BIAS]])
    fit = _newton(a, y, first, np.concatenate([[ridge], np.full(len(start), ridge), [ridge / 10]]))
    w = _in_order(max(fit[0], 0.1) * start + fit[1:-1], 1.0 + (x > 0).sum(axis=0))
    bias = _newton(one, y, np.array([BIAS]), np.array([ridge / 10]), x @ w)
    return w.tolist(), float(bias[0])


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            rows = [sorted({k for w in set(TOKEN.findall((t or "").lower().replace("’", "'"))) for k in keys(w)}) for t in part.column("text").to_pylist()]
            toxic = np.repeat(part.column("toxic").to_numpy(zero_copy_only=False), [len(r) for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([w for r in rows for w in r], pa.string()), pa.array(toxic.astype(np.int64))], ["word", "toxic"])


def _feature_batches(learned: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(learned)
        for batch in batches:
            x = [grammar.features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> ToxicityModel:
    """Fit word weights and pattern weights on at most ``sample`` labelled rows outside the held-out quarter."""
    ship(docs.sparkSession)
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # the sample's size is fixed by its parameter, so it can go to every executor
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")
    # equal texts count once, with the label that most of them have
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"), F.avg("toxic").alias("share"))
    rows = rows.select("text", (F.col("share") >= 0.5).cast("long").alias("toxic")).persist()
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        rows.unpersist()
        return ToxicityModel()
    words = rows.mapInArrow(_word_batches, "word string, toxic long").groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (n[1] + 1.0)) - F.log((F.col("good") + 0.5) / (n[0] + 1.0))
    least = max(5, 0.01 * n[1])
    top = words.withColumn("odds", odds).filter((F.col("bad") >= least) & (F.col("odds") > 3)).orderBy(F.desc(F.col("bad") * F.col("odds")), "word").limit(LEARNED)
    learned = {r["word"]: min(r["odds"], 6.0) / 2 for r in top.collect()}
    got = rows.mapInArrow(_feature_batches(learned), "x array<double>, toxic long").collect()  # at most ``sample`` short rows
    rows.unpersist()
    weights, bias = _fit_logistic(np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], np.float64))
    return ToxicityModel(learned, weights, bias)


def _score_batches(model: ToxicityModel, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.learned)
        for batch in batches:
            for part in pieces(batch, "text"):
                s = pa.array(model.scores(part.column("text").to_pylist(), grammar))
                yield pa.RecordBatch.from_arrays([s if c == "score" else part.column(c) for c in names], names)

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (score >= threshold); only the text is read for it.

    Other columns are passed on; columns of these names are replaced.
    """
    ship(docs.sparkSession)
    src = docs.drop("score", "predicted")
    schema = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType())])
    out = src.mapInArrow(_score_batches(model, schema.names), schema)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
