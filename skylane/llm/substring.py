"""Substring dedup: suffix automata over shards of the reference text give matching statistics.

Every run of ``window`` words that also starts anywhere else in the table is
removed. The reference is the table itself, so sending every shard's automaton
to every executor would cost shards x documents. The shards are therefore cut by
content: the smallest hash of ``ANCHOR`` consecutive words inside a window
names the window's shard, equal windows have equal anchors, and an automaton
meets only the text that can match it.

1. Each document is cut into runs of windows with one anchor; anchors are
   counted. An anchor seen once holds no repeated window.
2. Runs with a repeated anchor become segments (the words their windows cover).
   Equal segments are counted before they move, so copies cost one row each task.
3. Each shard builds one suffix automaton over its distinct segments, weighted
   with their counts, and streams them: a window repeats if its state was seen
   twice. Exact, on words, not hashes.
4. Verdicts go back to the documents, whose covered words are dropped.

An anchor with over ``hot`` runs (a passage that many documents share, with
different text around it) would make one large shard. Its windows are routed one
by one under their own hash instead, summed up where they are; one that stays alone
after the sums goes no further.

Defined results: null text counts as empty; a text under ``window`` words loses
nothing; identical rows are each other's copies; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.llm.automaton import SuffixAutomaton
from skylane.llm.common import Words, keyed, mix, pieces, sheltered, ship, words_of

ANCHOR = 10


def window_minimum(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        a = np.minimum(a[:-done], a[done:])
        done *= 2
    return np.minimum(a[: len(a) - (width - done)], a[width - done :]) if done < width else a


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive word hashes."""
    out = np.zeros(len(h) - n + 1, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    for j in range(n):
        out = out * odd + h[j : len(h) - n + 1 + j]
    return mix(out)


class Runs:
    """Maximal runs of neighbouring windows with one anchor, over the texts of a batch."""

    def __init__(self, words: Words, window: int):
        h = words.hashes()
        anchor = min(ANCHOR, window)
        none = np.zeros(0, np.int64)
        self.first, self.last, self.doc, self.value, self.times, self.hashes = none, none, none, np.zeros(0, np.uint64), none, h
        if len(h) < window:
            return
        grams = gram_hashes(h, anchor)
        width = window - anchor + 1
        least = window_minimum(grams, width)
        doc_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        at = np.flatnonzero(doc_of[: len(least)] == doc_of[window - 1 :])
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (least[at[1:]] != least[at[:-1]]) | (doc_of[at[1:]] != doc_of[at[:-1]])
        begin = np.flatnonzero(new)
        self.first, self.last = at[begin], at[np.append(begin[1:], len(at)) - 1]
        self.value, self.doc = least[self.first], doc_of[self.first]
        # how often the anchor stands in the run: over once, windows of this run can repeat each other
        span = self.last - self.first + width
        where = np.repeat(self.first - np.append(0, np.cumsum(span)[:-1]), span) + np.arange(span.sum())
        same = (grams[where] == np.repeat(self.value, span)).astype(np.int64)
        self.times = np.add.reduceat(same, np.append(0, np.cumsum(span)[:-1]))


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                r = Runs(words_of(part.column("text")), window)
                take = pa.array(r.doc)
                yield pa.RecordBatch.from_arrays([part.column("__id").take(take), part.column("__tx").take(take), pa.array(r.value.view(np.int64)), pa.array(r.times)], ["__id", "__tx", "anchor", "times"])

    return run


def _segments(window: int):
    """Runs whose anchor is listed for the document, as text; windows of hot anchors one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words_of(part.column("text"))
                r = Runs(w, window)
                listed = part.column("__anchors").to_pylist()
                calm = [{a["anchor"] for a in x or () if not a["hot"]} for x in listed]
                hot = [{a["anchor"] for a in x or () if a["hot"]} for x in listed]
                whole = gram_hashes(r.hashes, window).view(np.int64) if len(r.first) else None
                doc, key, start, text, lone = [], [], [], [], []

                def put(d: int, k: int, a: int, b: int, alone: bool) -> None:
                    doc.append(d)
                    key.append(k)
                    start.append(a - w.first[d])
                    text.append(w.text(a, b))
                    lone.append(alone)

                for d, v, a, z in zip(r.doc.tolist(), r.value.view(np.int64).tolist(), r.first.tolist(), r.last.tolist()):
                    if v in calm[d]:
                        put(d, v, a, z + window, False)
                    elif v in hot[d]:
                        for k in range(a, z + 1):
                            put(d, int(whole[k]), k, k + window, True)
                    if len(text) >= 20_000:
                        yield _segment_batch(part, doc, key, start, text, lone)
                        doc, key, start, text, lone = [], [], [], [], []
                yield _segment_batch(part, doc, key, start, text, lone)

    return run


def _segment_batch(part: pa.RecordBatch, doc: list, key: list, start: list, text: list, lone: list) -> pa.RecordBatch:
    take = pa.array(doc, pa.int64())
    return pa.RecordBatch.from_arrays(
        [part.column("__id").take(take), part.column("__tx").take(take), pa.array(key, pa.int64()), pa.array(np.array(start, np.int64)), pa.array(text, pa.binary()).cast(pa.string()), pa.array(lone, pa.bool_())],
        ["__id", "__tx", "shard", "start", "segment", "lone"],
    )


def _shard_verdicts(texts: list[bytes], counts: list[int], window: int) -> list[list[int]]:
    """For each distinct segment of a shard, the starts of its repeated windows."""
    if len(texts) == 1 and counts[0] > 1:  # its automaton would have seen all of it twice
        return [list(range(texts[0].count(b" ") + 2 - window))]
    number: dict[bytes, int] = {}
    rows = [[number.setdefault(x, len(number)) for x in t.split()] for t in texts]
    automaton = SuffixAutomaton()
    for row, n in zip(rows, counts):
        automaton.add(row, n)
    automaton.close()
    return [automaton.repeated(row, window) for row in rows]


def _verdicts(window: int):
    """Shards arrive sorted; each is held, streamed through its automaton and let go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, list]] = []

        def flush() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.list_(pa.int64())))], ["shard", "segment_id", "spans"]
            )
            out.clear()
            return b

        def close(key: int, held: list[tuple[int, bytes, int]]) -> None:
            for (sid, _, _), starts in zip(held, _shard_verdicts([t for _, t, _ in held], [n for _, _, n in held], window)):
                if starts:
                    spans = [[starts[0], starts[0] + window]]
                    for s in starts[1:]:
                        if s <= spans[-1][1]:
                            spans[-1][1] = s + window
                        else:
                            spans.append([s, s + window])
                    out.append((key, sid, spans))

        now, held = None, []
        for batch in batches:
            for key, sid, text, n in zip(batch.column("shard").to_pylist(), batch.column("segment_id").to_pylist(), batch.column("segment").cast(pa.binary()).to_pylist(), batch.column("copies").to_pylist()):
                if key != now:
                    if held:
                        close(now, held)
                    now, held = key, []
                held.append((sid, text, n))
            if len(out) > 5000:
                yield flush()
        if held:
            close(now, held)
        yield flush()

    return run


def _cut(names: list[str], out_text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                spans = part.column("__spans").to_pylist()
                n_words, n_gone, kept, merged = [], [], [], []
                for t, ranges in zip(texts, spans):
                    w = (t or b"").split()
                    joined: list[list[int]] = []
                    for a, b in sorted(ranges or ()):
                        if joined and a <= joined[-1][1]:
                            joined[-1][1] = max(joined[-1][1], b)
                        else:
                            joined.append([a, b])
                    rest, at = [], 0
                    for a, b in joined:
                        rest += w[at:a]
                        at = b
                    rest += w[at:]
                    n_words.append(len(w))
                    n_gone.append(len(w) - len(rest))
                    kept.append(b" ".join(rest))
                    merged.append(joined)
                cols = {
                    "n_words": pa.array(n_words, pa.int64()),
                    "n_removed": pa.array(n_gone, pa.int64()),
                    out_text: pa.array(kept, pa.binary()).cast(pa.string()),
                    "removed_spans": pa.array(merged, pa.list_(pa.list_(pa.int64()))),
                }
                yield pa.RecordBatch.from_arrays([cols[c] if c in cols else part.column(c) for c in names], names)

    return run


def repeated_spans(docs: DataFrame, window: int = 35, hot: int = 256) -> DataFrame:
    """(__id, __tx, spans): word ranges of the repeated windows of ``keyed`` documents."""
    ship(docs.sparkSession)
    anchors = docs.select("__id", "__tx", "text").mapInArrow(_anchors(window), "__id long, __tx long, anchor long, times long")
    counts = anchors.groupBy("anchor").agg(F.sum("times").alias("n"), F.count("*").alias("runs")).filter("n > 1").select("anchor", (F.col("runs") > hot).alias("hot"))
    listed = anchors.select("__id", "__tx", "anchor").join(counts, "anchor").groupBy("__id", "__tx").agg(F.collect_set(F.struct("anchor", "hot")).alias("__anchors"))
    runs = docs.join(listed, ["__id", "__tx"]).mapInArrow(_segments(window), "__id long, __tx long, shard long, start long, segment string, lone boolean")
    runs = runs.withColumn("segment_id", F.xxhash64("segment"))
    distinct = runs.groupBy("shard", "segment_id", "segment", "lone").agg(F.count("*").alias("copies")).filter("not lone or copies > 1").drop("lone")
    verdicts = distinct.repartition("shard").sortWithinPartitions("shard").mapInArrow(_verdicts(window), "shard long, segment_id long, spans array<array<long>>")
    found = runs.select("__id", "__tx", "shard", "segment_id", "start").join(verdicts, ["shard", "segment_id"])
    moved = F.transform("spans", lambda s: F.transform(s, lambda x: x + F.col("start")))
    return found.select("__id", "__tx", moved.alias("spans")).groupBy("__id", "__tx").agg(F.flatten(F.collect_set("spans")).alias("__spans"))


@sheltered()
def substring_dedup(docs: DataFrame, window: int = 35, hot: int = 256, kept: str = "kept_text") -> DataFrame:
    """``docs`` with n_words, n_removed, ``kept`` (the kept words joined by one space) and removed_spans.

    Every other column is passed on; columns of these names are replaced.
    """
    own = ["n_words", "n_removed", "removed_spans"] + ([kept] if kept != "text" else [])
    src = keyed(docs.drop(*own))
    spans = repeated_spans(src, window, hot)
    joined = src.join(spans, ["__id", "__tx"], "left").drop("__id", "__tx")
    fields = [f for f in joined.schema.fields if f.name != "__spans"]
    extra = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(kept, T.StringType()), T.StructField("removed_spans", T.ArrayType(T.ArrayType(T.LongType())))]
    schema = T.StructType(fields + [f for f in extra if f.name != "text"])
    return joined.mapInArrow(_cut(schema.names, kept), schema)


