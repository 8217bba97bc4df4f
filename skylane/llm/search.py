"""Ranked lexical search: documents grouped by the mask of the item's terms that they hold.

One pass over the texts writes, for every document, its length and the counts of the terms
that some item asks for. The statistics (documents, terms, document frequencies) are
aggregates of that table. In a second pass every task takes its documents in blocks:

- each term is a list of the block's documents; an item's terms, or-ed bit by bit into one
  word per document, give the documents' presence masks;
- documents with one mask form a group. What a mask can reach at most follows from its
  terms' weights, the largest counts in the block and the shortest document of the group;
- groups are evaluated by descending maximum, in growing runs, until the next maximum lies
  below the item's ``k``-th best score so far, which the task carries from block to block.

Each task then hands on its ``k`` best of every item, merged in two steps so that no
item's candidates meet in one task unreduced. Items go out in blocks of at most ``block``
bytes of terms, each block with one scan of the counts.

Defined results: null or term-less texts are in no statistic and never found; rows of
one item_id are one item with all their terms, once each; equal scores rank by doc_id, null
last; repeated documents rank one by one; items that nothing matches have no row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylane.llm.common import Stash, lower_ascii, pieces, ship

GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_GAPS = {*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
#: Lower-cases A-Z and turns what separates terms into spaces, byte by byte.
_FOLD = bytes(0x20 if b in _GAPS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
LAST = (1 << 63) - 1


def terms(text: Column) -> Column:
    """The terms of a text in order, A-Z lower-cased."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda t: t != "")


def _weigh(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _count_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, sizes, where, counts = [], [], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    seen = Counter(text.encode().translate(_FOLD).split()) if text else None
                    if not seen:
                        continue
                    have = at.keys() & seen.keys()
                    pairs = sorted((at[t], seen[t]) for t in have)
                    ids.append(doc)
                    sizes.append(seen.total())
                    where.append([p[0] for p in pairs])
                    counts.append([p[1] for p in pairs])
                if ids:
                    cols = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(where, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "terms", "counts"])

    return run


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column."""
    return np.diff(col.offsets.to_numpy()), col.flatten().to_numpy(zero_copy_only=False)


class Block:
    """Documents with their counts, by document and by term."""

    def __init__(self, doc_id: np.ndarray, m: np.ndarray, sizes: np.ndarray, term: np.ndarray, count: np.ndarray):
        self.doc_id, self.m = doc_id, m
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.term, self.count = term, count
        order = np.argsort(term, kind="stable")
        self.doc_of = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.names, at = np.unique(term[order], return_index=True)
        self.at = np.append(at, len(term))
        self.most = np.maximum.reduceat(count[order], at) if len(term) else count

    def masks(self, places: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold any of an item's terms, and their presence masks (bit ``places[i]`` for term ``hits[i]``)."""
        words = np.zeros((len(self.m), int(places.max()) // 64 + 1), np.uint64)
        for bit, h in zip(places.tolist(), hits.tolist()):
            words[self.doc_of[self.at[h] : self.at[h + 1]], bit >> 6] |= np.uint64(1 << (bit & 63))
        docs = np.flatnonzero(words.any(axis=1))
        return docs, words[docs]

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``weight`` is 0 for terms that the item lacks."""
        sizes = self.first[docs + 1] - self.first[docs]
        lead = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) - np.repeat(lead - self.first[docs], sizes)
        tf = self.count[at].astype(np.int64)
        gain = weight[self.term[at]] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(self.m[docs], sizes)))
        return np.add.reduceat(gain, lead)  # every such document has a term


def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the documents by mask, and where each mask starts."""
    order = np.argsort(masks[:, 0], kind="stable") if masks.shape[1] == 1 else np.lexsort(masks.T)
    new = np.ones(len(order), bool)
    new[1:] = (masks[order[1:]] != masks[order[:-1]]).any(axis=1)
    return order, np.flatnonzero(new)


def best_of_block(block: Block, vocabulary: np.ndarray, weights: np.ndarray, k: int, floor: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that may be among an item's ``k`` best, given that a score below ``floor`` is not.

    ``vocabulary`` are the item's terms, ``weights`` theirs; ``scratch`` is zero for all terms, before and after.
    """
    none = np.zeros(0, np.int64)
    hits = np.searchsorted(block.names, vocabulary)
    there = (hits < len(block.names)) & (block.names[np.minimum(hits, len(block.names) - 1)] == vocabulary) if len(block.names) else np.zeros(len(vocabulary), bool)
    if not there.any():
        return none, none
    hits, weight = hits[there], weights[there]
    places = np.arange(len(hits))
    docs, masks = block.masks(places, hits)
    order, starts = _groups(masks)
    docs, masks = docs[order], masks[order]
    least = np.minimum.reduceat(block.m[docs], starts)
    # the most a mask can reach: its terms at their largest counts in the shortest document of the group
    tf = block.most[hits].astype(np.int64)
    bound = np.zeros(len(starts), np.int64)
    for bit in places.tolist():
        on = (masks[starts, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1) == 1
        bound[on] += weight[bit] * (1_000_000_000 * tf[bit] // (1000 * tf[bit] + 8 * least[on]))
    rank = np.argsort(-bound, kind="stable")
    size = np.diff(np.append(starts, len(docs)))
    scratch[vocabulary] = weights
    found, scored, lo, step = [], [], 0, 1
    while lo < len(rank) and bound[rank[lo]] >= max(floor, 1):
        run = rank[lo : lo + step]
        run = run[bound[run] >= max(floor, 1)]
        lead = np.cumsum(size[run]) - size[run]
        some = docs[np.arange(int(size[run].sum())) - np.repeat(lead - starts[run], size[run])]
        s = block.scores(some, scratch)
        found.append(some)
        scored.append(s)
        every = np.concatenate(scored)
        if len(every) >= k:
            floor = max(floor, int(np.partition(every, len(every) - k)[len(every) - k]))
        lo, step = lo + len(run), step * 2
    scratch[vocabulary] = 0
    if not found:
        return none, none
    some, every = np.concatenate(found), np.concatenate(scored)
    fine = every >= max(floor, 1)
    return some[fine], every[fine]


def _best_batches(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n_docs, length, n_terms = shared.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        scratch = np.zeros(n_terms, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, term = _flat(batch.column("terms"))
            _, count = _flat(batch.column("counts"))
            m = 10 + 90 * batch.column("n").to_numpy() * n_docs // length
            block = Block(batch.column("doc_id").to_numpy(), m, sizes, term, count)
            for no, (vocabulary, weights) in enumerate(items):
                ids, top = best.get(no, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                docs, s = best_of_block(block, vocabulary, weights, k, int(top[-1]) if len(top) == k else 1, scratch)
                if len(docs):
                    ids, top = np.concatenate([ids, block.doc_id[docs]]), np.concatenate([top, s])
                    order = np.lexsort((ids, -top))[:k]
                    best[no] = ids[order], top[order]
        if best:
            no = np.repeat(list(best), [len(v[0]) for v in best.values()]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(no), pa.array(np.concatenate([v[0] for v in best.values()])), pa.array(np.concatenate([v[1] for v in best.values()]))], ["no", "doc", "score"])

    return run


def _top(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _item_blocks(items: DataFrame, block: int) -> Iterator[list[tuple]]:
    """(item_id, terms) of distinct items, in lists of at most about ``block`` bytes of terms (one item at least)."""
    rows = items.select("item_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("t")).distinct()
    rows = rows.groupBy("item_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).orderBy("item_id")
    part, size = [], 0
    for r in rows.toLocalIterator():
        own = sum(len(t) + 60 for t in r["ts"])
        if part and size + own > block:
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["ts"]))
        size += own
    if part:
        yield part


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 16 << 20) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each item with a score above 0.

    ``items`` has item_id and text, ``docs`` doc_id and text; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    stash = Stash(spark)
    schema = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
    out = []
    src = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), "text")
    for part in _item_blocks(items, block):
        vocabulary = sorted({t.encode() for _, ts in part for t in ts})
        at = {t: i for i, t in enumerate(vocabulary)}
        known = spark.sparkContext.broadcast(at)  # at most ``block`` bytes of terms
        held = stash.write(src.mapInArrow(_count_batches(known), "doc_id long, n long, terms array<int>, counts array<int>"))
        total = held.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not total["n"]:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in held.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # the block's terms
            df[r["t"]] = r["n"]
        weight = np.array([_weigh(total["n"], int(x)) for x in df], np.int64)
        asked = []
        for _, ts in part:
            own = np.array(sorted(at[t.encode()] for t in ts), np.int32)
            asked.append((own, weight[own]))
        shared = spark.sparkContext.broadcast((asked, total["n"], total["l"], len(vocabulary)))
        found = held.mapInArrow(_best_batches(shared, k), "no int, doc long, score long")
        # k rows a task and item: a hundred groups an item first
        found = _top(found.withColumn("share", F.pmod(F.xxhash64("doc"), F.lit(100))), k, "no", "share").drop("rank", "share")
        found = _top(found, k, "no")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(part)], schema="no int, item_id " + items.schema["item_id"].dataType.simpleString())
        doc = F.when(F.col("doc") != LAST, F.col("doc")).cast(docs.schema["doc_id"].dataType)
        out.append(found.join(F.broadcast(names), "no").select("item_id", "rank", doc.alias("doc_id"), "score"))
    if not out:
        return spark.createDataFrame([], schema)
    made = out[0]
    for more in out[1:]:
        made = made.unionByName(more)
    return made
