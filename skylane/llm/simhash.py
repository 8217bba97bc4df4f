"""SimHash near-dedup: fingerprints, then a self-join of their binary trie.

A fingerprint's bit is set if over half of the document's shingle hashes have
it. Equal fingerprints collapse to one leaf. The trie is walked in pairs of nodes
that add up differing bits and stop when the budget is spent. Of ``distance``
differing bits, one third of the word holds at most ``distance // 3``, so the
trie is walked three times, each time with another third on top and only that
budget within it; few pairs survive the upper levels.

The upper levels run as a join key: a leaf goes to the node of its first bits
and, with the spent budget noted, to each larger node within the budget. A task holds
one node's own leaves (in parts of ``part`` if there are more), streams the visitors
past them and returns a spanning forest of the links it finds, at most one row for
each leaf, never the pairs. Components come from these forests.

Defined results: null text counts as empty; without words the fingerprint is
zero and links like any other; rows with one id and different texts are separate
documents, repeated rows are one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import Stash, pieces, sheltered, ship
from skylane.llm.components import connected_components, local_roots
from skylane.operators.joins import lookup_join

THIRDS = (22, 21, 21)
_SPREAD = np.array([sum(1 << (8 * j) for j in range(8) if v >> j & 1) for v in range(256)], np.uint64)


def majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For hashes of several documents, the bits that over half of each document's hashes have."""
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    # sums of up to 255 hashes fit the bytes of one word: eight bits are counted at once
    blocks = (n[full] + 254) // 255
    base = np.cumsum(blocks) - blocks
    start = np.repeat(first[full], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(base, blocks))
    by = h.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        part = np.add.reduceat(_SPREAD[by[:, k]], start).view(np.uint8).reshape(-1, 8)
        count = np.add.reduceat(part, base, axis=0, dtype=np.int64)
        over = (2 * count > n[full][:, None]).astype(np.uint64)
        for j in range(8):
            out[full] |= over[:, j] << np.uint64(8 * k + j)
    return out


def fingerprints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """SimHash of the word shingles of each text, over XXH64 with seed 42."""
    f, rows = xxhash.xxh64_intdigest, []
    for t in texts:
        w = (t or b"").lower().split()
        if len(w) >= shingle:
            rows.append([f(s, 42) for s in map(b" ".join, zip(*(w[j:] for j in range(shingle))))])
        else:
            rows.append([f(b" ".join(w), 42)] if w else [])
    first = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=first[1:])
    return majority(np.fromiter(chain.from_iterable(rows), np.uint64, int(first[-1])), first)


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                fp = fingerprints(part.column("text").cast(pa.binary()).to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), pa.array(fp.view(np.int64))], [*(c for c in part.schema.names if c != "text"), "__fp"])

    return run


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return x if not by else (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, used: np.ndarray, top: int, top_budget: int, budget: int, work: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of leaves within ``budget`` bits, in blocks; ``b`` None joins ``a`` with itself.

    ``a`` and ``b`` are sorted and agree on the first ``depth`` bits, but for the
    ``used`` bits of each distinct node of ``b``. Within the first ``top`` bits no
    more than ``top_budget`` may differ.
    """
    own = b is None
    other = a if own else b
    # rows of a node pair: a's range, b's range, differing bits so far
    if own:
        pairs = np.array([[0, len(a), 0, len(a), 0]])
    else:
        cut = np.flatnonzero(np.diff(other >> np.uint64(64 - depth))) + 1 if depth else np.zeros(0, np.int64)
        lo, hi = np.append(0, cut), np.append(cut, len(other))
        pairs = np.stack([np.zeros_like(lo), np.full_like(lo, len(a)), lo, hi, used[lo]], 1)
    stack = [(depth, pairs)]
    while stack:
        level, p = stack.pop()
        size = (p[:, 1] - p[:, 0]) * (p[:, 3] - p[:, 2])
        small = (size <= 32) | (level == 64)
        yield from _leaves(a, other, p[small], own, budget, work)
        p = p[~small]
        if not len(p):
            continue
        if len(p) > work:
            stack += [(level, p[: len(p) // 2]), (level, p[len(p) // 2 :])]
            continue
        shift = np.uint64(63 - level)
        ones_a = np.append(0, np.cumsum((a >> shift & np.uint64(1)).astype(np.int64)))
        ones_b = ones_a if own else np.append(0, np.cumsum((other >> shift & np.uint64(1)).astype(np.int64)))
        mid_a = p[:, 1] - (ones_a[p[:, 1]] - ones_a[p[:, 0]])
        mid_b = p[:, 3] - (ones_b[p[:, 3]] - ones_b[p[:, 2]])
        most = top_budget if level < top else budget
        a0, a1, b0, b1, u = p[:, 0], p[:, 1], p[:, 2], p[:, 3], p[:, 4]
        nxt = [np.stack([a0, mid_a, b0, mid_b, u], 1), np.stack([mid_a, a1, mid_b, b1, u], 1), np.stack([a0, mid_a, mid_b, b1, u + 1], 1)]
        back = np.stack([mid_a, a1, b0, mid_b, u + 1], 1)
        nxt.append(back[(a0 != b0) | (a1 != b1)] if own else back)
        q = np.concatenate(nxt)
        stack.append((level + 1, q[(q[:, 0] < q[:, 1]) & (q[:, 2] < q[:, 3]) & (q[:, 4] <= most)]))


def _leaves(a: np.ndarray, b: np.ndarray, p: np.ndarray, own: bool, budget: int, work: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Compare the leaves below small node pairs, ``work`` comparisons at a time."""
    wide = p[:, 3] - p[:, 2]
    size = (p[:, 1] - p[:, 0]) * wide
    total = np.cumsum(size)
    at = 0
    while at < len(p):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + work, "right")))
        if size[at] > work:  # equal leaves never meet here, so this is one node against itself at the last level
            end = at + 1
        n, w = size[at:end], wide[at:end]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = np.repeat(w, n)
        i, j = np.repeat(p[at:end, 0], n) + k // w, np.repeat(p[at:end, 2], n) + k % w
        ok = np.bitwise_count(a[i] ^ b[j]) <= budget
        if own:
            ok &= i < j
        yield i[ok], j[ok]
        at = end


def _forest(own: np.ndarray, seen: np.ndarray | None, used: np.ndarray, depth: int, top: int, top_budget: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (leaf, root) of the links among ``own`` leaves, or between them and visitors."""
    every = own if seen is None else np.concatenate([own, seen])
    shift = 0 if seen is None else len(own)
    root = np.arange(len(every))
    for i, j in trie_pairs(own, seen, depth, used, top, top_budget, budget):
        if len(i):
            merged = local_roots(len(every), root[i], root[j + shift])
            root = merged[root]
    linked = np.flatnonzero(root != np.arange(len(every)))
    return every[linked], every[root[linked]]


def _walk(depth: int, distance: int, part: int):
    """One node after another: hold its own leaves, then stream the visitors past them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(turn: int, own: np.ndarray, seen: np.ndarray | None, used: np.ndarray) -> pa.RecordBatch:
            by = sum(THIRDS[:turn])
            spin = lambda x: _rotate(x.view(np.uint64), by)
            mine = np.sort(spin(own))
            if seen is not None:
                seen = spin(seen)
                order = np.argsort(seen)
                seen, used = seen[order], used[order]
            a, b = _forest(mine, seen, used, depth, THIRDS[turn], distance // 3, distance)
            back = lambda x: _rotate(x, (64 - by) % 64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(back(a)), pa.array(back(b))], ["a", "b"])

        now, own, seen, used, settled = None, [], [], [], False
        none = np.zeros(0, np.int64)

        def settle() -> Iterator[pa.RecordBatch]:
            if now is not None and own and not settled:
                yield links(now[0], np.concatenate(own), None, none)

        def visit() -> Iterator[pa.RecordBatch]:
            if seen and own:
                yield links(now[0], np.concatenate(own), np.concatenate(seen), np.concatenate(used))

        for batch in batches:
            turn, node, salt, away = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("turn", "node", "salt", "away"))
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(turn) != 0) | (np.diff(node) != 0) | (np.diff(salt) != 0) | ((away[1:] >= 0) != (away[:-1] >= 0))) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(fp))):
                if lo == hi:
                    continue
                key = (int(turn[lo]), int(node[lo]), int(salt[lo]))
                if key != now:
                    yield from settle()
                    yield from visit()
                    now, own, seen, used, settled = key, [], [], [], False
                if away[lo] < 0:
                    own.append(fp[lo:hi])
                else:
                    seen.append(fp[lo:hi])
                    used.append(away[lo:hi])
                    if sum(map(len, seen)) >= part:
                        yield from settle()
                        settled = True
                        yield from visit()
                        seen, used = [], []
        yield from settle()
        yield from visit()

    return run


def trie_links(distinct: DataFrame, distance: int, node_size: int = 4096, part: int = 1 << 16) -> DataFrame:
    """(a, b): a forest over ``distinct`` fingerprints (column fp) that joins all within ``distance`` bits."""
    ship(distinct.sparkSession)
    n = distinct.count()
    depth = int(min(max(np.ceil(np.log2(max(n, 1) / node_size)), 0), THIRDS[-1]))
    spend = distance // 3
    masks = [(0, 0)] + [(sum(1 << i for i in c), k) for k in range(1, spend + 1) for c in combinations(range(depth), k)]
    turned = []
    for turn in range(3):
        by = sum(THIRDS[:turn])
        spun = F.col("fp") if not by else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by))
        turned.append(distinct.select("fp", F.lit(turn).alias("turn"), (F.shiftrightunsigned(spun, 64 - depth) if depth else F.lit(0)).cast("long").alias("home")))
    leaves = turned[0].union(turned[1]).union(turned[2])
    crowd = leaves.groupBy("turn", "home").count().filter(F.col("count") > part).select("turn", F.col("home").alias("node"), F.ceil(F.col("count") / part).cast("long").alias("parts"))
    # own rows come first (away -1); visitors carry the bits spent on the way
    sent = leaves.select("fp", "turn", "home", F.explode(F.array(*(F.struct(F.col("home").bitwiseXOR(F.lit(m).cast("long")).alias("node"), F.lit(k).cast("long").alias("away")) for m, k in masks))).alias("to")).select("fp", "turn", "home", "to.*").filter("node >= home")
    sent = sent.join(crowd, ["turn", "node"], "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    # in a crowded node a leaf is held by one part and visits the parts after it
    to = F.when(F.col("node") == F.col("home"), F.sequence(mine, F.col("parts") - 1)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    rows = sent.withColumn("mine", mine).withColumn("salt", F.explode(to)).withColumn("away", F.when((F.col("node") == F.col("home")) & (F.col("salt") == F.col("mine")), F.lit(-1).cast("long")).otherwise(F.col("away")))
    rows = rows.select("fp", "turn", "node", "salt", "away")
    return rows.repartition("turn", "node", "salt").sortWithinPartitions("turn", "node", "salt", "away").mapInArrow(_walk(depth, distance, part), "a long, b long")


@sheltered("first")
def simhash_dedup(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` without text, with fingerprint (16 hex digits), component_id and kept.

    component_id is the smallest doc_id reachable over links of ``distance``
    bits or fewer; kept marks one document of each component, one of that id;
    of several texts with that id the one with the smallest text_hash. text_hash is
    xxhash64 of the text, which with doc_id names a row.
    """
    spark = docs.sparkSession
    ship(spark)
    stash = Stash(spark)
    src = docs.drop("fingerprint", "component_id", "kept").withColumn("text_hash", F.xxhash64("text"))
    marked = src.mapInArrow(_fingerprint_batches(shingle), src.drop("text").withColumn("__fp", F.lit(0).cast("long")).schema)
    marked = stash.write(marked)
    leaves = stash.write(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")))
    links = trie_links(leaves.select("fp"), distance)
    parts = connected_components(links, stash)
    named = leaves.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first").alias("first"))
    labels = lookup_join(named.select("fp", "component"), names, ["component"], how="inner").select(F.col("fp").alias("__fp"), "first")
    out = marked.join(labels, "__fp", "left")
    hexed = F.lpad(F.lower(F.hex("__fp")), 16, "0")
    return out.withColumns({"fingerprint": hexed, "component_id": F.col("first.doc_id"), "kept": F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash"))}).drop("__fp", "first")
