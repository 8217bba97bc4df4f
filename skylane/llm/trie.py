"""Conversation prefix tries: shared beginnings of conversations, counted node by node.

Turns (role, text) are dictionary-encoded: a turn's id is the rank of its SHA-256 among the
distinct turns, so texts stay behind and conversations become short lists of longs.
The lists are range-partitioned on (ids, conversation); every range is a shard. Copies of one
conversation, and conversations under one hot beginning, spread over as many shards as
they fill.

In a shard the distinct lists go into a ternary search tree, the median first, then
the medians of both halves, so that siblings are balanced whatever their order. One
iterative traversal adds up members, leaves and savings from the deepest nodes upwards.

A node can reach over shard borders only if it lies on the beginning that the lists on both
sides of a border share. Each shard knows the lengths of those two beginnings and counts a
node as new only in the first shard that has it, so the parts of a boundary node just add
up: they are merged by the digest of their path. Everything else is final in its shard.

A node's end digest is over the ids of the conversations that end there. Boundary nodes get
it from pieces of that list, sorted and fed to the hash one after another, so no task
holds the list of a large group of copies.

Defined results: turns are ordered by turn (null first), ties by the SHA-256 of role and text;
repeated rows are turns of their own; null role and text count as empty; rows without
conv_id belong to no conversation; no conversations, no nodes; extra columns are ignored.
A conversation's ids are one row (16 bytes a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylane.llm.common import Stash, ship
from skylane.operators.joins import lookup_join

NODE = "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary"
PIECE = 8192


class TernaryTree:
    """A ternary search tree over lists of ids; node 0 is the empty list, its symbols hang on its middle link."""

    def __init__(self):
        self.symbol, self.low, self.mid, self.high = [-1], [0], [0], [0]
        self.parent, self.depth, self.size = [-1], [0], [0]

    def _node(self, symbol: int, size: int, parent: int) -> int:
        k = len(self.symbol)
        for field, value in ((self.symbol, symbol), (self.low, 0), (self.mid, 0), (self.high, 0), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.size, size)):
            field.append(value)
        return k

    def insert(self, ids: list[int], sizes: list[int]) -> int:
        """The node of a list, made with all before it where they are missing."""
        symbol, low, high, mid = self.symbol, self.low, self.high, self.mid
        at = 0
        for s, size in zip(ids, sizes):
            k = mid[at]
            if not k:
                k = mid[at] = self._node(s, size, at)
            while symbol[k] != s:
                side = low if s < symbol[k] else high
                if not side[k]:
                    side[k] = self._node(s, size, at)
                k = side[k]
            at = k
        return at

    def walk(self) -> list[int]:
        """All nodes in the order of their lists, each after its prefix, without recursion."""
        out, todo = [0], [(self.mid[0], False)] if self.mid[0] else []
        while todo:
            k, open_ = todo.pop()
            if open_:
                out.append(k)
                todo += [(c, False) for c in (self.high[k], self.mid[k]) if c]
            else:
                todo.append((k, True))
                if self.low[k]:
                    todo.append((self.low[k], False))
        return out


def median_order(n: int) -> Iterator[int]:
    """Positions of a sorted list, each range by its median first."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


def prefix_keys(ids: list[int], depth: int) -> list[bytes]:
    """Digests of the first 0, 1, .. ``depth`` ids."""
    h = hashlib.sha256()
    out = [h.digest()]
    for s in ids[:depth]:
        h.update(int(s).to_bytes(8, "little"))
        out.append(h.digest())
    return out


def shard_nodes(rows: list[tuple[list[int], int, list[int]]], before: int, after: int) -> Iterator[tuple]:
    """The nodes of a shard, given its sorted (ids, conversation, sizes).

    ``before`` and ``after`` are the lengths of the beginnings shared with the list before the
    shard and the one behind it (-1: there is none). Yields rows of NODE and of end pieces:
    (node row, None) or (None, (key, conversation, piece)).
    """
    lists, ends = [], []
    for ids, conv, sizes in rows:
        if not lists or lists[-1][0] != ids:
            lists.append((ids, sizes))
            ends.append([])
        ends[-1].append(conv)
    tree = TernaryTree()
    node = [0] * len(lists)
    for k in median_order(len(lists)):
        node[k] = tree.insert(*lists[k])
    n = len(tree.symbol)
    order = tree.walk()
    # nodes that the shard before or behind has too, with the digest of their path
    key: dict[int, bytes] = {}
    old = set()
    for k, depth in ((0, before), (-1, after)):
        if depth < 0:
            continue
        digests, at = prefix_keys(lists[k][0], depth), node[k]
        while tree.depth[at] > depth:
            at = tree.parent[at]
        while at >= 0:
            key[at] = digests[tree.depth[at]]
            if k == 0:
                old.add(at)
            at = tree.parent[at]
    # members, smallest member, leaves, savings and children, from the deepest nodes upwards
    members, least = [0] * n, [None] * n
    for at, own in zip(node, ends):
        members[at], least[at] = len(own), own[0]
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    inner = [False] * n
    last = node[-1]
    for at in reversed(order):
        up, new = tree.parent[at], at not in old
        # the last list is a leaf only if the list behind the shard neither goes on from it nor repeats it
        if not inner[at] and (at != last or after < tree.depth[at]):
            leaves[at] += 1
        saved[at] += (members[at] - new) * tree.size[at]
        if up >= 0:
            inner[up] = True
            members[up] += members[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
            kids[up] += new
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    own_ends = dict(zip(node, ends))
    for at in order:
        up = tree.parent[at]
        text = ",".join(map(str, own_ends.get(at, ())))
        digest = None if at in key else hashlib.sha256(text.encode()).digest()
        above = None if up < 0 or up in key else least[up]
        yield (key.get(at), key.get(up), least[at], tree.depth[at], above, members[at], kids[at], leaves[at], saved[at], digest), None
        if at in key and text:
            own = own_ends[at]
            for lo in range(0, len(own), PIECE // 16):
                part = own[lo : lo + PIECE // 16]
                yield None, (key[at], part[0], ",".join(map(str, part)).encode())


def _shard_batches(table: pa.Table) -> pa.Table:
    """The nodes and end pieces of one shard, which has a bounded number of turns."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("ids", "conv_id", "sizes"))), key=lambda r: r[:2])
    before, after = table["before"][0].as_py(), table["after"][0].as_py()
    made = [(*(node or (None,) * 10), *(piece or (None,) * 3)) for node, piece in shard_nodes(rows, before, after)]
    cols = list(zip(*made))
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[*(f.split()[0] for f in NODE.split(", ")), "end_key", "end_first", "end_text"])


def _end_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a key from pieces that come sorted by key and first conversation."""
    now, h = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("end_key").to_pylist(), batch.column("end_text").to_pylist()):
            if key != now:
                if now is not None:
                    done.append((now, h.digest()))
                now, h = key, hashlib.sha256(text)
            else:
                h.update(b",")
                h.update(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*done)], ["key", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.digest()], pa.binary())], ["key", "ends"])


def encode_turns(turns: DataFrame, stash: Stash) -> DataFrame:
    """conv_id and its turns in order as structs (turn, id, size), ids from a dictionary of the distinct turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    said = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), mark.alias("mark"), F.length(text).alias("size"))
    said = stash.write(said)
    # written once, so that every reader sees the same ids
    ids = said.select("mark").distinct().repartitionByRange("mark").sortWithinPartitions("mark").withColumn("id", F.monotonically_increasing_id())
    ids = stash.write(ids)
    coded = said.join(ids, "mark").select("conv_id", F.struct("turn", "id", "size").alias("t"))
    return coded.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))


def share_heads(talks: DataFrame, heads: int = 6, every: int = 100) -> DataFrame:
    """Conversations begin with the first h turns of the conversation whose number is the next lower multiple of ``every``.

    h is crc32 of the conversation's decimal number modulo ``heads``; its own turns follow after its first h.
    """
    first = talks.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("ts", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    mine = talks.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": h}).join(first, "base", "left")
    none = F.array().cast(talks.schema["ts"].dataType)
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))).otherwise(none)
    rest = F.slice("ts", F.col("h") + 1, F.greatest(F.size("ts") - F.col("h"), F.lit(0)))
    return mine.select("conv_id", F.concat(head, rest).alias("ts"))


def _common(a: Column, b: Column) -> Column:
    """Length of the common beginning of two arrays; -1 if one is missing."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.coalesce(F.when(other == 0, F.size(a)).otherwise(other - 1).cast("int"), F.lit(-1))


def prefix_trie(talks: DataFrame, stash: Stash, shard_turns: int = 20_000) -> DataFrame:
    """Nodes of the trie over ``talks`` (conv_id and ``ts``, see ``encode_turns``).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ``shard_turns`` bounds what a task holds: about so many turns, one conversation at least.
    """
    ship(stash.spark)
    flat = stash.write(talks.select("conv_id", F.col("ts.id").alias("ids"), F.col("ts.size").cast("array<long>").alias("sizes")))
    total = flat.agg(F.sum(F.size("ids") + 1).alias("n")).first()["n"] or 0
    shards = flat.repartitionByRange(max(1, -(-total // shard_turns)), "ids", "conv_id").withColumn("shard", F.spark_partition_id())
    shards = stash.write(shards)
    edge = lambda f: f(F.struct("ids", "conv_id"))["ids"]
    ranges = shards.groupBy("shard").agg(edge(F.min).alias("a"), edge(F.max).alias("z"))
    # as many rows as there are shards
    by = Window.orderBy("shard")
    ranges = ranges.select("shard", _common(F.lag("z").over(by), F.col("a")).alias("before"), _common(F.col("z"), F.lead("a").over(by)).alias("after"))
    schema = NODE + ", end_key binary, end_first long, end_text binary"
    made = stash.write(shards.join(ranges, "shard").groupBy("shard").applyInArrow(_shard_batches, schema))
    nodes = made.filter("depth IS NOT NULL").drop("end_key", "end_first", "end_text")
    final = nodes.filter("key IS NULL").drop("key")
    parts = nodes.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    parts = stash.write(parts)
    pieces = made.filter("end_key IS NOT NULL").select("end_key", "end_first", "end_text")
    ends = pieces.repartition("end_key").sortWithinPartitions("end_key", "end_first").mapInArrow(_end_batches, "key binary, ends binary")
    bound = parts.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.unhex(F.sha2(F.lit("").cast("binary"), 256))))
    every = final.unionByName(bound.drop("key"))
    # many nodes can hang on one boundary node, the root above all
    names = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    every = lookup_join(every, names, ["parent_key"])
    return every.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.lower(F.hex("ends")).alias("ends_sha256"),
    )
