"""Embedding near-dedup: random-hyperplane signs in several tables, exact cosines, components.

Equal vectors collapse to one with a count. Each table hashes a vector to the
signs of its products with fixed random planes; vectors with equal signs in
any table are compared exactly, in double precision. Signs a table has and
tables there are follow from the number of vectors and ``recall``: at the threshold
angle a pair shares all signs of a table with a known chance.

A task holds one bucket (in parts of ``part`` if it is larger: a part is held
by one task and streamed past the parts after it). Pairs are never sent on: a
pair counts in the first table that it shares, so a task returns link counts
for each vector and a spanning forest of its links.

Defined results: a vector that is null, empty, all zero or has null, NaN or
infinite components links with nothing, as do vectors of different lengths;
repeated rows are vectors of their own; extra columns are passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import Stash, sheltered, ship
from skylane.llm.components import connected_components, local_roots

BUCKET = 400


def table_shape(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(signs a table, tables) for ``n`` vectors: some ``BUCKET`` unrelated vectors share a bucket."""
    bits = int(min(max(math.ceil(math.log2(max(n, 1) / BUCKET)), 4), 20))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _signatures(bits: int, tables: int, seed: int):
    """One row per vector and table: the bucket, and the signs of all tables for later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                v = batch.column(batch.schema.get_field_index("vector")).to_pylist()
                dims = np.array([len(x) for x in v])
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    if dim not in planes:
                        planes[dim] = _planes(int(dim), bits, tables, seed)
                    a = np.array([v[i] for i in at], np.float64)
                    signs = (a / np.abs(a).max(axis=1, keepdims=True)) @ planes[dim] > 0
                    sig = (signs.reshape(len(at), tables, bits) @ weights).astype("<i4")
                    take = pa.array(at)
                    node, copies = (batch.column(batch.schema.get_field_index(c)).take(take) for c in ("node", "copies"))
                    raw = pa.array([x.tobytes() for x in a], pa.binary())
                    sigs = pa.array([x.tobytes() for x in sig], pa.binary())
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t)), pa.array(np.full(len(at), dim)), pa.array(sig[:, t].astype(np.int64)), node, copies, raw, sigs], ["tab", "dim", "sign", "node", "copies", "raw", "sigs"])

    return run


class _Held:
    """Unit vectors of a part of a bucket."""

    def __init__(self, batches: list[pa.RecordBatch]):
        one = pa.Table.from_batches(batches)
        a = np.stack([np.frombuffer(x, np.float64) for x in one["raw"].to_pylist()])
        a = a / np.abs(a).max(axis=1, keepdims=True)
        self.unit = a / np.sqrt((a * a).sum(axis=1, keepdims=True))
        self.sigs = np.stack([np.frombuffer(x, "<i4") for x in one["sigs"].to_pylist()])
        self.node, self.copies = one["node"].to_numpy(), one["copies"].to_numpy()


def _links(a: _Held, b: _Held | None, tab: int, threshold: float, block: int = 512) -> pa.RecordBatch:
    """Link counts and a forest of the pairs within ``a``, or between ``a`` and ``b``."""
    own, other = b is None, a if b is None else b
    node = a.node if own else np.concatenate([a.node, other.node])
    shift = 0 if own else len(a.node)
    found, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for lo in range(0, len(a.node), block):
        for lo_b in range(lo if own else 0, len(other.node), block):
            i, j = np.nonzero(a.unit[lo : lo + block] @ other.unit[lo_b : lo_b + block].T >= threshold)
            i, j = i + lo, j + lo_b
            if own:
                i, j = i[i < j], j[i < j]
            if tab and len(i):
                fresh = np.concatenate([~(a.sigs[x, :tab] == other.sigs[y, :tab]).any(axis=1) for x, y in zip(np.array_split(i, len(i) // 50_000 + 1), np.array_split(j, len(j) // 50_000 + 1))])
                i, j = i[fresh], j[fresh]
            if len(i):
                np.add.at(found, i, other.copies[j])
                np.add.at(found, j + shift, a.copies[i])
                root = local_roots(len(node), root[i], root[j + shift])[root]
    hit = np.flatnonzero(found)
    return pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(found[hit]), pa.array(node[root[hit]])], ["node", "links", "root"])


def _compare(threshold: float, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, seen, held = None, [], [], None

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if own and held is None:
                held = _Held(own)
                if len(held.node) > 1:
                    yield _links(held, None, now[0], threshold)
            if seen and held is not None:
                yield _links(held, _Held(seen), now[0], threshold)

        for batch in batches:
            tab, dim, sign, salt, away = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("tab", "dim", "sign", "salt", "away"))
            change = np.zeros(max(len(tab) - 1, 0), bool)
            for c in (tab, dim, sign, salt, away):
                change |= np.diff(c.astype(np.int64)) != 0
            cut = np.flatnonzero(change) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(tab))):
                if lo == hi:
                    continue
                key = (int(tab[lo]), int(dim[lo]), int(sign[lo]), int(salt[lo]))
                if key != now:
                    yield from settle()
                    now, own, seen, held = key, [], [], None
                (seen if away[lo] else own).append(batch.slice(lo, hi - lo))
                if sum(len(x) for x in seen) >= part:
                    yield from settle()
                    seen = []
        yield from settle()

    return run


def vector_links(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999, seed: int = 7, part: int = 4096) -> DataFrame:
    """(node, links, root) pieces for distinct ``vectors`` (node, copies, vector): summed links, forest edges."""
    ship(vectors.sparkSession)
    bits, tables = table_shape(vectors.count(), threshold, recall)
    rows = vectors.select("node", "copies", "vector").mapInArrow(_signatures(bits, tables, seed), "tab long, dim long, sign long, node long, copies long, raw binary, sigs binary")
    key = ["tab", "dim", "sign"]
    signs = vectors.select("node", "copies", "vector").mapInArrow(_signatures(bits, tables, seed), "tab long, dim long, sign long, node long, copies long, raw binary, sigs binary").select(*key)
    crowd = signs.groupBy(*key).count().filter(F.col("count") > part).select(*key, F.ceil(F.col("count") / part).cast("long").alias("parts"))
    rows = rows.join(crowd, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    mine = F.pmod(F.xxhash64("node"), F.col("parts"))
    rows = rows.withColumn("mine", mine).withColumn("salt", F.explode(F.sequence(mine, F.col("parts") - 1))).withColumn("away", (F.col("salt") != F.col("mine")).cast("int"))
    rows = rows.drop("parts", "mine").repartition(*key, "salt").sortWithinPartitions(*key, "salt", "away")
    return rows.mapInArrow(_compare(threshold, part), "node long, links long, root long")


@sheltered()
def embedding_dedup(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.999) -> DataFrame:
    """``vectors`` (vec_id, embedding, ...) with n_links, component_id and kept.

    n_links counts the other rows linked directly; component_id is the smallest
    vec_id reachable; kept is vec_id = component_id.
    """
    stash = Stash(vectors.sparkSession)
    src = vectors.drop("n_links", "component_id", "kept").withColumn("__v", F.col("embedding").cast("array<double>"))
    fine = F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("__v", lambda x: x != 0)
    src = src.withColumn("__v", F.when(fine, F.col("__v")))
    distinct = src.filter("__v is not null").groupBy(F.col("__v").alias("vector")).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    distinct = stash.write(distinct.withColumn("node", F.monotonically_increasing_id()))
    found = stash.write(vector_links(distinct, threshold, recall))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), stash)
    named = distinct.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    info = named.join(names, "component").join(links, "node", "left").select(F.col("vector").alias("__v"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = src.join(info, "__v", "left").drop("__v")
    out = out.withColumns({"n_links": F.coalesce("n_links", F.lit(0).cast("long")), "component_id": F.coalesce("component_id", "vec_id")})
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
