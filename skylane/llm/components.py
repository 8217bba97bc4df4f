"""Connected components: spanning forests within tasks, star contraction between them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import Stash


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` indexes reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        low = np.minimum(ra, rb)
        np.minimum.at(root, np.maximum(ra, rb), low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def connected_components(edges: DataFrame, stash: Stash) -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has an edge.

    ``edges`` has longs a and b. Alternating large and small stars: each round
    takes minima with map-side sums and joins them back, so a hub is a skewed
    join that AQE splits and never one task's list. Each round is a table in the
    shared folder, and the round before it is dropped.
    """
    now = stash.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    was = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == was:
            break
        was = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stash.write(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = stash.write(small.select("e.u", "e.v").filter("u <> v").distinct())
        stash.drop(now)
        stash.drop(large)
        now = after
    return now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
