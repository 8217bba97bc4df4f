"""Exact ranks and prefix sums without a single-partition window.

A window with no PARTITION BY (or partitioned by a binary label) sends every row
to one task. Instead each row carries a *bucket* that is monotone in the sort
order (leading hash digits, or an equi-depth value bucket). Then:

1. count rows per (group, bucket): at most groups x buckets rows;
2. prefix-sum those counts (a window over the small table);
3. broadcast the offsets back (their size is bounded by groups x buckets);
4. rank inside (group, bucket) only.

The result equals a global ``row_number`` over the same order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# 5 leading hex digits = 1,048,576 hash buckets: about a million rows per window
# task at 10^12 rows, while the per-bucket offset table stays bounded by
# 2^20 rows per group, small enough to broadcast. The rank order is the same for
# any digit count (the bucket is a prefix of the hash it orders by).
RANK_DIGITS = 5
# A cut's bucket is narrowed step by step, so the first step needs no more than 4,096 buckets a group:
# each task sends a count a bucket, and with many buckets that is nearly a count a row.
CUT_DIGITS = 3
CUT_ROWS = 1_000_000


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def bucketed_row_number(df: DataFrame, bucket: str, order: Sequence[str | Column],
                        groups: Sequence[str] = (), out: str = "_rank", total: str | None = None,
                        collapse_copies: bool = True) -> DataFrame:
    """0-based ``row_number`` within ``groups`` ordered by (bucket, *order).

    ``bucket`` must be a non-NULL column with a bounded number of values.
    ``total`` optionally adds the group size. With ``collapse_copies`` identical
    rows are first merged into one row with a count (map-side partial
    aggregation), ranked once, and expanded to consecutive ranks, so a group of
    copies holding a third of the table is one row in the window, not one task.
    """
    g = list(groups)
    cols = df.columns
    if collapse_copies:
        base = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    else:
        base = df.withColumn("_copies", F.lit(1).cast("long"))
    counts = base.groupBy(*g, bucket).agg(F.sum("_copies").alias("_cnt"))
    w = Window.partitionBy(*g).orderBy(bucket)
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    if total:
        offsets = offsets.withColumn(total, F.sum("_cnt").over(Window.partitionBy(*g)))
    offsets = offsets.drop("_cnt")
    # every remaining column breaks ties, so the order is total and deterministic
    tie = [F.col(c) for c in cols if c not in (*g, bucket)]
    inner = Window.partitionBy(*g, bucket).orderBy(*_cols(order), *tie).rowsBetween(Window.unboundedPreceding, -1)
    ranked = base.join(F.broadcast(offsets), [*g, bucket]).withColumn(
        "_start", F.coalesce(F.sum("_copies").over(inner), F.lit(0)) + F.col("_off")
    )
    if collapse_copies:
        ranked = spell_out(ranked)
    else:
        ranked = ranked.withColumn("_i", F.lit(0))
    return ranked.withColumn(out, F.col("_start") + F.col("_i")).drop("_off", "_start", "_i", "_copies")


def hash_cuts(df: DataFrame, h: Column, id_col: str, ranks: dict, group: str | None = None,
              digits: int = CUT_DIGITS, max_rows: int = CUT_ROWS) -> dict:
    """The ``Cut`` at each of the 0-based ``ranks[g]`` in (hash, id) order, for each group g.

    No row is shuffled: buckets of ``digits`` leading hash digits are counted (map-side sums), and only the
    buckets that hold a wanted rank are ordered, copies merged first. While one of these has over ``max_rows``
    rows, they are counted again by as many digits more, unless that makes none smaller (copies of one id). Returns {g: [Cut, ...]}; ``ranks`` may hold functions of the
    group's size.
    """
    g = F.col(group) if group else F.lit(0)
    narrow = df.select(g.alias("_g"), h.alias("_h"), F.col(id_col).alias("_id"))
    start = lambda d: F.substring("_h", 1, d)
    counts = narrow.groupBy("_g", start(digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["_g"]: r["n"] for r in counts.groupBy("_g").agg(F.sum("_n").alias("n")).collect()}
    wanted = {c: [r(n) if callable(r) else r for r in ranks.get(c, ranks.get("*", []))] for c, n in sizes.items()}
    same = lambda c: F.col("_g").eqNullSafe(F.lit(c))
    some = lambda conds: reduce(lambda a, b: a | b, conds)
    inside = [(c, r) for c, rs in wanted.items() for r in rs if 0 <= r < sizes[c]]
    found: dict = {}
    if inside:
        def holding(counted: DataFrame, before: dict, d: int) -> dict:
            """{(group, bucket): (rows before it, its rows)} for the buckets that hold a wanted rank; ``before``
            has the former step's buckets."""
            up = start_of(d - digits) if before else F.lit("")
            w = Window.partitionBy("_g", up).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
            off = F.coalesce(F.sum("_n").over(w), F.lit(0))
            if before:
                first = F.lit(None).cast("long")
                for (c, p), (o, _) in before.items():
                    first = F.when(same(c) & (up == F.lit(p)), F.lit(o)).otherwise(first)
                off = off + first
            at = counted.withColumn("_off", off)
            hit = [same(c) & (F.col("_off") <= r) & (F.lit(r) < F.col("_off") + F.col("_n")) for c, r in inside]
            return {(b["_g"], b["_b"]): (b["_off"], b["_n"]) for b in at.where(some(hit)).collect()}  # one bucket a cut at most

        start_of = lambda d: F.substring("_b", 1, d)
        depth, buckets = digits, holding(counts, {}, digits)
        largest = lambda bs: max((n for _, n in bs.values()), default=0)
        member = lambda bs, d: some([same(c) & (start(d) == F.lit(p)) for c, p in bs])
        while largest(buckets) > max_rows and depth < 32:
            finer = narrow.where(member(buckets, depth)).groupBy("_g", start(depth + digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
            finer, former = holding(finer, buckets, depth + digits), largest(buckets)
            depth, buckets = depth + digits, finer
            if largest(buckets) == former:
                break
        if buckets:
            rows = narrow.where(member(buckets, depth)).groupBy("_g", start(depth).alias("_b"), "_h", "_id").agg(F.count(F.lit(1)).alias("_n"))
            before = F.sum("_n").over(Window.partitionBy("_g", "_b").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, -1))
            rows = rows.withColumn("_lo", F.coalesce(before, F.lit(0)))
            cond = [same(c) & (F.col("_b") == F.lit(b)) & (F.col("_lo") <= r - o) & (F.lit(r - o) < F.col("_lo") + F.col("_n"))
                    for c, r in inside for (gc, b), (o, n) in buckets.items() if gc == c and o <= r < o + n]
            for r in rows.where(some(cond)).collect():
                o = buckets[r["_g"], r["_b"]][0]
                for c, k in inside:
                    if c == r["_g"] and r["_lo"] + o <= k < r["_lo"] + o + r["_n"]:
                        found[c, k] = (r["_h"], r["_id"], r["_lo"] + o)
    counts.unpersist()
    return {c: [Cut(r, *found.get((c, r), (None, None, r))) for r in rs] for c, rs in wanted.items()}


@dataclass(frozen=True)
class Cut:
    """A place in (hash, id) order: the row of ``rank`` has this hash and id, whose copies start at
    rank ``first``. Past the end there is no such row."""

    rank: int
    hash: str | None
    id: object
    first: int

    @property
    def inside(self) -> bool:
        """Whether copies of one id stand on both sides."""
        return self.hash is not None and self.first < self.rank

    def reached(self, h: Column, id_col: str) -> Column:
        """Whether a row stands at or after the cut (copies of its id do)."""
        if self.hash is None:
            return F.lit(False)
        return (h > F.lit(self.hash)) | ((h == F.lit(self.hash)) & (F.col(id_col) >= F.lit(self.id)))


def count_reached(df: DataFrame, h: Column, id_col: str, cuts: dict, group: str | None, out: str) -> DataFrame:
    """``df`` with ``out``: how many of its group's cuts each row has reached.

    Rows compare themselves with the cuts, which moves none. Only where a cut falls among copies
    of one id are those copies merged into counts, ranked and spelled out again.
    """
    reached = F.lit(0)
    inside: dict = {}
    for c, places in cuts.items():
        own = F.col(group).eqNullSafe(F.lit(c)) if group else F.lit(True)
        n = F.lit(0)
        for cut in places:
            n = n + cut.reached(h, id_col).cast("int")
            if cut.inside:
                inside[c, cut.hash, cut.id, cut.first] = own & (h == F.lit(cut.hash)) & (F.col(id_col) == F.lit(cut.id))
        reached = F.when(own, n).otherwise(reached)
    if not inside:
        return df.withColumn(out, reached)
    torn = F.coalesce(reduce(lambda a, b: a | b, inside.values()), F.lit(False))
    first, passed = F.lit(0), F.lit(0)
    for (c, _, _, lo), cond in inside.items():
        first = F.when(cond, F.lit(lo)).otherwise(first)
        passed = F.when(cond, sum((F.col("_rank") >= F.lit(x.rank)).cast("int") for x in cuts[c])).otherwise(passed)
    some = df.where(torn).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    keys = [id_col] + ([group] if group else [])
    w = Window.partitionBy(*keys).orderBy(*(c for c in df.columns if c not in keys), F.lit(0)).rowsBetween(Window.unboundedPreceding, -1)
    some = spell_out(some.withColumn("_start", first + F.coalesce(F.sum("_copies").over(w), F.lit(0))))
    some = some.withColumn("_rank", F.col("_start") + F.col("_i")).withColumn(out, passed)
    return df.where(~torn).withColumn(out, reached).unionByName(some.select(*df.columns, out))


def spell_out(df: DataFrame) -> DataFrame:
    """One row for each of ``_copies``, numbered ``_i`` from 0; in two steps, so that no array is longer
    than a million however many copies there are."""
    step = 1_000_000
    df = df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(step))))
    return df.withColumn("_i", F.explode(F.sequence(F.col("_k"), F.least(F.col("_k") + step, F.col("_copies")) - 1))).drop("_k")


def hash_bucket(hexcol: Column, digits: int = RANK_DIGITS) -> Column:
    """Monotone bucket of an md5 hex string: its first ``digits`` hex digits."""
    return F.conv(F.substring(hexcol, 1, digits), 16, 10).cast("int")
