"""Exact order statistics without a global sort or a single-task buffer (A2).

``percentile`` keeps every distinct value of a group in one aggregation buffer,
which does not survive a 100 TB column. Instead:

1. approximate quantiles give up to ``buckets`` split points (one small array);
2. one pass counts rows per value bucket (``Bucketizer`` binary search, JVM side);
3. a bucket still too large is bucketed again over its own value range;
4. the bucket holding the wanted rank is reduced to (value, count) rows, so a hot
   value collapses to one row, and a window inside that bucket finds the value.

Only split points, per-bucket counts and the selected values reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucket_count(n: int, rows: int = 1_000_000, least: int = 256, most: int = 20_000) -> int:
    """Value buckets for ``n`` distinct values: ``rows`` a bucket, so a window task does not grow with the table.

    ``most`` bounds the split points that the driver holds; past ``most * rows`` values the buckets grow.
    """
    return max(least, min(most, -(-n // rows)))


def value_bucketizer(df: DataFrame, col: str, buckets: int = 1000, rel_err: float | None = None,
                     out: str = "_bucket") -> Bucketizer:
    """Equi-depth value buckets (monotone in ``col``) from approximate quantiles."""
    probs = [i / buckets for i in range(1, buckets)]
    rel = rel_err if rel_err is not None else 1.0 / (4 * buckets)
    qs = df.where(F.col(col).isNotNull()).approxQuantile(col, probs, rel)
    splits = sorted({float(q) for q in qs if q is not None and not math.isnan(q)})
    return Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=col, outputCol=out, handleInvalid="keep")


def _in_bucket(col: str, lo: float, hi: float):
    """Rows of the Bucketizer bucket [lo, hi) (the last bucket also holds +inf)."""
    cond = F.lit(True)
    if lo != -math.inf:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi != math.inf:
        cond = cond & (F.col(col) < F.lit(hi))
    return cond


def _select_ranks(df: DataFrame, col: str, ranks: Sequence[int], buckets: int,
                  max_rows: int = 4_000_000, depth: int = 0, known_n: int | None = None) -> dict[int, float]:
    """Values at 0-based ``ranks`` of the non-NULL ``col`` (ascending).

    A bucket still holding more than ``max_rows`` rows is bucketed again over its
    own value range (a filter the scan can push down), so the final window runs
    over a bounded slice even at 10^12 rows. Refinement stops when a level no
    longer shrinks the bucket (one hot value): that bucket collapses to its few
    distinct values before the window anyway.
    """
    data = df.select(col).where(F.col(col).isNotNull())
    bz = value_bucketizer(data, col, buckets)
    splits = bz.getSplits()
    b = bz.transform(data)
    counts = sorted((int(r["_bucket"]), int(r["n"])) for r in b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes = dict(counts)
    starts, acc = {}, 0
    for k, n in counts:
        starts[k] = acc
        acc += n
    wanted: dict[int, list[int]] = {}
    for r in ranks:
        for k, n in counts:
            if starts[k] <= r < starts[k] + n:
                wanted.setdefault(k, []).append(r - starts[k])
                break
    if not wanted:
        return {}
    out: dict[int, float] = {}
    total = known_n if known_n is not None else acc
    direct = {}
    for k, offs in wanted.items():
        shrinks = sizes[k] <= total // 2
        if sizes[k] > max_rows and shrinks and depth < 4 and k + 1 < len(splits):
            sub = data.where(_in_bucket(col, splits[k], splits[k + 1]))
            got = _select_ranks(sub, col, offs, buckets, max_rows, depth + 1, sizes[k])
            for o, v in got.items():
                out[starts[k] + o] = v
        else:
            direct[k] = offs
    if not direct:
        return out
    w = Window.partitionBy("_bucket").orderBy(col)
    vals = (
        b.where(F.col("_bucket").isin(list(direct)))
        .groupBy("_bucket", col)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_hi", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_lo", F.col("_hi") - F.col("n"))
    )
    cond = F.lit(False)
    for k, offs in direct.items():
        for o in offs:
            cond = cond | ((F.col("_bucket") == k) & (F.col("_lo") <= o) & (F.col("_hi") > o))
    rows = vals.where(cond).select("_bucket", col, "_lo", "_hi").collect()
    for k, offs in direct.items():
        for o in offs:
            for r in rows:
                if r["_bucket"] == k and r["_lo"] <= o < r["_hi"]:
                    out[starts[k] + o] = float(r[col])
    return out


def values_at_ranks(df: DataFrame, col: str, ranks: Sequence[int], buckets: int = 1000,
                    max_rows: int = 4_000_000) -> dict[int, float]:
    """Values at 0-based ascending ranks among the non-NULL ``col`` (exact)."""
    row = df.select(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n = row["n"]
    vals = {}
    inner = set()
    for r in ranks:
        if r == 0 and n > 0:
            vals[0] = float(row["lo"])
        elif r == n - 1 and n > 0:
            vals[r] = float(row["hi"])
        elif 0 < r < n - 1:
            inner.add(r)
    if inner:
        vals.update(_select_ranks(df, col, sorted(inner), buckets, max_rows))
    return vals


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], buckets: int = 1000,
                    max_rows: int = 4_000_000) -> list:
    """Linearly interpolated quantiles (NULLs skipped), exact at any scale.

    Probabilities 0 and 1 are the minimum and maximum and need one aggregate only.
    """
    row = df.select(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    n = row["n"]
    if n == 0:
        return [None for _ in probs]
    need: set[int] = set()
    pos = []
    for p in probs:
        h = (n - 1) * float(p)
        lo_i, hi_i = math.floor(h), math.ceil(h)
        pos.append((h, lo_i, hi_i))
        for i in (lo_i, hi_i):
            if 0 < i < n - 1:
                need.add(i)
    vals = {0: float(row["lo"]), n - 1: float(row["hi"])}
    if need:
        vals.update(_select_ranks(df, col, sorted(need), buckets, max_rows))
    out = []
    for h, lo_i, hi_i in pos:
        a, b = vals[lo_i], vals[hi_i]
        out.append(a + (h - lo_i) * (b - a))
    return out
