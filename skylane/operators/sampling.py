"""Splits, folds and resampling.

Randomness is a hash of (seed, ROW_ID), never ``rand()`` or partition-dependent
ids, so results do not change with partitioning, retries or lost executors, and
the same text runs in DuckDB.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import hash_hex, hash_int
from .ranks import CUT_DIGITS, RANK_DIGITS, bucketed_row_number, count_reached, hash_bucket, hash_cuts

ID = "ROW_ID"


def stratified_split(df: DataFrame, label: str, test_size: float = 0.3, seed: int = 42, id_col: str = ID,
                     digits: int = CUT_DIGITS, out: str = "IS_TEST") -> DataFrame:
    """M1: per class, rows ordered by md5('<seed>|' || id) (then id); the first
    ``round(test_size * n_class)`` rows are test. Adds 0/1 ``out``.

    Only the cut of each class is looked for; the rows then compare themselves with it,
    so none is shuffled.
    """
    h = hash_hex(seed, id_col)
    cuts = hash_cuts(df, h, id_col, {"*": [lambda n: math.floor(test_size * n + 0.5)]}, label, digits)
    return count_reached(df, h, id_col, cuts, label, out).withColumn(out, 1 - F.col(out))


def split_frames(df: DataFrame, label: str, test_size: float = 0.3, seed: int = 42, id_col: str = ID):
    """M1 as (train, test) frames."""
    s = stratified_split(df, label, test_size, seed, id_col)
    return s.where(F.col("IS_TEST") == 0).drop("IS_TEST"), s.where(F.col("IS_TEST") == 1).drop("IS_TEST")


def kfold(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = ID, digits: int = CUT_DIGITS, out: str = "FOLD") -> DataFrame:
    """M2: shuffled, unstratified k folds: contiguous ranges of the hash order whose
    sizes differ by at most one (ranks from floor(f * n / k) on are in fold f or later).

    The k - 1 cuts are looked for, then every row compares itself with them.
    """
    h = hash_hex(f"{seed}|fold", id_col)
    cuts = hash_cuts(df, h, id_col, {"*": [lambda n, f=f: f * n // k for f in range(1, k)]}, None, digits)
    return count_reached(df, h, id_col, cuts, None, out)


def class_counts(df: DataFrame, label: str) -> dict:
    """A4 helper: {class: rows}; two numbers reach the driver."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_weights(df: DataFrame, label: str, out: str = "WEIGHT") -> DataFrame:
    """M9: balanced weight n / (k * n_c) for k classes, as a literal per-class column
    (the class counts are one small aggregate)."""
    counts = class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    expr = None
    for c, nc in sorted(counts.items(), key=lambda kv: (kv[0] is None, kv[0])):
        cond = F.col(label).isNull() if c is None else F.col(label) == F.lit(c)
        w = F.lit(n / (k * nc))
        expr = F.when(cond, w) if expr is None else expr.when(cond, w)
    return df.withColumn(out, expr if expr is not None else F.lit(None).cast("double"))


def growth(counts: dict, ratio: float | None = None) -> tuple[object, dict]:
    """(majority class, {class: rows to add}) for oversampling.

    ``ratio=None`` grows every other class to the majority's size. A ratio is
    defined for two classes: the minority grows to ``ratio * n_major``.
    """
    if len(counts) < 2:
        raise ValueError("oversampling needs at least two classes")
    majority = max(counts, key=lambda c: (counts[c], -c))
    if ratio is not None and len(counts) > 2:
        raise ValueError("a ratio needs two classes")
    target = counts[majority] if ratio is None else int(ratio * counts[majority])
    adds = {}
    for c in sorted(set(counts) - {majority}):
        if target < counts[c]:
            raise ValueError(f"ratio {ratio} asks for fewer minority rows ({target}) than present ({counts[c]})")
        adds[c] = target - counts[c]
    return majority, adds


def class_seed(seed: int | str, c: object, counts: dict) -> str:
    """Draws of several classes must not repeat each other; with two classes the seed alone names them."""
    return f"{seed}" if len(counts) == 2 else f"{seed}|{c}"


def random_oversample(df: DataFrame, label: str, seed: int = 42, ratio: float | None = None,
                      id_col: str = ID, digits: int = RANK_DIGITS,
                      keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Keep every row and add copies of the smaller classes drawn with replacement.

    Draw ``j`` (0..m-1) copies row number ``hash(seed, j) mod n_class`` of its class (60
    bits of the hash, so every row can be drawn and the modulo is even). Copies get a new
    id ``md5(id || '|ros|' || j)``. See ``growth`` for the targets and errors. Where several passes
    read the rows, ``keep`` writes the copies once and reads them back.
    """
    counts = class_counts(df.where(F.col(label).isNotNull()), label)
    _, adds = growth(counts, ratio)
    spark: SparkSession = df.sparkSession
    out = df
    for c, m in adds.items():
        if not m:
            continue
        own = class_seed(seed, c, counts)
        x = df.where(F.col(label) == c).withColumn("_h", hash_hex(seed, id_col)).withColumn("_b", hash_bucket(F.col("_h"), digits))
        ranked = bucketed_row_number(x, "_b", ["_h", id_col], out="_idx").drop("_h", "_b")
        draws = spark.range(m).select(
            F.col("id").alias("_j"),
            F.pmod(hash_int(hash_hex(f"{own}|ros", F.col("id"))), F.lit(counts[c])).alias("_idx"),
        )
        copies = ranked.join(draws, "_idx").withColumn(
            id_col, F.md5(F.concat(F.col(id_col), F.lit("|ros|"), F.col("_j").cast("string")))
        )
        copies = copies.select(*df.columns)
        out = out.unionByName(keep(copies) if keep else copies)
    return out


def semi_by_id(df: DataFrame, ids: DataFrame, id_col: str = ID) -> DataFrame:
    """Keep rows whose id survives in ``ids`` (realign after rows were dropped)."""
    return df.join(ids.select(id_col), id_col, "left_semi")
