"""Exact evaluation metrics (A4, A8-A16, A18) as aggregates over scored rows.

Confusion counts are one pass of ``count_if``. ROC and AUC first collapse rows
to one row per distinct score (partial aggregation absorbs ties and hot scores),
then range-partition these rows on the score. A partition's own sums need one pass over
Arrow batches; what lies before a partition is the sum of one row a partition, so no
step holds all scores in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .stats import values_at_ranks


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _ratio(a: Column, b: Column) -> Column:
    """a / b as double; 0 when b is 0 (the zero_division=0 rule)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, pred: str | Column, groups=()) -> DataFrame:
    """TN, FP, FN, TP (bigint) in one aggregate."""
    y, p = _c(label), _c(pred)
    return df.groupBy(*groups).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def rates_from_counts(counts: DataFrame) -> DataFrame:
    """A9/A10/A13 from confusion counts."""
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    sens = _ratio(tp, tp + fn)
    spec = _ratio(tn, tn + fp)
    return counts.select(
        "*",
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        sens.alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        sens.alias("sensitivity"),
        spec.alias("specificity"),
        ((sens + spec) / 2).alias("hard_label_auc"),
    )


def classification_metrics(df: DataFrame, label: str, pred: str | Column, groups=()) -> DataFrame:
    return rates_from_counts(confusion_counts(df, label, pred, groups))


def score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score with its positive and negative counts."""
    y = _c(label)
    return df.where(_c(score).isNotNull()).groupBy(score).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")
    )


def _ranged(per: DataFrame, score: str, ranges: int | None) -> DataFrame:
    """(place, score, pos, neg), highest first: ``place`` numbers the ranges of the score in order, each sorted inside."""
    n = ranges or int(per.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = per.select(F.col(score).cast("double").alias("score"), "pos", "neg")
    rows = rows.repartitionByRange(n, F.desc("score")).sortWithinPartitions(F.desc("score"))
    return rows.select(F.spark_partition_id().alias("place"), "score", "pos", "neg")


def _range_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: its place, counts, first point, and the pairs of a positive above a negative inside it."""
    pos = neg = 0
    pairs, first, place, some = 0.0, (0, 0), 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        p, n = batch.column("pos").to_numpy().astype(np.float64), batch.column("neg").to_numpy().astype(np.float64)
        if not some:
            some, first, place = True, (int(p[0]), int(n[0])), batch.column("place")[0].as_py()
        # positives above a negative's score count in full, those at it by half
        pairs += float((n * (pos + np.cumsum(p) - p / 2)).sum())
        pos, neg = pos + int(p.sum()), neg + int(n.sum())
    if some:
        row = {"place": place, "pos": pos, "neg": neg, "first_pos": first[0], "first_neg": first[1], "pairs": pairs}
        yield pa.RecordBatch.from_pydict({c: [x] for c, x in row.items()})


_SUMS = "place long, pos long, neg long, first_pos long, first_neg long, pairs double"


def roc_auc(df: DataFrame, label: str, score: str, ranges: int | None = None) -> DataFrame:
    """Tie-aware ROC-AUC = P(s+ > s-) + 0.5 P(s+ = s-); NULL if a class is absent."""
    # the range exchange samples its input first: one scan and aggregate of the scored rows, not two
    per = score_table(df, label, score).persist(StorageLevel.MEMORY_AND_DISK)
    sums = sorted(_ranged(per, score, ranges).mapInArrow(_range_sums, _SUMS).collect())  # a row a range
    per.unpersist()
    above, won = 0, 0.0
    for r in sums:
        won += r["pairs"] + above * r["neg"]
        above += r["pos"]
    pairs = above * sum(r["neg"] for r in sums)
    return df.sparkSession.createDataFrame([(won / pairs if pairs else None,)], "roc_auc double")


def _curve_points(before: dict, after: dict, totals: tuple, top: int, drop: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        pos = neg = 0

        def points(s, p, n, keep):
            nonlocal pos, neg
            cp, cn = pos + np.cumsum(p), neg + np.cumsum(n)
            pos, neg = int(cp[-1]), int(cn[-1])
            rate = lambda c, total: pa.array(c[keep] / total) if total else pa.nulls(int(keep.sum()), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(s[keep]), rate(cn, totals[1]), rate(cp, totals[0])], ["threshold", "fpr", "tpr"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:  # a task's rows are one range's
                place = batch.column("place")[0].as_py()
                (pos, neg), first = before[place], place == top
            now = [batch.column(c).to_numpy() for c in ("score", "pos", "neg")]
            if held is not None:
                now = [np.concatenate([h, x]) for h, x in zip(held, now)]
            s, p, n = now
            # a point whose step equals the next one's lies on a line: the last point waits for what follows
            held = [x[-1:] for x in now]
            if len(s) > 1:
                keep = (p[1:] != p[:-1]) | (n[1:] != n[:-1]) | (not drop)
                keep[0] |= first
                first = False
                yield points(s[:-1], p[:-1], n[:-1], keep)
        if held is not None:
            s, p, n = held
            same = after.get(place) == (int(p[0]), int(n[0]))
            yield points(s, p, n, np.array([first or not same or not drop]))

    return run


def roc_curve(df: DataFrame, label: str, score: str, drop_intermediate: bool = True,
              ranges: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, descending, with the leading
    (inf, 0, 0) point; interior points whose step equals the next step are dropped
    (the second-difference rule)."""
    # read twice, the second time when the caller asks: a checkpoint needs no release and keeps its partitions
    ensure_checkpoint_dir(df.sparkSession)
    per = score_table(df, label, score).persist(StorageLevel.MEMORY_AND_DISK)
    points = _ranged(per, score, ranges).checkpoint()
    per.unpersist()
    sums = sorted(points.mapInArrow(_range_sums, _SUMS).collect())  # a row a range
    before, after, pos, neg = {}, {}, 0, 0
    for r, nxt in zip(sums, [*sums[1:], None]):
        before[r["place"]] = (pos, neg)
        pos, neg = pos + r["pos"], neg + r["neg"]
        if nxt:
            after[r["place"]] = (nxt["first_pos"], nxt["first_neg"])
    top = sums[0]["place"] if sums else -1
    body = points.mapInArrow(_curve_points(before, after, (pos, neg), top, drop_intermediate), "threshold double, fpr double, tpr double")
    head = df.sparkSession.range(1).select(F.lit(math.inf).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return head.unionByName(body)


def threshold_summary(roc: DataFrame) -> DataFrame:
    """Mean and median ROC threshold, with and without the leading infinite point.

    The thresholds are the distinct scores plus +inf, so the mean with it is +inf;
    the median with it takes rank n/2 of the finite thresholds and +inf last.
    """
    finite = roc.where(F.col("threshold") != F.lit(math.inf))
    agg = finite.agg(F.avg("threshold").alias("m"), F.count(F.lit(1)).alias("n")).first()
    n = agg["n"]

    def median(count: int, extra_inf: bool):
        total = count + (1 if extra_inf else 0)
        if total == 0:
            return None
        h = (total - 1) / 2
        lo, hi = math.floor(h), math.ceil(h)
        got = values_at_ranks(finite, "threshold", [r for r in {lo, hi} if r < count])
        a = got.get(lo, math.inf)
        b = got.get(hi, math.inf)
        return a if a == b else a + (h - lo) * (b - a)

    return roc.sparkSession.createDataFrame(
        [(math.inf, median(n, True), agg["m"], median(n, False))],
        "mean_threshold double, median_threshold double, mean_finite double, median_finite double",
    )


def predicted_share(df: DataFrame, pred: str) -> DataFrame:
    """Number and share of rows predicted positive."""
    return df.agg(
        F.count_if(F.col(pred) == 1).alias("predicted_delays"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("share", F.try_divide(F.col("predicted_delays").cast("double"), F.col("rows").cast("double")))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """A4: per class count, percent of rows, and majority/minority imbalance ratio."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return g.select(
        label,
        "n",
        (F.col("n") * 100.0 / F.sum("n").over(w)).alias("percent"),
        F.try_divide(F.max("n").over(w).cast("double"), F.min("n").over(w).cast("double")).alias("imbalance_ratio"),
    )


def overfit_report(train: DataFrame, test: DataFrame, gap: float = 0.1) -> DataFrame:
    """Per metric train/test values, absolute gap and the gap > 0.1 flag.

    Inputs are tidy (metric, value) frames with one row per metric.
    """
    t = train.select("metric", F.col("value").alias("train"))
    s = test.select("metric", F.col("value").alias("test"))
    return t.join(s, "metric").select(
        "metric", "train", "test", F.abs(F.col("train") - F.col("test")).alias("diff"),
        (F.abs(F.col("train") - F.col("test")) > gap).alias("overfit"),
    )


def tidy_metrics(rates: DataFrame, auc: DataFrame | None, split: str) -> DataFrame:
    """Five headline metrics as (split, metric, value) rows."""
    r = rates.select(
        F.lit(split).alias("split"),
        F.explode(F.array(
            F.struct(F.lit("Accuracy").alias("metric"), F.col("accuracy").alias("value")),
            F.struct(F.lit("Precision").alias("metric"), F.col("precision").alias("value")),
            F.struct(F.lit("Recall").alias("metric"), F.col("recall").alias("value")),
            F.struct(F.lit("F1-Score").alias("metric"), F.col("f1").alias("value")),
        )).alias("m"),
    ).select("split", "m.metric", "m.value")
    if auc is None:
        return r
    a = auc.select(F.lit(split).alias("split"), F.lit("ROC-AUC").alias("metric"), F.col("roc_auc").alias("value"))
    return r.unionByName(a)
