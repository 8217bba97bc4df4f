"""Gaussian naive Bayes with adjustable variance smoothing.

Fit is one ``groupBy(label)`` aggregate of count, mean and population variance
per feature (partial aggregation on the map side, so a hot class costs nothing).
The overall feature variance that sets the smoothing term is merged from the same
per-class moments. The model is a handful of numbers (classes x features), so
scoring is literal Column arithmetic inside whole-stage codegen.

Cross-validation (section 4.3 of the survey): one scan computes moments per
(fold, class); the training moments of fold f are the merge of the other folds
(parallel-variance merge, no subtraction). A second scan scores every fold and
every smoothing value at once against a broadcast k-row parameter table and
aggregates confusion counts per (fold, smoothing).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Smoothing grid of the search.
SMOOTHING_GRID = [1e-9, 1e-8, 1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1]
DEFAULT_SMOOTHING = 1e-5
LOG_2PI = math.log(2 * math.pi)


@dataclass
class Moments:
    n: int
    mean: list
    m2: list  # sum of squared deviations (n * population variance)

    def merge(self, o: "Moments") -> "Moments":
        if self.n == 0:
            return o
        if o.n == 0:
            return self
        n = self.n + o.n
        mean, m2 = [], []
        for a, b, sa, sb in zip(self.mean, o.mean, self.m2, o.m2):
            d = b - a
            mean.append(a + d * o.n / n)
            m2.append(sa + sb + d * d * self.n * o.n / n)
        return Moments(n, mean, m2)

    @property
    def var(self) -> list:
        return [s / self.n for s in self.m2] if self.n else [math.nan] * len(self.m2)


def moments_frame(df: DataFrame, features: Sequence[str], label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Per (groups, class): count, mean and population variance of every feature."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(features):
        aggs += [F.avg(c).alias(f"_m{i}"), F.var_pop(c).alias(f"_v{i}")]
    return df.groupBy(*groups, label).agg(*aggs)


def _collect_moments(mf: DataFrame, features, label, groups=()) -> dict:
    out = {}
    for r in mf.collect():
        key = tuple(r[g] for g in groups) + (r[label],)
        n = r["_n"]
        out[key] = Moments(n, [r[f"_m{i}"] for i in range(len(features))],
                           [r[f"_v{i}"] * n for i in range(len(features))])
    return out


@dataclass
class FoldMoments:
    """Moments per (fold, class) of some columns, from one scan; any subset of the columns is a slice."""

    features: list
    parts: dict  # (fold, class) -> Moments

    @classmethod
    def of(cls, folded: DataFrame, features: Sequence[str], label: str, fold_col: str = "FOLD") -> "FoldMoments":
        names = list(features)
        return cls(names, _collect_moments(moments_frame(folded, names, label, [fold_col]), names, label, [fold_col]))

    def sliced(self, features: Sequence[str]) -> dict:
        at = [self.features.index(c) for c in features]
        return {k: Moments(m.n, [m.mean[i] for i in at], [m.m2[i] for i in at]) for k, m in self.parts.items()}

    def per_class(self, features: Sequence[str]) -> dict:
        """{class: Moments} of all folds together: what a fit on every row needs."""
        out: dict = {}
        zero = [0.0] * len(features)
        for (_, c), m in sorted(self.sliced(features).items()):
            out[c] = out.get(c, Moments(0, zero, zero)).merge(m)
        return out


@dataclass
class GaussianNB:
    features: list
    classes: list
    prior: list  # per class
    theta: list  # per class, per feature
    sigma: list  # per class, per feature: variance + epsilon
    epsilon: float
    var_smoothing: float

    @classmethod
    def from_moments(cls, features, per_class: dict, var_smoothing: float) -> "GaussianNB":
        classes = sorted(c for c in per_class if per_class[c].n)
        total = Moments(0, [0.0] * len(features), [0.0] * len(features))
        for c in classes:
            total = total.merge(per_class[c])
        eps = var_smoothing * max(total.var) if classes else 0.0
        return cls(
            list(features), classes,
            [per_class[c].n / total.n for c in classes],
            [per_class[c].mean for c in classes],
            [[v + eps for v in per_class[c].var] for c in classes],
            eps, var_smoothing,
        )

    # ---- scoring -------------------------------------------------------
    def joint_log_likelihood(self, k: int) -> Column:
        """NULL when a smoothed variance is zero (every feature is constant): no density exists."""
        if min(self.sigma[k]) <= 0:
            return F.lit(None).cast("double")
        const = math.log(self.prior[k]) - 0.5 * sum(LOG_2PI + math.log(s) for s in self.sigma[k])
        quad = None
        for c, th, s in zip(self.features, self.theta[k], self.sigma[k]):
            term = (F.col(c) - F.lit(th)) * (F.col(c) - F.lit(th)) / F.lit(s)
            quad = term if quad is None else quad + term
        return F.lit(const) - F.lit(0.5) * quad

    def proba(self) -> Column:
        """M4: P(class = last class), computed as a stable logistic of the jll gap."""
        if len(self.classes) == 1:
            return F.lit(1.0)
        d = self.joint_log_likelihood(0) - self.joint_log_likelihood(len(self.classes) - 1)
        return stable_sigmoid_of_gap(d)

    def transform(self, df: DataFrame, proba: str = "PROBA", pred: str = "PREDICTION") -> DataFrame:
        """Adds P(last class) and the argmax class; each jll is computed once per row.

        A model of one class gives it to every row with probability 1; without a
        density (see ``joint_log_likelihood``) both columns are NULL.
        """
        if len(self.classes) == 1:
            return df.withColumns({proba: F.lit(1.0), pred: F.lit(self.classes[0])})
        last = len(self.classes) - 1
        j = df.withColumns({"_jll0": self.joint_log_likelihood(0), "_jll1": self.joint_log_likelihood(last)})
        gap = F.col("_jll0") - F.col("_jll1")
        out = j.withColumns({
            proba: stable_sigmoid_of_gap(gap),
            pred: F.when(F.col("_jll1") > F.col("_jll0"), F.lit(self.classes[-1])).when(gap.isNotNull(), F.lit(self.classes[0])),
        })
        return out.drop("_jll0", "_jll1")

    # ---- persistence (S10) --------------------------------------------
    def params_frame(self, spark: SparkSession) -> DataFrame:
        rows = []
        for k, c in enumerate(self.classes):
            for j, f in enumerate(self.features):
                rows.append((int(c), f, float(self.prior[k]), float(self.theta[k][j]), float(self.sigma[k][j])))
        return spark.createDataFrame(rows, "label int, feature string, prior double, theta double, sigma double")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "GaussianNB":
        return cls(**json.loads(text))

    def save(self, spark: SparkSession, path: str) -> None:
        """Parameters as a small Parquet table plus one JSON row (metadata)."""
        self.params_frame(spark).write.mode("overwrite").parquet(f"{path}/params")
        spark.createDataFrame([(self.to_json(),)], "model string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "GaussianNB":
        return cls.from_json(spark.read.json(f"{path}/meta").first()["model"])


def stable_sigmoid_of_gap(d: Column) -> Column:
    """1 / (1 + exp(d)) without overflow."""
    return F.when(d > 0, F.exp(-d) / (F.lit(1.0) + F.exp(-d))).otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(d)))


def fit_gaussian_nb(df: DataFrame, features: Sequence[str], label: str,
                    var_smoothing: float = DEFAULT_SMOOTHING) -> GaussianNB:
    """M3: one aggregate; the model is built from per-class moments."""
    per = _collect_moments(moments_frame(df, features, label), features, label)
    return GaussianNB.from_moments(features, {k[0]: m for k, m in per.items()}, var_smoothing)


def nb_params_frame(df: DataFrame, features: Sequence[str], label: str,
                    var_smoothing: float = DEFAULT_SMOOTHING) -> DataFrame:
    """M3 as a tidy DataFrame (label, feature, prior, theta, sigma)."""
    return fit_gaussian_nb(df, features, label, var_smoothing).params_frame(df.sparkSession)


# ------------------------------------------------------------ CV / search ---

def _fold_params(fm: dict, features, k: int, classes, smoothings) -> list[dict]:
    """Per fold and class, from the training moments (merge of the other folds): the means, the jll constants
    (one per smoothing value, None without a density) and the inverse smoothed variances (a row a smoothing value).
    """
    out = []
    nf = len(features)
    for f in range(k):
        per_class = {}
        for c in classes:
            m = Moments(0, [0.0] * nf, [0.0] * nf)
            for g in range(k):
                if g != f and (g, c) in fm:
                    m = m.merge(fm[(g, c)])
            per_class[c] = m
        total = Moments(0, [0.0] * nf, [0.0] * nf)
        for c in classes:
            total = total.merge(per_class[c])
        maxvar = float(max(total.var)) if total.n else 0.0
        of_class = {}
        present = [c for c in classes if per_class[c].n]
        for c in classes:
            pc = per_class[c]
            consts, inv = [], []
            for sm in smoothings:
                var = [v + sm * maxvar for v in pc.var]
                if not pc.n:  # a class this training side lacks is never predicted
                    consts.append(-math.inf)
                    inv.append([0.0] * nf)
                elif len(present) == 1:  # the only class is
                    consts.append(0.0)
                    inv.append([0.0] * nf)
                elif min(var) <= 0:  # constant features: no density, no prediction
                    consts.append(None)
                    inv.append([0.0] * nf)
                else:
                    consts.append(math.log(pc.n / total.n) - 0.5 * sum(LOG_2PI + math.log(v) for v in var))
                    inv.append([1.0 / v for v in var])
            of_class[c] = ([float(x) for x in pc.mean], consts, inv)
        out.append(of_class)
    return out


def _count_folds(params: list[dict], first, last, n_features: int, n_smoothings: int):
    """Sums of (fold, smoothing index): TP, FP, FN, TN of a task's rows, whose columns are fold, label and the features.

    The joint log-likelihoods are summed feature by feature as ``GaussianNB`` sums them. A row with a missing value
    has no prediction; NaN is above any number, as in Spark.
    """
    def side(of_class: dict, c) -> tuple:
        mean, consts, inv = of_class[c]
        return np.array(mean), np.array([np.nan if x is None else x for x in consts]), np.array([x is None for x in consts]), np.array(inv)

    tables = [(side(p, first), side(p, last)) for p in params]

    def jll(x: list[np.ndarray], mean, const, inv) -> np.ndarray:
        quad = np.zeros((n_smoothings, len(x[0]))) if x else np.zeros((n_smoothings, 0))
        for j, v in enumerate(x):
            d = v - mean[j]
            d *= d
            quad += d[None, :] * inv[:, j, None]
        return const[:, None] - 0.5 * quad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(params), n_smoothings, 4), np.int64)
        seen = np.zeros(len(params), bool)
        for batch in batches:
            fold = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            known = np.ones(len(fold), bool)
            cols = []
            for j in range(n_features):
                c = batch.column(2 + j)
                if c.null_count:
                    known &= c.is_valid().to_numpy(zero_copy_only=False)
                cols.append(c.to_numpy(zero_copy_only=False))
            for f, (one, two) in enumerate(tables):
                mine = fold == f
                seen[f] |= mine.any()
                rows = np.flatnonzero(mine & known)
                for lo in range(0, len(rows), 2048):  # a block whose sums stay in the processor's cache
                    some = rows[lo : lo + 2048]
                    x = [c[some] for c in cols]
                    a, b = (jll(x, mean, const, inv) for mean, const, _, inv in (two, one))
                    p = (a > b) | (np.isnan(a) & ~np.isnan(b))
                    ok = ~(one[2] | two[2])[:, None]
                    pos, neg = (y[some] == 1)[None, :], (y[some] == 0)[None, :]
                    for i, hit in enumerate((pos & p, neg & p, pos & ~p, neg & ~p)):
                        sums[f, :, i] += (hit & ok).sum(axis=1)
        at = [(f, s) for f in np.flatnonzero(seen) for s in range(n_smoothings)]
        if at:
            f, s = (np.array(v) for v in zip(*at))
            counts = [pa.array(sums[f, s, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int32)), pa.array(s.astype(np.int32)), *counts], ["fold", "s", "tp", "fp", "fn", "tn"])

    return run


def cv_fold_counts(folded: DataFrame, features: Sequence[str], label: str, smoothings: Sequence[float],
                   fold_col: str = "FOLD", moments: FoldMoments | None = None) -> DataFrame:
    """Per (fold, smoothing index): TP, FP, FN, TN of held-out argmax predictions.

    ``moments`` are those of these rows and folds if the caller has them already.
    """
    names = list(features)
    fm_raw = (moments or FoldMoments.of(folded, names, label, fold_col)).sliced(names)
    classes = sorted({key[1] for key in fm_raw})
    k = max(key[0] for key in fm_raw) + 1
    params = _fold_params(fm_raw, names, k, classes, list(smoothings))
    rows = folded.select(F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
                         *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(names)])
    counts = rows.mapInArrow(_count_folds(params, classes[0], classes[-1], len(names), len(smoothings)),
                             "fold int, s int, tp long, fp long, fn long, tn long")
    counts = counts.groupBy(F.col("fold").cast(folded.schema[fold_col].dataType).alias(fold_col), "s")
    return counts.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


def cv_f1(folded: DataFrame, features: Sequence[str], label: str, smoothings: Sequence[float] = (DEFAULT_SMOOTHING,),
          fold_col: str = "FOLD", moments: FoldMoments | None = None) -> DataFrame:
    """M5: per smoothing value the fold F1 scores, their mean and population std."""
    counts = cv_fold_counts(folded, features, label, smoothings, fold_col, moments)
    f1 = F.coalesce(F.try_divide((2 * F.col("tp")).cast("double"), (2 * F.col("tp") + F.col("fp") + F.col("fn")).cast("double")), F.lit(0.0))
    grid = folded.sparkSession.createDataFrame([(i, float(s)) for i, s in enumerate(smoothings)], "s int, var_smoothing double")
    per = counts.withColumn("f1", f1)
    return (
        per.groupBy("s")
        .agg(F.avg("f1").alias("cv_mean"), F.stddev_pop("f1").alias("cv_std"), F.count(F.lit(1)).alias("folds"))
        .join(F.broadcast(grid), "s")
        .select("var_smoothing", "cv_mean", "cv_std", "folds")
    )


def smoothing_search(folded: DataFrame, features: Sequence[str], label: str,
                     grid: Sequence[float] = SMOOTHING_GRID, fold_col: str = "FOLD",
                     moments: FoldMoments | None = None) -> DataFrame:
    """M6: every grid value scored in the same two scans; rank 1 = best mean F1
    (ties: smaller smoothing)."""
    from pyspark.sql import Window

    res = cv_f1(folded, features, label, grid, fold_col, moments)
    w = Window.orderBy(F.col("cv_mean").desc(), F.col("var_smoothing").asc())
    return res.withColumn("rank", F.row_number().over(w))
