"""Six-variant naive-Bayes comparison (M15) with ranking (T4, T5) and best-by.

All variants share one split and one feature fit. Each variant is a training
transform (feature subset or resampling) followed by the same smoothing search
(9 values x 5 folds), a refit with the best value and exact test metrics. The moments per
(fold, class) of every column come from one scan of a training table: variants that
differ in their features alone slice them, and the refit merges the folds'.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import bayes, metrics, sampling, select, smote, trees
from ..sources.tables import staged
from . import features as feats
from . import training
from .scoring import shared_path, write_metrics

LABEL = feats.LABEL_COL
ID = feats.ID_COL

# The trees that screen features for variant 2.
SCREENING = {"n_estimators": 1000, "learning_rate": 0.1, "max_depth": 15}
# Variant names in run order.
VARIANTS = [
    "all_features",
    "top15_tree_importance",
    "correlation_screen",
    "smote_balanced",
    "smote_ratio_0.3",
    "random_oversample",
]


@dataclass
class VariantReport:
    """One variant's row (parameters, sizes, test and train metrics, gaps, confusion counts) and its ROC points."""
    row: DataFrame
    roc: DataFrame


class FoldedTrain:
    """A training table dealt into folds, with the moments of its columns; both are made once, when first used."""

    def __init__(self, train: DataFrame, features: Sequence[str], folds: int = 5):
        self.features, self._train, self._folds = list(features), train, folds
        self._folded = self._moments = None

    @property
    def folded(self) -> DataFrame:
        if self._folded is None:
            # read for the moments, by every search and by the train metrics
            self._folded = sampling.kfold(self._train, self._folds).persist(StorageLevel.MEMORY_AND_DISK)
        return self._folded

    @property
    def moments(self) -> bayes.FoldMoments:
        if self._moments is None:
            self._moments = bayes.FoldMoments.of(self.folded, self.features, LABEL)
        return self._moments

    def release(self) -> None:
        if self._folded is not None:
            self._folded.unpersist()
        self._folded = None


RATES = ("f1", "recall", "precision", "accuracy")


def nb_variant(name: str, train: FoldedTrain, test: DataFrame, features: Sequence[str],
               grid: Sequence[float] = bayes.SMOOTHING_GRID, threshold: float = 0.5,
               started: float | None = None) -> VariantReport:
    """One variant: search the smoothing grid by CV F1, refit, evaluate both sides."""
    spark = test.sparkSession
    t0 = started or time.perf_counter()
    features = list(features)
    best = bayes.smoothing_search(train.folded, features, LABEL, grid, moments=train.moments).where(F.col("rank") == 1).first()
    model = bayes.GaussianNB.from_moments(features, train.moments.per_class(features), float(best["var_smoothing"]))
    search_time = time.perf_counter() - t0
    got = {}
    for side, df in (("test", test), ("train", train.folded)):
        x = model.transform(df).withColumn("PREDICTION", (F.col("PROBA") >= threshold).cast("int"))
        x = x.select(LABEL, "PROBA", "PREDICTION").persist(StorageLevel.MEMORY_AND_DISK)
        r = metrics.classification_metrics(x, LABEL, "PREDICTION").first().asDict()
        r["roc_auc"] = metrics.roc_auc(x, LABEL, "PROBA").first()["roc_auc"]
        got[side] = r
        if side == "test":
            roc = metrics.roc_curve(x, LABEL, "PROBA").checkpoint().withColumn("variant", F.lit(name))
        x.unpersist()
    te, tr = got["test"], got["train"]
    values = {"variant": name, "var_smoothing": float(best["var_smoothing"]), "cv_f1": float(best["cv_mean"]),
              "n_features": len(features), "training_time": search_time}
    names = (*RATES, "roc_auc")
    values |= {m: te[m] for m in names}
    values |= {f"train_{m}": tr[m] for m in names}
    values |= {f"gap_{m}": abs(tr[m] - te[m]) if None not in (tr[m], te[m]) else None for m in names}
    values |= {m: te[m] for m in ("tn", "fp", "fn", "tp", "sensitivity", "specificity")}
    values["features"] = list(features)
    kinds = {"variant": "string", "n_features": "int", "features": "array<string>", "tn": "long", "fp": "long", "fn": "long", "tp": "long"}
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} {kinds.get(c, 'double')}" for c in values))
    return VariantReport(row, roc)


def nb_search_and_evaluate(name: str, train: DataFrame, test: DataFrame, features: Sequence[str],
                           grid: Sequence[float] = bayes.SMOOTHING_GRID, folds: int = 5,
                           threshold: float = 0.5) -> DataFrame:
    """The row of ``nb_variant`` for one training table."""
    dealt = FoldedTrain(train, features, folds)
    row = nb_variant(name, dealt, test, features, grid, threshold).row
    dealt.release()
    return row


def _variant_inputs(spark: SparkSession, sf_dir: str):
    sfe = training.split_features(spark, sf_dir, keep=None, one_hot=True)
    return sfe.train, sfe.test, sfe.features


def screening_report(model, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """The screening trees' own test metrics; its AUC is the one of hard labels."""
    scored = trees.tree_scores(model, test, features)
    r = metrics.classification_metrics(scored, LABEL, "PREDICTION")
    return r.select("accuracy", "precision", "recall", "f1", "hard_label_auc", "tn", "fp", "fn", "tp")


def variant_frames(spark: SparkSession, sf_dir: str, names: Sequence[str] = VARIANTS,
                   screening: dict = SCREENING) -> tuple[dict[str, Callable[[], tuple]], DataFrame]:
    """Lazily built (FoldedTrain, features) per variant; the test split never changes, and the
    variants that choose features share one table.

    ``screening`` has the parameters of the trees that pick variant 2's features.
    """
    train, test, cols = _variant_inputs(spark, sf_dir)
    whole = FoldedTrain(train, cols)

    def all_features():
        return whole, cols

    def top15_tree():
        model = trees.fit_trees(train, cols, LABEL, params=screening)
        path = shared_path(spark, "screening")
        trees.save_trees(model, path)
        imp = select.rank_by_importance(trees.split_counts(trees.node_table(spark, path), cols), top=15)
        return whole, [r["feature"] for r in imp.orderBy("rank").collect()]

    def corr():
        screen = select.correlation_screen(train, cols, LABEL, 0.6, 15)
        return whole, select.selected_features(screen)

    shared = {}

    def basis():
        # both SMOTE variants oversample the same training rows: one neighbour search
        if "b" not in shared:
            shared["b"] = smote.smote_basis(train, cols, LABEL)
        return shared["b"]

    def smote_full():
        return FoldedTrain(smote.smote(train, cols, LABEL, basis=basis()), cols), cols

    def smote_ratio():
        return FoldedTrain(smote.smote(train, cols, LABEL, ratio=0.3, basis=basis()), cols), cols

    def ros():
        # the folds' cuts read the rows twice before they are persisted
        return FoldedTrain(sampling.random_oversample(train, LABEL, keep=staged), cols), cols

    table = {
        "all_features": all_features, "top15_tree_importance": top15_tree, "correlation_screen": corr,
        "smote_balanced": smote_full, "smote_ratio_0.3": smote_ratio, "random_oversample": ros,
    }
    return {n: table[n] for n in names}, test


def compare_variants(spark: SparkSession, sf_dir: str, names: Sequence[str] = VARIANTS, screening: dict = SCREENING,
                     out_dir: str | None = None) -> DataFrame:
    """M15 + T4: one row per variant, ranked by test F1 (ties by name).

    With ``out_dir`` the report and the ROC points of every variant are written as JSON (S9).
    """
    frames, test = variant_frames(spark, sf_dir, names, screening)
    rows, curves, last = None, None, None
    for name, build in frames.items():
        t0 = time.perf_counter()
        tr, cols = build()
        if last is not None and last is not tr:
            last.release()
        last = tr
        r = nb_variant(name, tr, test.select(ID, LABEL, *cols), cols, started=t0)
        rows = r.row if rows is None else rows.unionByName(r.row)
        curves = r.roc if curves is None else curves.unionByName(r.roc)
    if last is not None:
        last.release()
    report = ranked(rows)
    if out_dir:
        write_metrics(report, f"{out_dir}/report")
        write_metrics(curves, f"{out_dir}/roc")
    return report


def ranked(rows: DataFrame) -> DataFrame:
    """T4: the variants by test F1, ties by name; a handful of rows."""
    w = Window.orderBy(F.col("f1").desc(), F.col("variant"))
    return rows.withColumn("rank", F.row_number().over(w))


def best_by(report: DataFrame, metric: str = "f1", highest: bool = True) -> DataFrame:
    """The first row by ``metric`` (ties: the earlier rank wins), via max_by on a
    (metric, -rank) struct so both engines break ties the same way. ``highest=False`` is for times."""
    key = F.struct(F.col(metric), -F.col("rank")) if highest else F.struct(-F.col(metric), -F.col("rank"))
    value = F.max(metric) if highest else F.min(metric)
    return report.agg(F.lit(metric).alias("metric"), F.max_by("variant", key).alias("best_variant"), value.alias("value"))


def best_of_all(report: DataFrame) -> DataFrame:
    """Best by F1, AUC, recall and precision, and the fastest."""
    out = best_by(report, "training_time", highest=False)
    for m in ("f1", "roc_auc", "recall", "precision"):
        out = best_by(report, m).unionByName(out)
    return out
