"""Batch scoring (M18, P9, A18), persistence (S5-S10) and the train-and-save job.

Files go under the cluster's shared ``spark.checkpoint.dir`` (never a
machine-local folder); every write is a distributed ``DataFrame.write``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bayes, sampling
from ..session import ensure_checkpoint_dir
from ..sources.tables import write_table
from . import features as feats
from . import training

LABEL = feats.LABEL_COL
ID = feats.ID_COL


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/skylane/{name}-{uuid.uuid4().hex[:12]}"


def align_schema(df: DataFrame, feature_columns: Sequence[str], keep: Sequence[str] = (ID, LABEL)) -> DataFrame:
    """Trained column order; a missing feature becomes 0.0, extra columns are dropped."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep if c in have]
    cols += [F.col(c) if c in have else F.lit(0.0).alias(c) for c in feature_columns]
    return df.select(*cols)


def score_batch(cleaned_rows: DataFrame, model: bayes.GaussianNB, fitted: feats.FittedFeatures | None = None,
                return_proba: bool = True, threshold: float | None = None) -> DataFrame:
    """Features (stored fit, or refit when ``fitted`` is None), align, score.

    Keeps ``ROW_ID``; ``PREDICTION`` is the argmax class, or ``PROBA >= threshold``.
    """
    x = feats.build_features(cleaned_rows, fitted, one_hot=False)
    x = align_schema(x, model.features)
    out = model.transform(x)
    if threshold is not None:
        out = out.withColumn("PREDICTION", (F.col("PROBA") >= threshold).cast("int"))
    return out if return_proba else out.drop("PROBA")


def write_metrics(rows: DataFrame, path: str) -> None:
    """Metric rows as JSON. Numbers stay numbers; an infinite ROC threshold is the text that JSON needs."""
    rows.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S8/S9 read back with the declared schema (``Infinity`` becomes a double again)."""
    return spark.read.schema(schema).json(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """The ranked importance table as CSV."""
    write_table(importance, path, fmt="csv")


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def published(spark: SparkSession, root: str) -> list[str]:
    """Folders of the complete versions under ``root``, oldest first."""
    fs, p = _files(spark, f"{root}/manifest")
    if not fs.exists(p):
        return []
    # a manifest that broke off has no committed file, so it names no version
    rows = spark.read.schema("version string").json(f"{root}/manifest/*").collect()  # as many as are kept
    return [f"{root}/versions/{v}" for v in sorted(r["version"] for r in rows)]


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = 2) -> str:
    """A new version under ``root``: ``write`` fills a folder of its own, and only then a manifest names it.

    Readers follow the manifests, so they see the former version until everything of the new one is
    written. The last ``keep`` versions stay, older ones and their manifests go.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/versions/{version}"
    write(folder)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.json(f"{root}/manifest/{version}")
    for old in published(spark, root)[:-keep]:
        # the manifest first, so that no reader is sent to a folder that goes
        for path in (f"{root}/manifest/{old.rsplit('/', 1)[1]}", old):
            fs, p = _files(spark, path)
            fs.delete(p, True)
    return folder


def load_published(spark: SparkSession, root: str) -> tuple[bayes.GaussianNB, feats.FittedFeatures]:
    """The scorer of the latest complete version under ``root``."""
    versions = published(spark, root)
    if not versions:
        raise FileNotFoundError(f"{root} has no complete version")
    return load_scorer(spark, versions[-1])


def load_scorer(spark: SparkSession, path: str) -> tuple[bayes.GaussianNB, feats.FittedFeatures]:
    """The model and the feature fit that ``train_and_save`` wrote to ``path``."""
    return bayes.GaussianNB.load(spark, f"{path}/model"), feats.FittedFeatures.load(spark, f"{path}/features")


def train_and_save(spark: SparkSession, sf_dir: str, smoothing: float = bayes.DEFAULT_SMOOTHING,
                   threshold: float = 0.5, cv_splits: int = 5, out_dir: str | None = None,
                   split: DataFrame | None = None):
    """Clean -> label -> split -> features -> CV -> fit -> metrics -> save.

    Returns (model, metrics DataFrame, output folder). The metrics frame holds the
    train/test rows plus cv_mean, cv_std, var_smoothing and threshold; the folder also
    has the model and the feature fit (see ``load_scorer``) and the times. It is a version of
    its own under ``out_dir``, which readers see once it is complete (``load_published``).
    ``split`` is the cleaned, labelled table as ``stratified_split`` deals it, if the caller has it already.
    """
    sfe = training.split_features(spark, sf_dir, split=split)
    feat = list(feats.KEEP_FEATURES)
    # the folds compare the persisted rows with literals, so a second copy of them is not kept
    cv = bayes.cv_f1(sampling.kfold(sfe.train, k=cv_splits), feat, LABEL, [smoothing]).first()
    t0 = time.perf_counter()
    model, rows = training.nb_report(sfe.train, sfe.test, feat, smoothing, threshold)
    fit_time = time.perf_counter() - t0
    extra = spark.createDataFrame(
        [("cv", "cv_mean", float(cv["cv_mean"])), ("cv", "cv_std", float(cv["cv_std"])),
         ("params", "var_smoothing", float(smoothing)), ("params", "threshold", float(threshold))],
        "split string, metric string, value double",
    )
    report = rows.unionByName(extra)
    meta = {"feature_columns": feat, "var_smoothing": smoothing, "threshold": threshold,
            "training_and_report_time": fit_time, "trained_at": time.time()}

    def write(folder: str) -> None:
        model.save(spark, f"{folder}/model")
        sfe.fitted.save(spark, f"{folder}/features")
        write_metrics(report, f"{folder}/metrics")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{folder}/meta")

    return model, report, publish(spark, out_dir or shared_path(spark, "nb_model"), write)
