"""End-to-end plans: clean -> label -> split -> features -> fit -> evaluate.

Cleaned rows are written to the shared folder once (``staged``); cuts, fits and scoring read their columns from there.
The feature tables are persisted with MEMORY_AND_DISK: a lost block is recomputed from lineage, so a
lost executor costs time, not correctness.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bayes, metrics, sampling
from ..operators.clean import clean_flights
from ..session import compiled_methods
from ..sources.tables import airports_view, flight_targets, flights_view, staged
from . import features as feats

LABEL = feats.LABEL_COL
ID = feats.ID_COL


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 over the flight-shaped views."""
    return clean_flights(flights_view(spark, sf_dir), airports_view(spark, sf_dir))


def cleaned_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 then P11."""
    return feats.label_target(cleaned(spark, sf_dir))


def staged_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cleaned_labelled`` for plans that read it many times, written once.

    The target's statistics come from a join of its own on narrow columns; the target filter then sits
    below the wide join, so only lines that it keeps are shuffled.
    """
    flights = flights_view(spark, sf_dir)
    return staged(feats.label_target(clean_flights(flights, airports_view(spark, sf_dir), targets=flight_targets(spark, sf_dir))))


def _labelled(spark: SparkSession, sf_dir: str, cleaned_df: DataFrame | None, labelled: DataFrame | None) -> DataFrame:
    if cleaned_df is not None:
        return feats.label_target(cleaned_df)
    return labelled if labelled is not None else staged_labelled(spark, sf_dir)


@dataclass
class SplitFeatures:
    train: DataFrame
    test: DataFrame
    fitted: feats.FittedFeatures
    features: list = field(default_factory=list)
    held: list = field(default_factory=list)

    def release(self) -> None:
        """Let go of what ``split_features`` persisted, once train and test have been used."""
        for df in self.held:
            df.unpersist()


def split_features(spark: SparkSession, sf_dir: str, test_size: float = 0.3, seed: int = 42,
                   refit: bool = False, one_hot: bool = False, keep=feats.KEEP_FEATURES,
                   persist: bool = True, cleaned_df: DataFrame | None = None,
                   labelled: DataFrame | None = None, split: DataFrame | None = None) -> SplitFeatures:
    """M1 then M16 fitted on the training side (or refitted per side), then P8.

    ``cleaned_df`` reuses an already cleaned (unlabelled) frame, ``labelled`` one with its target and
    ``split`` one that ``stratified_split`` has dealt with this size and seed.
    """
    # features, moments and scores of that many columns make long methods
    compiled_methods(spark)
    # the split compares each row with the cuts, so its sides are read from the staged rows
    s = split if split is not None else sampling.stratified_split(_labelled(spark, sf_dir, cleaned_df, labelled), LABEL, test_size, seed)
    held = []
    train = s.where(F.col("IS_TEST") == 0).drop("IS_TEST")
    test = s.where(F.col("IS_TEST") == 1).drop("IS_TEST")
    fitted = feats.fit_features(train, one_hot=one_hot)
    tr = fitted.transform(train)
    te = (feats.fit_features(test, one_hot=one_hot) if refit else fitted).transform(test)
    if keep is not None:
        tr, te = feats.whitelist(tr, keep), feats.whitelist(te, keep)
        cols = list(keep)
    else:
        cols = [c for c in tr.columns if c not in (ID, LABEL)]
        te = te.select(*[c for c in tr.columns if c in te.columns])
    if persist:
        tr = tr.persist(StorageLevel.MEMORY_AND_DISK)
        te = te.persist(StorageLevel.MEMORY_AND_DISK)
        held += [tr, te]
    return SplitFeatures(tr, te, fitted, cols, held)


def nb_report(train: DataFrame, test: DataFrame, features, smoothing: float = bayes.DEFAULT_SMOOTHING,
              threshold: float = 0.5):
    """M7: fit, then train metrics by argmax and test metrics by threshold (tidy rows)."""
    model = bayes.fit_gaussian_nb(train, features, LABEL, smoothing)
    tr = model.transform(train)
    te = model.transform(test).withColumn("PREDICTION", (F.col("PROBA") >= threshold).cast("int"))
    rows = []
    for name, df in (("train", tr), ("test", te)):
        rates = metrics.classification_metrics(df, LABEL, "PREDICTION")
        auc = metrics.roc_auc(df, LABEL, "PROBA")
        rows.append(metrics.tidy_metrics(rates, auc, name))
    return model, rows[0].unionByName(rows[1])
