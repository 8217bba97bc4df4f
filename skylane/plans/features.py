"""Feature pipeline M16 with separate fit and apply halves.

The chain (in order): cyclic day of week (7) and day of year (365), HHMM ->
minutes + cyclic (1440) for scheduled departure and arrival (sources kept),
weekend flag, season, standardised DISTANCE and SCHEDULED_TIME, time periods
(computed from the raw HHMM value, as in the original pipeline), distance bins,
one-hot of five categorical columns, frequency of FLIGHT_NUMBER, upper-case
names, drop of the helper columns, drop of rows with any NULL, booleans -> ints.

``refit=False`` (default) fits scalers, categories and frequencies on the
training rows and applies them elsewhere. ``refit=True`` refits on every input,
which reproduces the original behaviour exactly.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions import features as fx
from ..operators import clean, encode

# Columns removed after encoding.
COLUMNS_DROP = [
    "DAY_OF_WEEK",
    "DAY_OF_YEAR",
    "SCHEDULED_DEPARTURE_MINUTES",
    "SCHEDULED_ARRIVAL_MINUTES",
    "SCHEDULED_DEPARTURE",
    "SCHEDULED_ARRIVAL",
    "FLIGHT_NUMBER",
    "DISTANCE",
    "SCHEDULED_TIME",
]
# Columns to one-hot encode, to standardise and to frequency-encode.
ONE_HOT_COLUMNS = ["AIRLINE", "SEASON", "DISTANCE_CATEGORY", "SCHEDULED_DEPARTURE_PERIOD", "SCHEDULED_ARRIVAL_PERIOD"]
SCALED_COLUMNS = ["DISTANCE", "SCHEDULED_TIME"]
FREQUENCY_COLUMN = "FLIGHT_NUMBER"
# The 15-feature whitelist of the trained model, in stored order.
KEEP_FEATURES = [
    "DEPARTURE_DELAY",
    "TAXI_OUT",
    "WHEELS_OFF",
    "ORIGIN_AIRPORT_LATITUDE",
    "ORIGIN_AIRPORT_LONGITUDE",
    "DESTINATION_AIRPORT_LATITUDE",
    "DESTINATION_AIRPORT_LONGITUDE",
    "DAY_OF_YEAR_SIN",
    "DAY_OF_YEAR_COS",
    "SCHEDULED_DEPARTURE_SIN",
    "SCHEDULED_ARRIVAL_SIN",
    "SCHEDULED_ARRIVAL_COS",
    "DISTANCE_NORMALIZED",
    "SCHEDULED_TIME_NORMALIZED",
    "FLIGHT_NUMBER_FREQ",
]
ID_COL = "ROW_ID"
LABEL_COL = "ARRIVAL_DELAY"


def scalar_features(df: DataFrame, period_from: str = "hhmm") -> DataFrame:
    """Row-local part of M16 (no fitted state): X1-X7.

    ``period_from="minutes"`` derives the periods from minutes after midnight
    instead of the raw HHMM value.
    """
    dow_s, dow_c = fx.cyclic("DAY_OF_WEEK", 7)
    doy_s, doy_c = fx.cyclic("DAY_OF_YEAR", 365)
    out = df.withColumns({
        "DAY_OF_WEEK_SIN": dow_s, "DAY_OF_WEEK_COS": dow_c,
        "DAY_OF_YEAR_SIN": doy_s, "DAY_OF_YEAR_COS": doy_c,
        "SCHEDULED_DEPARTURE_MINUTES": fx.hhmm_to_minutes("SCHEDULED_DEPARTURE"),
        "SCHEDULED_ARRIVAL_MINUTES": fx.hhmm_to_minutes("SCHEDULED_ARRIVAL"),
    })
    new = {}
    for c in ("SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL"):
        s, co = fx.cyclic(f"{c}_MINUTES", 1440)
        new[f"{c}_SIN"], new[f"{c}_COS"] = s, co
    suffix = "" if period_from == "hhmm" else "_MINUTES"
    new.update({
        "IS_WEEKEND": fx.weekend("DAY_OF_WEEK"),
        "SEASON": fx.season("DAY_OF_YEAR"),
        "SCHEDULED_DEPARTURE_PERIOD": fx.time_period(f"SCHEDULED_DEPARTURE{suffix}"),
        "SCHEDULED_ARRIVAL_PERIOD": fx.time_period(f"SCHEDULED_ARRIVAL{suffix}"),
        "DISTANCE_CATEGORY": fx.distance_bins("DISTANCE"),
    })
    return out.withColumns(new)


@dataclass
class FittedFeatures:
    scalers: encode.ScalerParams
    categories: dict
    frequency: DataFrame
    one_hot: bool = True
    period_from: str = "hhmm"

    def transform(self, df: DataFrame) -> DataFrame:
        # looked up before anything is computed, so that a shuffle carries the source columns alone
        out = encode.apply_frequency(df, self.frequency, FREQUENCY_COLUMN)
        out = scalar_features(out, self.period_from)
        out = encode.apply_scalers(out, self.scalers)
        if self.one_hot:
            out = encode.apply_one_hot(out, self.categories)
        else:
            out = out.drop(*ONE_HOT_COLUMNS)
        share = f"{FREQUENCY_COLUMN}_FREQ"
        out = out.select(*[c for c in out.columns if c != share], share)
        out = encode.uppercase_columns(out)
        out = clean.drop_columns(out, COLUMNS_DROP)
        # apart, so that the first filter and the columns it alone reads stay below the lookup
        out = clean.drop_null_rows(out, [c for c in out.columns if c != share])
        out = clean.drop_null_rows(out, [share])
        return encode.bools_to_ints(out)


    # ---- persistence (S10) --------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        """The frequency table as Parquet (it grows with its key), the rest as one JSON row."""
        self.frequency.write.mode("overwrite").parquet(f"{path}/frequency")
        rest = {"method": self.scalers.method, "params": self.scalers.params, "categories": self.categories,
                "one_hot": self.one_hot, "period_from": self.period_from}
        spark.createDataFrame([(json.dumps(rest),)], "fit string").write.mode("overwrite").json(f"{path}/fit")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedFeatures:
        rest = json.loads(spark.read.schema("fit string").json(f"{path}/fit").first()["fit"])
        scalers = encode.ScalerParams(rest["method"], {c: tuple(p) for c, p in rest["params"].items()})
        return cls(scalers, rest["categories"], spark.read.parquet(f"{path}/frequency"), rest["one_hot"], rest["period_from"])


def fit_features(train: DataFrame, one_hot: bool = True, period_from: str = "hhmm",
                 max_categories: int = encode.NAMED_CATEGORIES) -> FittedFeatures:
    base = scalar_features(train, period_from)
    scalers = encode.fit_scalers(base, SCALED_COLUMNS, "standard")
    cats = encode.fit_categories(base, ONE_HOT_COLUMNS, max_categories) if one_hot else {}
    freq = encode.fit_frequency(base, FREQUENCY_COLUMN)
    return FittedFeatures(scalers, cats, freq, one_hot, period_from)


def build_features(df: DataFrame, fitted: FittedFeatures | None = None, refit: bool = False,
                   one_hot: bool = True) -> DataFrame:
    """Apply a fitted pipeline, or fit on ``df`` when none is given / ``refit``."""
    if fitted is None or refit:
        fitted = fit_features(df, one_hot=one_hot)
    return fitted.transform(df)


def whitelist(df: DataFrame, features=KEEP_FEATURES, keep=(ID_COL, LABEL_COL)) -> DataFrame:
    """Keep the model features (plus id and label) in the given order."""
    extra = [c for c in keep if c in df.columns]
    return df.select(*extra, *features)


def label_target(df: DataFrame, col: str = LABEL_COL, threshold: float = fx.DELAY_THRESHOLD) -> DataFrame:
    """P11 in place: the delay in minutes becomes the 0/1 class."""
    return df.withColumn(col, fx.binarise(col, threshold))


def features_and_label(df: DataFrame, label: str = LABEL_COL):
    """Feature names and label name; the label stays in the row."""
    return [c for c in df.columns if c not in (label, ID_COL)], label


__all__ = [
    "COLUMNS_DROP", "KEEP_FEATURES", "FittedFeatures", "build_features", "fit_features",
    "label_target", "scalar_features", "whitelist",
]
