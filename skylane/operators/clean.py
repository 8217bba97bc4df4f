"""Cleaning operators: column drops (P1-P4), row filters (F1-F6), lookups.

Statistics that a filter needs (bounds, mean, std) are computed by one distributed
aggregate and applied as literals, so the filter itself stays a pushed-down predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.features import day_of_year as _doy
from .joins import lookup_join, unique_key_count
from .stats import exact_quantiles

# Column lists of the flights schema.
SPARSE_COLUMNS = [
    "CANCELLATION_REASON",
    "AIR_SYSTEM_DELAY",
    "SECURITY_DELAY",
    "AIRLINE_DELAY",
    "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
]
LEAKAGE_COLUMNS = ["DEPARTURE_TIME", "ARRIVAL_TIME", "WHEELS_ON", "AIR_TIME", "ELAPSED_TIME", "TAXI_IN"]
USELESS_COLUMNS = ["TAIL_NUMBER"]
DATE_COLUMNS = ["YEAR", "MONTH", "DAY"]


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop named columns; missing names are an error unless ``strict=False``."""
    if strict:
        have = {c.upper() for c in df.columns}
        missing = [c for c in cols if c.upper() not in have]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_sparse_columns(df: DataFrame, cols: Sequence[str] = SPARSE_COLUMNS) -> DataFrame:
    """The fixed list of mostly-empty columns."""
    return drop_columns(df, cols)


def sparse_columns(df: DataFrame, threshold: float = 0.8) -> list[str]:
    """P1 (computed form): columns whose NULL share exceeds ``threshold``.

    One aggregate over the table; only one number per column reaches the driver.
    """
    row = df.select(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_leakage_columns(df: DataFrame, cols: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    """P2."""
    return drop_columns(df, cols)


def drop_useless_columns(df: DataFrame, cols: Sequence[str] = USELESS_COLUMNS) -> DataFrame:
    """P3."""
    return drop_columns(df, cols)


def completed_flights(df: DataFrame) -> DataFrame:
    """keep rows neither cancelled nor diverted, then drop both flags."""
    return df.where((F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0)).drop("CANCELLED", "DIVERTED")


def add_day_of_year(df: DataFrame, lenient: bool = False) -> DataFrame:
    """YEAR, MONTH, DAY -> DAY_OF_YEAR; the three sources are dropped."""
    return df.withColumn("DAY_OF_YEAR", _doy("YEAR", "MONTH", "DAY", lenient=lenient)).drop(*DATE_COLUMNS)


def missing_as_null(df: DataFrame, col: str) -> Column:
    """``col`` with NaN as NULL, for statistics over columns read as stored."""
    t = dict(df.dtypes)[col]
    return F.nanvl(F.col(col), F.lit(None).cast(t)) if t in ("double", "float") else F.col(col)


def quantile_bounds(df: DataFrame, col: str, lower: float = 0.0, upper: float = 1.0) -> tuple:
    """A2: exact, linearly interpolated quantiles of ``col`` (NULL and NaN skipped)."""
    return tuple(exact_quantiles(df.select(missing_as_null(df, col).alias(col)), col, [lower, upper]))


def quantile_filter(df: DataFrame, col: str, lower: float = 0.0, upper: float = 1.0) -> DataFrame:
    """keep ``lower_q <= col <= upper_q``; rows with NULL ``col`` go too.

    With the defaults (0, 1) the bounds are min and max, so only NULLs are removed.
    """
    lo, hi = quantile_bounds(df, col, lower, upper)
    if lo is None:
        return df.where(F.lit(False))
    return df.where((F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi)))


def mean_std(df: DataFrame, col: str, sample: bool = True) -> tuple:
    """A1: mean and standard deviation (sample by default: n-1; NULL on one row)."""
    x = missing_as_null(df, col)
    sd = F.stddev_samp(x) if sample else F.stddev_pop(x)
    row = df.select(F.avg(x).alias("m"), sd.alias("s")).first()
    return row["m"], row["s"]


def sigma_filter(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """keep ``mean - k*std <= col <= mean + k*std`` (sample std, inclusive)."""
    m, s = mean_std(df, col, sample=True)
    if m is None or s is None:
        return df.where(F.lit(False))
    return df.where((F.col(col) >= F.lit(m - k * s)) & (F.col(col) <= F.lit(m + k * s)))


def zscore_filter(df: DataFrame, col: str, threshold: float = 3.0, nulls: str = "skip") -> DataFrame:
    """keep ``|col - mean| / std_pop < threshold`` (strict).

    ``nulls="propagate"`` mirrors a z-score over a column with a missing value: every
    score is missing and no row is kept. ``nulls="skip"`` drops only the NULL rows.
    A constant column (std 0) keeps no rows.
    """
    x = missing_as_null(df, col)
    row = df.select(F.avg(x).alias("m"), F.stddev_pop(x).alias("s"), F.count_if(x.isNull()).alias("n_null")).first()
    m, s = row["m"], row["s"]
    if m is None or s is None or s == 0 or (nulls == "propagate" and row["n_null"] > 0):
        return df.where(F.lit(False))
    return df.where(F.abs((F.col(col) - F.lit(m)) / F.lit(s)) < F.lit(threshold))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """drop rows with a NULL in ``subset`` (all columns by default)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def rows_dropped(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows before/after a drop-nulls step, as a one-row DataFrame."""
    cols = list(subset) if subset else df.columns
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    return df.select(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_after"),
        F.count_if(~keep).alias("rows_dropped"),
    )


def airport_coordinates(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """origin/destination code -> latitude/longitude via two left lookups.

    Unmatched codes give NULL coordinates; the code columns are dropped. The
    dimension must have unique keys (checked once, with its size, in one aggregate).
    """
    dim = airports.select("IATA_CODE", "LATITUDE", "LONGITUDE")
    size = unique_key_count(dim, ["IATA_CODE"])
    out = flights
    for role in ("ORIGIN", "DESTINATION"):
        d = dim.select(
            F.col("IATA_CODE").alias(f"{role}_AIRPORT"),
            F.col("LATITUDE").alias(f"{role}_AIRPORT_LATITUDE"),
            F.col("LONGITUDE").alias(f"{role}_AIRPORT_LONGITUDE"),
        )
        out = lookup_join(out, d, [f"{role}_AIRPORT"], known_rows=size)
    return out.drop("ORIGIN_AIRPORT", "DESTINATION_AIRPORT")


class StepCounts:
    """Rows after each named step, counted by the first action that runs it and not by a job of its own."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        """``df`` with its rows counted under ``step``; filters that follow stay above the count."""
        self.seen[step] = Observation()
        return df.observe(self.seen[step], F.count(F.lit(1)).alias("n"))

    def rows(self) -> list[tuple[str, int]]:
        """(step, rows) in order; waits for the action."""
        return [(step, o.get["n"]) for step, o in self.seen.items()]


def clean_flights(flights: DataFrame, airports: DataFrame, lower: float = 0.0, upper: float = 1.0,
                  sigmas: float = 1.0, counts: StepCounts | None = None, targets: DataFrame | None = None) -> DataFrame:
    """P1 -> P2 -> F1 -> X8 -> F2 -> P3 -> F3 -> J1 -> F6.

    The airport lookups are left joins on unique keys and change no row, so the
    target's statistics come from its narrow projection before them, and the
    target filter sits below both lookups, where it can reach the scan. Nothing is cached.

    With ``counts`` the rows loaded, completed, in range and complete are counted on the way,
    the first two by the statistics' pass; without it no count holds up a filter.

    ``targets`` has CANCELLED, DIVERTED and ARRIVAL_DELAY of the same rows, if there is a cheaper way to
    them than through ``flights``: under the default bounds the statistics are taken from it.
    """
    watch = counts.watch if counts else lambda df, step: df
    df = watch(drop_sparse_columns(flights), "loaded")
    df = drop_leakage_columns(df)
    df = watch(completed_flights(df), "completed")
    df = add_day_of_year(df)
    target = F.col("ARRIVAL_DELAY")
    if lower <= 0.0 and upper >= 1.0:
        # Default bounds are min/max: F2 only removes NULL targets, so the F3
        # statistics over the kept rows come from the same single aggregate.
        own = df if targets is None else completed_flights(targets)
        x = missing_as_null(own, "ARRIVAL_DELAY")
        row = own.select(F.min(x).alias("lo"), F.max(x).alias("hi"), F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).first()
        df = drop_useless_columns(df)
        if row["m"] is None or row["s"] is None:
            df = df.where(F.lit(False))
        else:
            lo = max(row["lo"], row["m"] - sigmas * row["s"])
            hi = min(row["hi"], row["m"] + sigmas * row["s"])
            df = df.where((target >= F.lit(lo)) & (target <= F.lit(hi)))
    else:
        df = quantile_filter(df, "ARRIVAL_DELAY", lower, upper)
        df = drop_useless_columns(df)
        df = sigma_filter(df, "ARRIVAL_DELAY", sigmas)
    df = watch(df, "in_range")
    return watch(drop_null_rows(airport_coordinates(df, airports)), "complete")
