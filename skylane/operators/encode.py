"""Fitted encoders (X9-X12, A3, A7, J2) and name/type operators.

Fitting is one distributed aggregate; only bounded parameters reach the driver
(two numbers per scaled column, the sorted category list of a one-hot column with
a hard cap). Frequency tables stay DataFrames because their size grows with the
number of distinct keys; they are attached by a broadcast while small, else by ``hot_lookup``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .joins import MAX_BROADCAST_BYTES, hot_lookup, lookup_join, row_count_at_most, row_width

# A key with more than this share of the rows is hot; no more than a thousand can be.
HOT_SHARE = 0.001
NULL_CATEGORY = "nan"


# ---------------------------------------------------------------- scaling ---

@dataclass
class ScalerParams:
    method: str  # "standard" or "minmax"
    params: dict = field(default_factory=dict)  # col -> (shift, scale)


def fit_scalers(df: DataFrame, cols: Sequence[str], method: str = "standard") -> ScalerParams:
    """X9/X10 fit: mean and population std, or min and range, for every column in one pass."""
    aggs = []
    for c in cols:
        if method == "standard":
            aggs += [F.avg(c).alias(f"{c}__a"), F.stddev_pop(c).alias(f"{c}__b")]
        else:
            aggs += [F.min(c).cast("double").alias(f"{c}__a"), (F.max(c) - F.min(c)).cast("double").alias(f"{c}__b")]
    row = df.select(*aggs).first()
    return ScalerParams(method, {c: (row[f"{c}__a"], row[f"{c}__b"]) for c in cols})


def scaled(col: str, shift, scale):
    """(c - shift) / scale; a zero scale (constant column) gives 0; NULL stays NULL."""
    x = F.col(col)
    if shift is None:
        return F.lit(None).cast("double")
    if scale is None or scale == 0:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(shift)) / F.lit(scale)


def apply_scalers(df: DataFrame, sp: ScalerParams, suffix: str = "_NORMALIZED") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": scaled(c, a, b) for c, (a, b) in sp.params.items()})


def normalize_column(df: DataFrame, col: str, method: str = "standard") -> DataFrame:
    """X9 ("standard") / X10 (anything else: min-max), fitted on ``df`` itself."""
    return apply_scalers(df, fit_scalers(df, [col], "standard" if method == "standard" else "minmax"))


# ---------------------------------------------------------------- one-hot ---

# Values that may become columns of their own; a schema of more serves nobody (see ``categories``).
NAMED_CATEGORIES = 10_000


def fit_categories(df: DataFrame, cols: Sequence[str], max_categories: int = NAMED_CATEGORIES) -> dict[str, list]:
    """Sorted distinct values per column (NULL last, as its own category).

    All columns are scanned in one job over (column, value) pairs. Every value becomes
    a column, so the list is as long as the schema it makes. More than
    ``max_categories`` values are an error; ``categories.fit_category_vectors`` encodes any number.
    """
    cols = list(cols)
    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)])).alias("p")
    ).select("p.i", "p.v").distinct()
    rows = pairs.limit(max_categories * len(cols) + 1).collect()
    cats: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        cats[cols[r["i"]]].append(r["v"])
    for c, vals in cats.items():
        if len(vals) > max_categories:
            raise ValueError(f"{c}: more than {max_categories} categories; fit_category_vectors encodes them")
        vals.sort(key=lambda v: (v is None, v))
    return cats


def onehot_name(col: str, value) -> str:
    return f"{col}_{NULL_CATEGORY if value is None else value}"


def apply_one_hot(df: DataFrame, cats: dict[str, list], drop_source: bool = True) -> DataFrame:
    """X11: one 0.0/1.0 column per fitted category; unseen values give all zeros."""
    new = {}
    for c, vals in cats.items():
        x = F.col(c).cast("string")
        for v in vals:
            cond = x.isNull() if v is None else F.coalesce(x == F.lit(v), F.lit(False))
            new[onehot_name(c, v)] = cond.cast("double")
    out = df.withColumns(new)
    return out.drop(*cats) if drop_source else out


def one_hot_encode(df: DataFrame, col: str, max_categories: int = NAMED_CATEGORIES) -> DataFrame:
    """X11 fitted on ``df`` itself."""
    if col not in df.columns:
        raise ValueError(f"Column '{col}' not found")
    return apply_one_hot(df, fit_categories(df, [col], max_categories))


# -------------------------------------------------------------- frequency ---

def fit_frequency(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """A3: (value, share of non-NULL rows) table; partial aggregation absorbs hot keys.

    The counts are checkpointed once, at fit time: every later join reads the table
    instead of aggregating the training rows again.
    """
    out = out or f"{col}_FREQ"
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    total = counts.agg(F.sum("_n")).first()[0]
    return counts.select(col, (F.col("_n") / F.lit(float(total) if total else None)).alias(out))


def apply_frequency(df: DataFrame, table: DataFrame, col: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left lookup of the frequency; unseen or NULL keys give NULL.

    A table too large to broadcast is not copied: its shares tell the hot keys, and only those are broadcast.
    """
    most = max_broadcast_bytes // row_width(table)
    if row_count_at_most(table, most):
        return lookup_join(df, table, [col], how="left", known_rows=most, max_broadcast_bytes=max_broadcast_bytes)
    share = next(c for c in table.columns if c != col)
    return hot_lookup(df, table, col, table.where(F.col(share) > F.lit(HOT_SHARE)))


def frequency_encode(df: DataFrame, col: str) -> DataFrame:
    """X12 fitted on ``df`` itself."""
    return apply_frequency(df, fit_frequency(df, col), col)


# ------------------------------------------------------- names and types ---

def uppercase_columns(df: DataFrame) -> DataFrame:
    """P5: upper-case every column name; a collision is an error."""
    upper = [c.upper() for c in df.columns]
    if len(set(upper)) != len(upper):
        raise ValueError("upper-casing would merge columns")
    return df.toDF(*upper)


rename_columns_uppercase = uppercase_columns
set_all_columns_uppercase = uppercase_columns


def bools_to_ints(df: DataFrame, cols: Sequence[str] | str = "all") -> DataFrame:
    """Boolean columns (all by type, or the named ones) to 0/1 ints."""
    if cols == "all":
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUM_TYPES = (*_INT_TYPES, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)
# Integer ranges used by the narrowing rule (bounds are strict).
INT8 = (-128, 127)
INT16 = (-32768, 32767)
INT32 = (-2147483648, 2147483647)
FLOAT32_MAX = 3.4028234663852886e38


def narrow_types_plan(df: DataFrame) -> dict[str, str]:
    """P12 decision: per numeric column, the narrowest type its min/max fit strictly inside."""
    num = [f for f in df.schema.fields if isinstance(f.dataType, _NUM_TYPES)]
    if not num:
        return {}
    aggs = []
    for f in num:
        c = F.col(f.name).cast("double") if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
        aggs += [F.min(c).alias(f"{f.name}__lo"), F.max(c).alias(f"{f.name}__hi")]
    row = df.select(*aggs).first()
    plan = {}
    for f in num:
        lo, hi = row[f"{f.name}__lo"], row[f"{f.name}__hi"]
        if lo is None:
            continue
        if isinstance(f.dataType, _INT_TYPES):
            for (a, b), t in ((INT8, "tinyint"), (INT16, "smallint"), (INT32, "int")):
                if lo > a and hi < b:
                    plan[f.name] = t
                    break
        elif float(lo) > -FLOAT32_MAX and float(hi) < FLOAT32_MAX:
            plan[f.name] = "float"
    return plan


def narrow_types(df: DataFrame) -> DataFrame:
    """Apply ``narrow_types_plan`` (one aggregate of all mins and maxes)."""
    plan = narrow_types_plan(df)
    return df.withColumns({c: F.col(c).cast(t) for c, t in plan.items()})
