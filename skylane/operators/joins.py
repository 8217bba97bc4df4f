"""Lookup joins (J1, J2) that stay safe when a key is hot or a side is large.

A dimension is broadcast only after a bounded ``limit(n + 1).count()`` proves that
it has at most as many rows as fit ``max_broadcast_bytes`` at its schema's row width.
Otherwise the join is salted: each fact row takes one of ``salts`` sub-keys from a
hash of its own columns and the dimension is replicated once per salt, so a key
holding a third of the fact rows is spread over ``salts`` tasks. Where the frequent
keys are known, ``hot_lookup`` broadcasts those alone and copies no dimension row. All paths are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 << 20
# Places that rows which need no partner spread over.
SPREAD = 1024
_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


def row_width(df: DataFrame) -> int:
    """Bytes of a row in a hash table: 16 of overhead, 8 a number at most, 64 for a string or any other type."""
    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.DecimalType)
    return 16 + sum(64 if isinstance(f.dataType, wide) else _WIDTH.get(type(f.dataType), 8) for f in df.schema.fields)


def row_count_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most ``n`` rows; scans at most ``n + 1`` rows."""
    return df.limit(n + 1).count() <= n


def unique_key_count(dim: DataFrame, keys: Sequence[str]) -> int:
    """Rows of ``dim``; an error when a key occurs twice. One aggregate answers both."""
    row = dim.groupBy(*keys).count().agg(F.count(F.lit(1)).alias("n"), F.max("count").alias("most")).first()
    if row["most"] and row["most"] > 1:
        dup = dim.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
        raise ValueError(f"lookup keys {list(keys)} are not unique, e.g. {dup[0].asDict()}")
    return row["n"]


def lookup_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left",
                unique_keys: bool = False, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                salts: int = 32, known_rows: int | None = None) -> DataFrame:
    """Equi-join ``fact`` to a lookup table on ``keys`` (same names on both sides).

    ``known_rows`` is the dimension's size if the caller has counted it already.
    """
    keys = list(keys)
    if unique_keys:
        known_rows = unique_key_count(dim, keys)
    most = max_broadcast_bytes // row_width(dim)
    if known_rows <= most if known_rows is not None else row_count_at_most(dim, most):
        return fact.join(F.broadcast(dim), keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts))
    f = fact.withColumn("_salt", salt)
    d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return f.join(d, [*keys, "_salt"], how).drop("_salt")


def small_broadcast(dim: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``dim`` marked for a broadcast if its rows are proved to fit the bound, else as it is."""
    return F.broadcast(dim) if row_count_at_most(dim, max_broadcast_bytes // row_width(dim)) else dim


def hot_lookup(fact: DataFrame, dim: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Left lookup on one key whose frequent values are known: ``hot``, a bounded part of ``dim``, is broadcast.

    The other rows meet ``dim`` by a plain shuffle join. Rows with a hot or NULL key need no
    partner there and spread over all tasks by a hash of their columns. Columns come as ``lookup_join`` has them.
    """
    values = [c for c in dim.columns if c != key]
    known = hot.select(F.col(key), F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    f = fact.join(F.broadcast(known), key, "left")
    aside = F.col("_hot").isNotNull() | F.col(key).isNull()
    hashed = [F.col(x.name) for x in fact.schema.fields if "map<" not in x.dataType.simpleString()]
    # equal keys have equal salts; a constant would be folded out of the join and gather the rows set aside in one task
    salt = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(SPREAD)).cast("int")
    f = f.withColumns({"_cold": F.when(~aside, F.col(key)),
                       "_salt": F.when(aside, salt(*hashed)).otherwise(salt(F.col(key).try_cast(dim.schema[key].dataType)))})
    d = dim.select(F.col(key).alias("_cold"), salt(F.col(key)).alias("_salt"), *[F.col(c).alias(f"_cold_{c}") for c in values])
    found = [F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in values]
    return f.join(d, ["_cold", "_salt"], "left").select(key, *[c for c in fact.columns if c.lower() != key.lower()], *found)
