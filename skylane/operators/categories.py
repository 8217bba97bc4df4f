"""Categories of any number (X11, A7): an index table instead of a driver list, sparse vectors instead of columns.

``encode.apply_one_hot`` makes one named column per value, which suits a few thousand at
most. Here the distinct values are range-partitioned in their order, each range numbers its own
values, and the ranges' sizes (a few numbers per range) give the offsets, so no value reaches
the driver and no task holds more than its range. The index is a table. Rows find their number by a
broadcast if it is small enough; otherwise only the categories of over a thousandth of the rows, a thousand
at most, are broadcast and the others, none of them hot, meet their rows by a shuffle. MLlib's encoder
turns the number into a sparse vector.

Defined results: numbers follow the order of the values as text, NULL is a category of its own
and comes last, as in ``fit_categories``; a value that was not fitted gives a vector of zeros; a
column without any row has vectors of size 1 that hold nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import MAX_BROADCAST_BYTES, lookup_join, row_width

# A category of more than 1 / HOT of the rows is broadcast, so that no shuffle meets it.
HOT = 1000


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A7 as a table (column, category, rows, index): the sorted distinct values of each column, numbered from 0,
    and how many rows have them."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols
    ])).alias("p")).select("p.*").groupBy("column", "category").agg(F.count(F.lit(1)).alias("rows"))
    order = [F.col("column"), F.col("category").asc_nulls_last()]
    # written once, so that a range keeps its number when a task runs again
    ranged = pairs.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("column", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.row_number().over(Window.partitionBy("column", "_range").orderBy(F.col("category").asc_nulls_last()))
    # a row for each range and column: as many as there are shuffle partitions, and one more a column
    numbered = ranged.withColumn("_at", within).join(F.broadcast(offsets), ["column", "_range"])
    return numbered.select("column", "category", "rows", (F.col("_off") + F.col("_at") - 1).alias("index"))


def _key(c: Column) -> Column:
    """A join key without NULL: values and the NULL category keep apart."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


@dataclass
class CategoryVectors:
    """A fitted sparse one-hot encoding: the index table, the number of categories per column and the rows fitted on."""

    index: DataFrame
    sizes: dict
    rows: int

    def transform(self, df: DataFrame, suffix: str = "_VEC", drop_source: bool = True) -> DataFrame:
        """X11: ``df`` with one sparse vector per encoded column."""
        out = df
        for c, n in self.sizes.items():
            out = self._numbered(out.withColumn("_key", _key(F.col(c))), c, n).drop("_key")
            # the place after the last category is the one MLlib leaves out: a vector of zeros
            out = out.withColumn(f"_ix_{c}", F.coalesce(f"_ix_{c}", F.lit(max(n, 1))).cast("double"))
        places = [f"_ix_{c}" for c in self.sizes]
        widest = df.sparkSession.createDataFrame([tuple(float(max(n, 1)) for n in self.sizes.values())], ", ".join(f"`{p}` double" for p in places))
        encoder = OneHotEncoder(inputCols=places, outputCols=[f"{c}{suffix}" for c in self.sizes], dropLast=True).fit(widest)
        out = encoder.transform(out).drop(*places)
        return out.drop(*self.sizes) if drop_source else out

    def _numbered(self, df: DataFrame, col: str, n: int) -> DataFrame:
        """``df`` with the number of its ``_key``."""
        ix = f"_ix_{col}"
        own = self.index.where(F.col("column") == col)
        dim = own.select(_key(F.col("category")).alias("_key"), F.col("index").alias(ix))
        if n <= MAX_BROADCAST_BYTES // row_width(dim):
            return lookup_join(df, dim, ["_key"], how="left", known_rows=n)
        hot = own.where(F.col("rows") * HOT > self.rows).select(_key(F.col("category")).alias("_key"), F.col("index").alias("_hot"))
        out = df.join(F.broadcast(hot), "_key", "left")
        # rows that have their number go anywhere: keys of values start with "=" or are empty
        hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        aside = F.concat(F.lit("!"), F.xxhash64(*hashed).cast("string"))
        out = out.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("_key")).otherwise(aside)).join(dim, "_key", "left")
        return out.withColumn(ix, F.coalesce("_hot", ix)).drop("_hot")

    def save(self, path: str) -> None:
        """The index as Parquet, one folder a column; the sizes follow from it."""
        self.index.write.mode("overwrite").partitionBy("column").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, cols: Sequence[str]) -> CategoryVectors:
        # a column without rows has no folder, and a table without any has no schema
        index = spark.read.schema("category string, rows long, index long, column string").parquet(path)
        return cls(index.select("column", "category", "rows", "index"), *category_sizes(index, cols))


def category_sizes(index: DataFrame, cols: Sequence[str]) -> tuple[dict, int]:
    """({column: number of categories}, rows fitted on); two numbers a column reach the driver."""
    got = index.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).collect()
    found = {r["column"]: r["n"] for r in got}
    return {c: found.get(c, 0) for c in cols}, max((r["rows"] for r in got), default=0)


def fit_category_vectors(df: DataFrame, cols: Sequence[str]) -> CategoryVectors:
    """X11 fit for any number of categories; the index is written once, at fit time."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Column '{missing[0]}' not found")
    index = category_index(df, cols).checkpoint()
    return CategoryVectors(index, *category_sizes(index, cols))
