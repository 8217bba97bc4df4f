"""Sources and sinks (S2, S4-S6, S11; CSV is in ``csv_tables``) and the flight-shaped views over the test tables.

The test tables are TPC-H-like; ``flights_view`` and ``airports_view`` derive the
flight fact table and the airport dimension from them with plain joins, so every
downstream operator reads data that grows with the scale factor.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import MAX_BROADCAST_BYTES, row_count_at_most, row_width, small_broadcast
from ..session import ensure_checkpoint_dir

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    """Table name -> parquet path under a scale-factor directory."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, raw: bool = False) -> DataFrame:
    """A table with NaN as NULL. ``raw`` leaves the columns as stored, so that
    filters on floating columns reach Parquet; every operator here treats NaN as missing too."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df if raw else nan_to_null(df)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A written table read back, NaN as NULL."""
    return nan_to_null(spark.read.parquet(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas has one 'missing'; Spark has NULL and NaN. Fold NaN into NULL on load."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Distributed write, one file per task; never funnels through one task."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, for rows that several passes read.

    The passes then read the columns they need from the files and none repeats the joins. The
    files go when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skylane/staged-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written to a folder of their own under the shared one and read back, until ``clear`` deletes that folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.n = spark, 0
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/skylane/scratch-{uuid.uuid4().hex[:12]}"
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{self.n}"
        self.n += 1
        df.write.option("compression", "zstd").parquet(path)
        self._fs.deleteOnExit(self._folder)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        self._fs.delete(self._folder, True)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Every raw table plus ``flights`` and ``airports`` as temp views."""
    for t in TABLES:
        read_table(spark, sf_dir, t).createOrReplaceTempView(t)
    flights_view(spark, sf_dir).createOrReplaceTempView("flights")
    airports_view(spark, sf_dir).createOrReplaceTempView("airports")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, two narrow columns each."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment", "c_nationkey")


def flight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's customer and their supplier: the joins under ``flights_view``.

    Orders meet their customers first, and suppliers are broadcast once their number is proved to
    fit, so the lines are shuffled once.
    """
    # of the time of shipping only the day is used, which is narrower in a shuffle
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.col("l_shipdate").cast("date").alias("l_shipdate"))
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    bought = _bought(spark, sf_dir)
    j = li.join(bought, li.l_orderkey == bought.o_orderkey).join(small_broadcast(s), li.l_suppkey == s.s_suppkey)
    return j.drop("o_orderkey", "s_suppkey")


def flight_targets(spark: SparkSession, sf_dir: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """CANCELLED, DIVERTED and ARRIVAL_DELAY of every row of ``flights_view``, for statistics of the target.

    The joins add no column to them, so a line needs only the number of partners its order has. The orders
    of the lines are shuffled once each, and those without exactly one partner are written; while they fit
    ``max_broadcast_bytes`` they go to the lines, which stay where they are. Beyond that lines are shuffled
    with the order key and these columns alone.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", *_target_columns()).where("l_orderkey IS NOT NULL")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    li = li.join(small_broadcast(s), li.l_suppkey == s.s_suppkey).drop("l_suppkey", "s_suppkey")
    partners = _bought(spark, sf_dir).groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("_n"))
    odd = read_table(spark, sf_dir, "lineitem").select("l_orderkey").where("l_orderkey IS NOT NULL").distinct().join(partners, "l_orderkey", "left")
    ensure_checkpoint_dir(spark)
    odd = odd.withColumn("_n", F.coalesce("_n", F.lit(0))).where("_n <> 1").checkpoint()
    if row_count_at_most(odd, 0):
        return li.select("CANCELLED", "DIVERTED", "ARRIVAL_DELAY")
    if row_count_at_most(odd, max_broadcast_bytes // row_width(odd)):
        odd = F.broadcast(odd)
    j = li.join(odd, "l_orderkey", "left")
    # a row for each partner, none without one
    times = F.explode(F.array_repeat(F.lit(0), F.coalesce("_n", F.lit(1)).cast("int")))
    return j.select("CANCELLED", "DIVERTED", "ARRIVAL_DELAY", times.alias("_k")).drop("_k")


def flights_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight-shaped fact table (one row per lineitem), defined in FIXTURES.md B1."""
    return as_flights(flight_rows(spark, sf_dir))


def _departure_delay() -> Column:
    return ((F.col("l_orderkey") * 7 + F.col("l_partkey") * 3) % 60 - 20).cast("double")


def _target_columns() -> tuple[Column, Column, Column]:
    """CANCELLED, DIVERTED and ARRIVAL_DELAY of a line."""
    ln, qty = F.col("l_linenumber"), F.col("l_quantity")
    arrival = F.when((qty <= 2) | ((ln == 7) & (qty == 50)), F.lit(None).cast("double")).otherwise(
        _departure_delay() + ln * 2 - F.col("l_discount") * 100 - 10)
    return (F.when(qty == 1, 1).otherwise(0).alias("CANCELLED"), F.when(qty == 2, 1).otherwise(0).alias("DIVERTED"),
            arrival.alias("ARRIVAL_DELAY"))


def as_flights(j: DataFrame) -> DataFrame:
    """The columns of ``flights_view`` from the rows of ``flight_rows``."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    qty, price, tax = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax")
    ship = F.col("l_shipdate")
    cancelled, diverted, arrival_delay = _target_columns()
    sparse = F.when(tax == 0.08, tax * 100)
    return j.select(
        F.md5(
            F.concat_ws("|", _s(ok), _s(pk), _s(sk), _s(ln), _s(qty), _s(F.round(price * 100).cast("bigint")))
        ).alias("ROW_ID"),
        F.year(ship).alias("YEAR"),
        F.month(ship).alias("MONTH"),
        F.dayofmonth(ship).alias("DAY"),
        (F.weekday(ship) + 1).alias("DAY_OF_WEEK"),
        F.col("c_mktsegment").alias("AIRLINE"),
        pk.alias("FLIGHT_NUMBER"),
        F.concat(F.lit("T"), _s(sk)).alias("TAIL_NUMBER"),
        F.concat(F.lit("N"), _s("s_nationkey")).alias("ORIGIN_AIRPORT"),
        F.concat(F.lit("N"), _s("c_nationkey")).alias("DESTINATION_AIRPORT"),
        ((ok % 24) * 100 + (pk % 60)).alias("SCHEDULED_DEPARTURE"),
        (((ok + ln) % 24) * 100 + (sk % 60)).alias("SCHEDULED_ARRIVAL"),
        (30 + qty * 8).alias("SCHEDULED_TIME"),
        (price / 40).alias("DISTANCE"),
        _departure_delay().alias("DEPARTURE_DELAY"),
        (5 + ln * 3).cast("double").alias("TAXI_OUT"),
        ((ok % 24) * 100 + (sk % 60)).cast("double").alias("WHEELS_OFF"),
        arrival_delay,
        cancelled,
        diverted,
        F.when(qty == 1, F.lit("A")).alias("CANCELLATION_REASON"),
        sparse.alias("AIR_SYSTEM_DELAY"),
        sparse.alias("SECURITY_DELAY"),
        sparse.alias("AIRLINE_DELAY"),
        sparse.alias("LATE_AIRCRAFT_DELAY"),
        sparse.alias("WEATHER_DELAY"),
        (ok % 2400).cast("double").alias("DEPARTURE_TIME"),
        (pk % 2400).cast("double").alias("ARRIVAL_TIME"),
        (sk % 2400).cast("double").alias("WHEELS_ON"),
        (qty * 7).alias("AIR_TIME"),
        (qty * 8).alias("ELAPSED_TIME"),
        ln.cast("double").alias("TAXI_IN"),
    )


def airports_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension (FIXTURES.md B2): N24 missing, N23 with unknown coordinates."""
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.where(k != 24).select(
        F.concat(F.lit("N"), _s(k)).alias("IATA_CODE"),
        F.col("n_name").alias("AIRPORT"),
        F.when(k == 23, F.lit(None).cast("double")).otherwise(20 + k * F.lit(1.25)).alias("LATITUDE"),
        F.when(k == 23, F.lit(None).cast("double")).otherwise(-150 + k * F.lit(3.5)).alias("LONGITUDE"),
    )
