"""Spark session defaults shared by tests, the bench and the entry module."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "skylane", cpus: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks.

    On a cluster the session comes from the launcher; only ``ensure_checkpoint_dir``
    is needed there.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SKYLANE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; an error where a cluster has not set it.

    Only a local session, where driver and executors are one process, gets a folder of its own.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="skylane-ckpt-")
    sc.setCheckpointDir(path)
    return path


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Spark's default, the JVM's limit of a method, and what HotSpot compiles (its HugeMethodLimit).
ANY_METHOD, COMPILED_METHOD = "65535", "8000"


def compiled_methods(spark: SparkSession) -> None:
    """Keep generated code small enough for HotSpot, which leaves methods over 8,000 bytes to its interpreter.

    A stage beyond that is run operator by operator, each in small methods. A limit that the session
    has set itself stays.
    """
    if spark.conf.get(METHOD_LIMIT) == ANY_METHOD:
        spark.conf.set(METHOD_LIMIT, COMPILED_METHOD)
