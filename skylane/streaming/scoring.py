"""Batch scoring (M18) applied to files arriving over time.

The original only scores whole files; this is the same operator on a Structured
Streaming source. Scoring is stateless per row (literal model parameters, a
stream-static lookup for frequencies), so no watermark or state store is needed
and every micro-batch is scored exactly like a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import bayes
from ..plans import features as feats
from ..plans.scoring import align_schema


def read_cleaned_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 64) -> DataFrame:
    """Cleaned flight rows (Parquet files) as an unbounded table."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def score_stream(stream: DataFrame, model: bayes.GaussianNB, fitted: feats.FittedFeatures) -> DataFrame:
    """Stored feature fit + stored model on each arriving row (keeps ROW_ID)."""
    x = fitted.transform(stream)
    return model.transform(align_schema(x, model.features)).select(feats.ID_COL, "PROBA", "PREDICTION")


def start_scoring(scored: DataFrame, sink_path: str, checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Append scored rows to Parquet; the checkpoint folder makes restarts exactly-once."""
    w = scored.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
