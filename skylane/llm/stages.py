"""Pipeline stages: (spark, docs, sf_dir) -> documents, each through one operator.

Defined results: rows with null or empty texts pass like others (they are clean,
copies of each other, and pack as an end token); repeated ids are separate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm.common import keyed, table
from skylane.llm.exact import exact_dedup
from skylane.llm.packing import pack_documents
from skylane.llm.simhash import simhash_dedup
from skylane.llm.substring import substring_dedup
from skylane.llm.toxicity import fit_toxicity, score_toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels of ``sf_dir``."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score_toxicity(docs, model, threshold=0.3).filter("predicted = 0").select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, white space aside."""
    kept = exact_dedup(docs).filter("kept")
    # rows repeated with their id are all marked; they are a few among the few that have copies
    return kept.filter("group_size = 1").unionByName(kept.filter("group_size > 1").dropDuplicates(["doc_id", "text_sha256"])).select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within 4 bits over 4-word shingles."""
    gone = simhash_dedup(docs.select("doc_id", "text"), shingle=4, distance=4).filter("not kept")
    gone = gone.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))).alias("__id"), F.col("text_hash").alias("__tx"))
    return keyed(docs).join(gone, ["__id", "__tx"], "left_anti").select(docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated 35-word windows; untouched texts stay as they were.

    A text that loses all its words stays as an empty one, so no row goes.
    """
    out = substring_dedup(docs, window=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of every document's pieces in sequences of 1024 tokens."""
    return pack_documents(docs.select("doc_id", "text"), size=1024, end_id=2).drop("text_hash")
