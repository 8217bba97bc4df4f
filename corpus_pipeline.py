"""The corpus pipeline: each stage calls one operator of skylane.llm on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylane.llm import stages
from skylane.llm.common import Stash, table

STAGES = [
    ("toxicity", stages.toxicity_stage),
    ("exact_dedup", stages.exact_stage),
    ("simhash_near_dedup", stages.simhash_stage),
    ("substring_dedup", stages.substring_stage),
    ("best_fit_packing", stages.packing_stage),
]

#: Tokens, fingerprints and the fitted grammar have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written to the shared folder and read again."""
    stash = Stash(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
