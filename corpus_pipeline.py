"""Corpus pipeline: documents through quality rules, near-duplicate removal, secret
masking and source mixing to tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendcast.llm import registry, stages
from spendcast.sources.scratch import scratch_folder

STAGES = [
    ("quality rules", stages.quality),
    ("near duplicates", stages.deduplicate),
    ("secrets", stages.mask_secrets),
    ("mixing", stages.mix),
    ("tokens", stages.tokenise),
]
ORACLE_SQL = None  # MinHash groups, the forest and BPE are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's table is stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**registry.QUERIES, "pipeline": run}
ORACLES = {**registry.ORACLES}
