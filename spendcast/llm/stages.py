"""Pipeline stages: documents in, documents (or tokens) out.

Each keeps the columns of ``docs``. Where decisions are joined back, rows meet by
doc_id, nulls included; rows that share a doc_id share the decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm import bpe, mixing, near_dup, rules, secrets

ROUND_SEED = 29


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base test or are likely bad by the rules' votes."""
    return rules.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group, the one with the least doc_id,
    a document without one only where none has any; of rows equal in doc_id and text
    one stays. Rows meet their verdict by doc_id and a hash of the text."""
    found = near_dup.near_duplicates(docs, near_dup.STAGE).filter("stays")
    rows, id_, mark = (f"{name}_{'_'.join(docs.columns)}" for name in ("rows", "id", "mark"))  # clash with no column
    kept = found.groupBy(F.col("doc_id").alias(id_), F.col("mark").alias(mark)).agg(F.count(F.lit(1)).alias(rows))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(F.col("text").cast("string")) == F.col(mark))
    joined = docs.join(kept, same)
    single = joined.filter(F.col(rows) == 1)
    several = joined.filter(F.col(rows) > 1).dropDuplicates(["doc_id", "text"])
    return single.unionByName(several).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop whole documents so that sources come near their targets.

    A document of which the mix takes a share ``s`` of its words is returned
    ``floor(s + u)`` times, ``u`` being a seeded number in [0, 1): s times on average."""
    taken = mixing.mix_sources(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    key = F.md5(F.concat_ws("|", F.lit(ROUND_SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    u = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    copies = F.floor(F.col("taken") / F.col("size") + u).cast("int")
    counted = taken.filter("size > 0").select(F.col("doc_id").alias("__id"), copies.alias("__copies")).filter("__copies > 0")
    joined = docs.join(counted, F.col("doc_id").eqNullSafe(F.col("__id")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of their decoding."""
    return bpe.round_trip(docs, *bpe.default_vocabulary(), ids=True)
