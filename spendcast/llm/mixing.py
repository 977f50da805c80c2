"""Mixing sources to target weights with DataFrame operations only.

Targets are shares of a total by source weight, each at most ``most_repeats``
times its source, the excess going to the others by weight. Every (source,
shard) is cut into blocks of ``block_words`` words; within a shard the blocks
are allotted to the sources by the highest quotients ``target / (2 k + 1)``
(Sainte-Lague), and a seeded order picks which blocks of a source are taken.

Shards are buckets of documents of bounded size, so a source with a third of all
rows is spread over as many shards as it needs. Only the tables of sources and
of (source, shard) pairs are ranked as a whole; texts are never shuffled.

Edge cases: a null or empty text has size 0 and is never taken; null sources are
one source that sorts last; repeated rows are separate documents; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from spendcast.llm.batches import WORD
from spendcast.sources.scratch import scratch_folder

BLOCK_WORDS = 64
SHARD_WORDS = 4_000_000
WEIGHTS = (3.0, 1.0, 2.0)


def text_sizes(docs: DataFrame) -> DataFrame:
    """Words per document."""
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most_repeats: int = 2) -> DataFrame:
    """``(source, source_size, target)``: one row per source.

    Sources sorted by the share they can fill per weight are capped first; a
    source is capped while the level of the uncapped ones reaches its limit.
    """
    # The table of sources is a dimension: these windows see one row per source.
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = (
        totals.withColumn("weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("most", F.lit(float(most_repeats)) * F.col("source_size"))
        .withColumn("wanted", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    )
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("wanted") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("capped", F.col("most") <= F.col("level") * F.col("weight"))
    shared = F.min(F.when(~F.col("capped"), F.struct(F.col("most") / F.col("weight"), F.col("level")))).over(Window.partitionBy())
    return levels.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("most")).otherwise(shared.getField("level") * F.col("weight")).alias("target"),
    )


def block_quotas(shards: DataFrame, block_words: int = BLOCK_WORDS, most_repeats: int = 2) -> DataFrame:
    """Blocks granted per (source, shard) by the highest quotients of its shard.

    ``shards`` has ``shard, source, words, wanted`` (words to take). A seat ``k``
    has quotient ``wanted / (2 k + 1)``. With ``n`` sources and ``s`` seats in a
    shard the last granted quotient lies within ``n / (2 s)`` of the mean, so
    seats below that band are granted at once and only the band is ranked.
    """
    whole = Window.partitionBy("shard")
    votes = F.col("wanted") / F.lit(float(block_words))
    limits = (
        shards.withColumn("blocks", F.ceil(F.col("words") / F.lit(block_words)).cast("long"))
        .withColumn("votes", votes)
        .withColumn("seats", F.round(F.sum("votes").over(whole)).cast("long"))
        .withColumn("band", (F.count(F.lit(1)).over(whole) + 1) / (2 * F.greatest(F.col("seats"), F.lit(1))))
    )
    most = F.col("blocks") * most_repeats
    seat = lambda scale: F.floor(F.col("votes") * scale + 0.5).cast("long")
    based = limits.withColumn(
        "sure", F.least(most, F.greatest(F.lit(0), seat(F.lit(1) - F.col("band"))))
    ).withColumn("open", F.greatest(F.lit(0), F.least(most, seat(F.lit(1) + F.col("band")) + 1) - F.col("sure")))
    ranked = (
        based.withColumn("left", F.col("seats") - F.sum("sure").over(whole))
        .withColumn("k", F.explode_outer(F.when(F.col("open") > 0, F.sequence(F.col("sure"), F.col("sure") + F.col("open") - 1))))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
    )
    best = whole.orderBy(F.col("quotient").desc_nulls_last(), F.col("source").isNull(), F.col("source"), F.col("k"))
    granted = F.row_number().over(best) <= F.col("left")
    return (
        ranked.withColumn("granted", granted & F.col("k").isNotNull())
        .groupBy("shard", "source", "blocks", "sure")
        .agg(F.sum(F.col("granted").cast("long")).alias("more"))
        .select("shard", "source", "blocks", (F.col("sure") + F.col("more")).alias("quota"))
    )


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most_repeats: int = 2,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 17,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document."""
    spark = docs.sparkSession
    path = scratch_folder(spark, "sizes")
    text_sizes(docs).write.parquet(path)
    sizes = spark.read.parquet(path)
    targets_path = scratch_folder(spark, "targets")
    source_targets(sizes, weights, share, most_repeats).write.parquet(targets_path)
    targets = spark.read.parquet(targets_path)
    words = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-words // shard_words))

    # md5 orders and deals: SQL engines agree on it.
    number = lambda *key: F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 12), 16, 10).cast("long")
    dealt = sizes.withColumn("shard", number(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) % shards)
    group = Window.partitionBy("shard", "source").orderBy("doc_id", "size")
    placed = dealt.withColumn("until", F.sum("size").over(group.rowsBetween(Window.unboundedPreceding, 0)))

    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    parts = dealt.groupBy("shard", "source").agg(F.sum("size").alias("words"))
    wanted = parts.alias("p").join(targets.alias("t"), same("p", "t")).select(
        "p.shard", "p.source", "p.words",
        F.when(F.col("t.source_size") > 0, F.col("t.target") * F.col("p.words") / F.col("t.source_size")).otherwise(0.0).alias("wanted"),
    )
    quotas = block_quotas(wanted, block_words, most_repeats)
    place = Window.partitionBy("shard", "source").orderBy("key", "block")
    copies = (
        # A row becomes thousands of blocks, which sizes measured before don't show.
        quotas.filter("quota > 0").repartition(shards, "shard", "source")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("key", number(F.lit(seed), F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull().cast("string"), F.col("shard"), F.col("block")))
        .withColumn("rank", F.row_number().over(place))
        .select(
            "shard", "source", "block",
            (F.floor(F.col("quota") / F.col("blocks")) + (F.col("rank") <= F.col("quota") % F.col("blocks")).cast("long")).alias("copies"),
        )
    )
    size = F.lit(block_words)
    spans = placed.withColumn("begin", F.col("until") - F.col("size")).withColumn(
        "block",
        F.explode_outer(
            F.when(F.col("size") > 0, F.sequence(F.floor(F.col("begin") / size), F.floor((F.col("until") - 1) / size)))
        ),
    )
    overlap = F.least("s.until", (F.col("s.block") + 1) * size) - F.greatest("s.begin", F.col("s.block") * size)
    met = (F.col("s.shard") == F.col("c.shard")) & same("s", "c") & (F.col("s.block") == F.col("c.block"))
    taken = (
        spans.alias("s").join(copies.alias("c").hint("merge"), met, "left")
        .groupBy("s.shard", "s.source", "s.doc_id", "s.size", "s.until")
        .agg(F.sum(F.coalesce(overlap * F.col("c.copies"), F.lit(0))).cast("long").alias("taken"), F.count(F.lit(1)).alias("rows"))
    )
    # Empty repeated rows of one document meet in one group; each gets its row back.
    each = taken.withColumn("__row", F.explode(F.sequence(F.lit(1), F.when(F.col("size") == 0, F.col("rows")).otherwise(F.lit(1)).cast("int"))))
    return each.alias("d").join(targets.alias("t"), same("d", "t")).select(
        "d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "d.taken"
    )


def mixing_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mix_sources(docs).drop("source")


MIXING_SQL = f"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY 1),
weighted AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
  CASE (row_number() OVER (ORDER BY (source IS NULL)::INT, source) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
  1.5::DOUBLE * sum(source_size) OVER () AS wanted FROM per),
levels AS (SELECT *, (wanted - coalesce(sum(most) OVER (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY most / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
marked AS (SELECT *, most <= level * weight AS capped FROM levels),
shared AS (SELECT arg_min(level, most / weight) AS level FROM marked WHERE NOT capped),
targets AS (SELECT source, source_size, CASE WHEN capped THEN most ELSE (SELECT level FROM shared) * weight END AS target FROM marked),
n AS (SELECT greatest(1, ceil(sum(size) / {SHARD_WORDS}.0))::BIGINT AS shards FROM sizes),
dealt AS (SELECT s.*, ('0x' || substr(md5('17|' || doc_id), 1, 12))::BIGINT % (SELECT shards FROM n) AS shard FROM sizes s),
placed AS (SELECT *, (sum(size) OVER (PARTITION BY shard, source ORDER BY doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS until FROM dealt),
parts AS (SELECT shard, source, sum(size)::BIGINT AS words FROM dealt GROUP BY 1, 2),
votes AS (SELECT shard, p.source, words, ceil(words / {BLOCK_WORDS}.0)::BIGINT AS blocks,
  CASE WHEN source_size > 0 THEN target * words / source_size ELSE 0 END / {BLOCK_WORDS}.0::DOUBLE AS votes
  FROM parts p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
seats AS (SELECT *, round(sum(votes) OVER (PARTITION BY shard))::BIGINT AS seats FROM votes),
quotients AS (SELECT shard, source, blocks, seats, k, votes / (2 * k + 1) AS quotient
  FROM seats, range(0, 2 * blocks) AS r(k)),
best AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY quotient DESC, source NULLS LAST, k) AS place FROM quotients),
quotas AS (SELECT shard, source, any_value(blocks) AS blocks, count(*) FILTER (WHERE place <= seats) AS quota FROM best GROUP BY 1, 2),
blocks AS (SELECT shard, source, blocks, quota, block,
  row_number() OVER (PARTITION BY shard, source ORDER BY ('0x' || substr(md5('17|' || coalesce(source, '') || '|' || (source IS NULL) || '|' || shard || '|' || block), 1, 12))::BIGINT, block) AS rank
  FROM quotas, range(0, blocks) AS b(block) WHERE quota > 0),
copies AS (SELECT shard, source, block, quota // blocks + (rank <= quota % blocks)::INT AS copies FROM blocks),
spans AS (SELECT *, until - size AS begin FROM placed),
taken AS (SELECT s.doc_id, s.source, s.size, sum(coalesce(copies * (least(until, (block + 1) * {BLOCK_WORDS}) - greatest(begin, block * {BLOCK_WORDS})), 0))::BIGINT AS taken
  FROM spans s LEFT JOIN copies c ON s.shard = c.shard AND s.source IS NOT DISTINCT FROM c.source AND s.size > 0
    AND block BETWEEN begin // {BLOCK_WORDS} AND (until - 1) // {BLOCK_WORDS} GROUP BY ALL)
SELECT doc_id, size, source_size, target, taken FROM taken d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
"""
