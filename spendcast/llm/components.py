"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spendcast.llm.store import Store


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (u, v)``; the root is the least node.

    Alternates two star steps: each node hands its larger neighbours, then its
    smaller ones, to the least of them. Every step is a partial aggregation and a
    join, so a node with many links is split like any skewed key."""
    store = Store(links.sparkSession)
    edges = store.put(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links-0"
    )
    state, step = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v")).filter("u <> v").distinct()
        large = store.put(large, f"large-{step}")
        roots = large.groupBy("u").agg(F.min("v").alias("root"))
        small = large.join(roots, "u").select(F.explode(F.array(F.struct("u", F.col("root").alias("v")), F.struct(F.col("v").alias("u"), F.col("root").alias("v")))).alias("e"))
        edges = store.put(small.select("e.u", "e.v").filter("u <> v").distinct(), f"links-{step + 1}")
        store.drop(f"links-{step}", f"large-{step}")
        step += 1
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
