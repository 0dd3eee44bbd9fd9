"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of ``edges`` (u, v; any orientation).

    Each round writes its star edges to the shared folder; it ends when the
    edges no longer change, that is, when every edge points at a minimum.
    """
    current = scratch(spark, edges.where("u <> v").select("u", "v").distinct(), "cc-0")
    state, k = None, 0
    while True:
        k += 1
        current = scratch(spark, _small_star(_large_star(current)), f"cc-{k}")
        new = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (new.n, new.h) == state:
            break
        state = (new.n, new.h)
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
