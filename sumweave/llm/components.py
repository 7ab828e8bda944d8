"""Connected components of a table of links, by alternating stars in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved


def _both(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(pairs: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def connected(spark: SparkSession, links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of links (u, v): component is the least node reachable.

    Each round hangs larger neighbours on the least one (a node's link list meets its own minimum in
    a join, which Spark may split where a node is hot), then smaller ones. Rounds are written to the
    shared folder; their number grows with the logarithm of the largest component. Null ends take no
    part; links of a node with itself are dropped.
    """
    links = saved(spark, links.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        pairs = _both(links)
        large = pairs.join(_least(pairs), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = saved(spark, large.distinct(), "links")
        # Now v < u in each row: hang u and its smaller neighbours on the least of these.
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = saved(spark, small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            # All links lead to a least node.
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
