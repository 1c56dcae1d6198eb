"""Connected components of a table of links, by alternating stars.

Every round points each node at the smallest node among its neighbours, first for larger
neighbours, then for smaller ones. A node with a third of all links is no hot group: only
minima are aggregated, and the joins are plain equi-joins that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.staging import drop_stage, stage

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node that has a link; the component is its smallest node.

    Links may repeat, may join a node to itself and may point either way. Nulls are dropped.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        (F.col("u") > F.col("v"))).distinct()
    pairs = stage(pairs, "links")
    for _ in range(MAX_ROUNDS):
        stars = stage(_small(_large(pairs)), "links")
        same = _fingerprint(stars) == _fingerprint(pairs)
        drop_stage(pairs)
        pairs = stars
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    # Each remaining pair is (node, root).
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _fingerprint(pairs: DataFrame):
    return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def _large(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest neighbour."""
    both = pairs.select("u", "v").unionByName(
        pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") > F.col("v")).distinct())


def _small(pairs: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter(F.col("u") > F.col("v")).distinct())
