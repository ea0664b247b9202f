"""Connected components by alternating large-star and small-star steps.

Every step is joins and map-side combined minima over the edge table, written
to the shared folder; nothing but two totals per round reaches the driver.
The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stage

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the edges (a, b); component is the smallest id reachable.

    Edges may repeat and come in either direction; loops and edges with a null
    end connect nothing. An empty table gives an empty result.
    """
    e = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    before = _state(e)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stage(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "star")
        after = _state(e)
        if after == before:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = after
    if before[0]:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
