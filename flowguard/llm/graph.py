"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (least node of it) for every node of the edges (longs, a != b).

    Each step hangs neighbours onto the least node they know of; the graph stays an edge table,
    is written once per round, and rounds end when it no longer changes. No neighbour list is
    ever collected: a step is a minimum per node and a join.
    """
    state = stage(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("v <> u").distinct(), "edges")
    before = None
    while True:
        both = state.select("v", "u").unionByName(state.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")) \
                    .filter("v <> u").distinct()
        large = stage(large, "edges")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.greatest("u", "m").alias("v"), F.least("u", "m").alias("u")) \
                     .unionByName(least.select("v", F.col("m").alias("u"))).filter("v <> u").distinct()
        state = stage(small, "edges")
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return state.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        state.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
