"""Connected components of an edge table by alternating star contraction.

Each round links every node straight to the smallest neighbour it knows; the
number of rounds grows with the logarithm of the longest chain.  Only tables
of nodes and edges are shuffled, aggregated before they are, and every round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.textkit import stored

MAX_ROUNDS = 60


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                     F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable."""
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    last = None
    for _ in range(MAX_ROUNDS):
        # large star: neighbours above a node move to the smallest of its neighbours and itself
        both = _both(e)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = stored(large.join(least, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                                     F.struct(F.col("a").alias("a"), F.col("m").alias("b")))))
                       .filter("a > b").distinct(), "small-star")
        state = small.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        e = small
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components do not converge")
    heads = e.groupBy("a").agg(F.min("b").alias("component"))
    return heads.select(F.col("a").alias("node"), "component").unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
