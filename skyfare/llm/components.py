"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.store import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the least of u and its neighbours.

    Minima are taken before the shuffle. They are stored, since the join can then be split where
    a node has a large part of all edges; it could not right after an aggregate.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    least = stored(least, "least")
    return edges.join(least, edges.u == least.w).select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the least node that links reach.

    Every round joins each node to the least node it knows, first from above, then from below. The
    number of rounds grows with the logarithm of the longest path. Rows with NULL and loops are left
    out; repeated edges count once; no edges give no rows.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = _with_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
