"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.sources.workspace import Workspace


def _digest(links: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum; two numbers reach the driver."""
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row.n, int(row.h or 0)


def star_roots(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node, root`` for every node of ``links (u, v)``; the root is the least node it reaches.

    A large-star step hands all larger neighbours of a node its least neighbour, a
    small-star step the smaller ones.  Both keep components whole, and they end in stars
    after a number of rounds that grows with the logarithm of the nodes.  Minima are
    combined before the shuffle and hubs meet their links in joins that Spark can split.
    Every round is a written table, so a lost executor costs one round at most.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = work.keep(ordered, f"{name}-0")
    before, turn = _digest(state), 0
    while True:
        turn += 1
        both = state.union(state.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        small = pairs.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        state = work.keep(small.select("e.u", "e.v").where("u <> v").distinct(), f"{name}-{turn}")
        now = _digest(state)
        if now == before:
            break
        before = now
    roots = state.select(F.col("v").alias("node")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
