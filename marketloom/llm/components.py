"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that an edge (u, v) of longs touches.

    The component is the smallest node reachable.  Null ends and self-links add nothing.  Each round
    links every node's larger neighbours to the smallest one it sees, then every node's smaller
    neighbours likewise; the graph ends as one star per component after about log(n) rounds.  Stars
    are built from grouped minima joined back, so a node with very many neighbours is summed map-side
    and its join partition can be split.  Each round's edges are checkpointed.
    """
    stars = checkpointed(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = _fingerprint(stars)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpointed(small.unionByName(roots.withColumnRenamed("m", "v")).distinct())
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
