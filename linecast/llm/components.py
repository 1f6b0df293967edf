"""Connected components by alternating star contraction.

Every round replaces the edges of each node by edges to its smallest
neighbour: first for the larger neighbours (large star), then for the smaller
ones (small star). The edges end as stars around each component's smallest
node, after a number of rounds that grows with the logarithm of the graph.
Each round is two aggregations and two joins on a table that is written to the
shared folder; a hub's rows are split by the skew join, since the other side
holds one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecast.llm.common import materialize


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(down, "u")
    return small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) -> (node, component) for every node with an edge to
    another; the component is its smallest node. Null ends are ignored."""
    apart = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = apart.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(now, "components")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(now)
    for _ in range(max_rounds if before[0] else 0):
        now = materialize(_stars(now), "components")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
