"""Connected components of an edge table by alternating stars, in DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mqtable.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node next to it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    Each round is written to the shared folder, so lineage stays short and lost executors cost one
    round.  Neighbour lists are never gathered: a round aggregates the least neighbour per node,
    with map-side partial minima, and joins it back.  An empty table gives no rows.
    """
    now = materialize(_small_star(materialize(edges.select("u", "v"), "edges")), "components")
    state = None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(sums)
        now = materialize(_small_star(_large_star(now)), "components")
