"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarecohort.sources.staging import checkpoint


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); a component's name is its smallest node.

    Large-star and small-star rounds by turns: each node hands its larger, then
    its smaller neighbours to the smallest one.  Minima are aggregated before they are
    shuffled, so a node with very many edges is not gathered anywhere.
    """
    edges = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    state = _state(edges)
    while state[0]:
        # Large-star: for each node, its larger neighbours get its smallest one.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpoint(large)
        # Small-star: all edges point down; the smaller neighbours and the node get the smallest one.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        next_edges = checkpoint(small.unionAll(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        before, state, edges = state, _state(next_edges), next_edges
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
