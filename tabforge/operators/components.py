"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import files_for, materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step. Large: link every larger neighbour of u to the smallest id around u.
    Small: link u and its smaller neighbours to the smallest of them."""
    if small:
        arcs = edges.select("g", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        arcs = edges.select("g", F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select("g", F.col("b").alias("u"), F.col("a").alias("v")))
    # The minimum is pre-aggregated; a hub's arcs are then joined to one row, which AQE may split.
    low = arcs.groupBy("g", "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = arcs.join(low, ["g", "u"])
    if small:
        linked = joined.select("g", F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("g", F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        linked = joined.filter("v > u").select("g", F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.filter("a <> b").distinct()


#: Bytes of an edge.
EDGE_BYTES = 24


def connected_components(edges: DataFrame, max_rounds: int = 60, most_edges: int | None = None) -> DataFrame:
    """(g, node, root) for every node of at least one edge; root is the smallest id of the component.

    ``edges`` has columns g (graph), a, b: all graphs are solved together. Alternating large and small
    star steps turn every component into a star in a number of rounds logarithmic in its size. Each
    round is written out, so lineage stays one round long, in as many files as its edges need.
    ``most_edges``: a bound on the rows of ``edges``, where the caller knows one.
    """
    edges = materialize(edges.filter("a <> b").select("g", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges",
                        None if most_edges is None else files_for(most_edges, EDGE_BYTES))
    before, n = None, edges.count()
    for _ in range(max_rounds):
        edges = materialize(_star(_star(edges, small=False), small=True), "edges", files_for(2 * n, EDGE_BYTES))  # an edge leaves two at most
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("g", "a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    leaves = edges.select("g", F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select("g", F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
