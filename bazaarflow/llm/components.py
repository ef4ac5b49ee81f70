"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    # As a table of its own, it lets the skew join split a node of many edges.
    moved = both.filter("b > a").join(stored(low, "low"), "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    # Edges run from the larger end (a) to the smaller (b).
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a")
    links = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
    return links.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node of it) for each node that has an edge.

    ``edges`` has two bigint columns a and b. A node that a third of all edges share is only aggregated (with partial sums
    in each task) or joined to one row, which the skew join can split. Each round goes to a table in the shared folder.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if mark == (now["n"], now["h"]):
            break
        mark = (now["n"], now["h"])
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
