"""Task levels of a dependency graph, and cycle detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..session import materialize, scratch_path
from .ordered import DEFAULT, SkewPolicy, position


def graph_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionAll(edges.select(F.col("dst").alias("node"))).distinct()


def topo_levels(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(node, level) of every node that can be ordered; nodes on or behind a cycle are absent.

    A level is the longest path from a node without predecessors. Each round places the nodes that wait for nobody and turns
    their edges into offers of a level; and every edge that starts at a node with one predecessor starts at that
    predecessor instead, with the lengths added. So paths without joins halve in every round: a chain of n nodes takes about
    log n rounds, any graph at most as many as it has levels, and edges get fewer with every round.

    ``nodes`` adds nodes without edges. An edge without one of its ends is none.
    """
    spark = edges.sparkSession
    out = scratch_path(spark, "levels")
    ends = edges.filter("src is not null and dst is not null")
    key = ends.schema["src"].dataType.simpleString()
    known = graph_nodes(ends) if nodes is None else graph_nodes(ends).unionAll(nodes.select("node")).distinct()
    # Edges, and for every node a row without a source whose length is the best offer so far.
    own = known.select(F.lit(None).cast(key).alias("src"), F.col("node").alias("dst"), F.lit(0).cast("bigint").alias("length"))
    rows = own.unionAll(ends.select("src", "dst", F.lit(1).cast("bigint").alias("length")))
    most, step = None, 0
    while True:
        path, seen = f"{out}/round={step}", Observation()
        merged = rows if step else rows.groupBy("src", "dst").agg(F.max("length").alias("length"))
        edge = F.col("src").isNotNull()
        state = merged.groupBy(F.col("dst").alias("node")).agg(
            F.count("src").alias("waiting"),
            F.max("src").alias("before"),
            F.max(F.when(edge, F.col("length"))).alias("length"),
            F.max(F.when(~edge, F.col("length"))).alias("offer"),
        )
        free = F.col("waiting") == 0
        state.observe(seen, F.count_if(free).alias("placed"), F.count("*").alias("nodes")).write.parquet(path)
        counts = seen.get
        state = spark.read.schema(f"node {key}, waiting bigint, before {key}, length bigint, offer bigint").parquet(path)
        if not counts["placed"] or counts["placed"] == counts["nodes"]:
            break
        most = counts["nodes"] if most is None else most
        rows, step = materialize(_next_round(merged, state, most)), step + 1
    placed = spark.read.schema(f"node {key}, waiting bigint, offer bigint").option("basePath", out).parquet(out)
    return placed.filter("waiting = 0").select("node", F.col("offer").cast("int").alias("level"))


def _next_round(rows: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Edges and offers after the free nodes are placed and the paths through nodes with one predecessor are shortened."""
    # Only around a cycle lengths pass the number of nodes; they are kept small there, as they double.
    sum_ = lambda a, b: F.least(F.lit(most), F.col(a) + F.col(b))
    free = state.filter("waiting = 0").select(F.col("node").alias("_parent"), F.col("offer").alias("_above"))
    single = (F.col("waiting") == 1) & (F.col("before") == F.col("_parent"))
    first = state.join(free, single, "left").drop("_parent")
    first = first.withColumn("offer", F.greatest("offer", F.when(F.col("_above").isNotNull(), sum_("_above", "length"))))
    met = rows.filter("src is not null").join(first.select(*[F.col(c).alias(f"_{c.lstrip('_')}") for c in first.columns]), F.col("src") == F.col("_node"))
    row = lambda src, length: F.struct(src.alias("src"), F.col("dst").alias("dst"), length.alias("length"))
    nobody = F.lit(None).cast(rows.schema["src"].dataType)
    offer = row(nobody, sum_("_offer", "length"))
    moved = row(F.col("_before"), sum_("_length", "length"))
    kept = row(F.col("src"), F.col("length"))
    # A node behind a free one alone has its level already; it is free itself in the next round.
    settled = (F.col("_waiting") == 0) | F.col("_above").isNotNull()
    turned = F.when(settled, F.array(offer)).when(F.col("_waiting") == 1, F.array(offer, moved)).otherwise(F.array(kept))
    waiting = state.filter("waiting > 0").select(nobody.alias("src"), F.col("node").alias("dst"), F.col("offer").alias("length"))
    return met.select(F.explode(turned).alias("r")).select("r.*").unionAll(waiting).groupBy("src", "dst").agg(F.max("length").alias("length"))


def topo_order(levels: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Add the place of each node in an execution order: by level, then by node."""
    return position(levels, [], ["level", "node"], "place", policy, cut_all=True)


def graph_check(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """One row: nodes, placed nodes, and whether all can be ordered (no cycle)."""
    nodes = nodes if nodes is not None else graph_nodes(edges)
    placed = topo_levels(edges, nodes).agg(F.count("*").alias("n")).scalar()
    counts = nodes.agg(F.count("*").alias("nodes")).withColumn("placed", placed)
    return counts.withColumn("valid", F.col("nodes") == F.col("placed"))


def can_complete(prerequisites: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Same check for (task, prerequisite) pairs."""
    edges = prerequisites.select(F.col("prerequisite").alias("src"), F.col("task").alias("dst"))
    return graph_check(edges, tasks)
