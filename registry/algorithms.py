"""G queries and J4."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import graph as G, series as Se
from bazaarflow.session import scratch_path

from .base import big, query, using

# Levels as longest paths from the roots; distinct (node, depth) pairs keep this small.
LEVELS = {
    "nodes": "select src as node from edges union select dst from edges",
    "walk": """select node, 0::bigint as depth from nodes where node not in (select dst from edges)
      union select e.dst, w.depth + 1 from walk w join edges e on e.src = w.node""",
    "levels": "select node, max(depth) as level from walk group by 1",
}


@query("g1_topo_levels", using("edges", "select node, level from levels", recursive=True, also=LEVELS))
def g1(spark, root):
    return G.topo_levels(B.edges(spark, root))


@query(
    "g1_topo_order",
    using("edges", "select *, row_number() over (order by level, node) - 1 as place from levels", recursive=True, also=LEVELS),
)
def g1_order(spark, root):
    return G.topo_order(G.topo_levels(B.edges(spark, root)))


# Nodes on or behind a cycle, from all pairs of a node and what comes after it.
CHECK = """select count(*) as nodes, count(*) - count(held) as placed, count(held) = 0 as valid
  from nodes left join (select distinct node as held from (
    select src as node from reach where src = dst union all
    select r.dst from reach r join (select src from reach where src = dst) c on c.src = r.src) h) b on node = held"""
REACH = {
    "nodes": "select src as node from {0} union select dst from {0}",
    "reach": "select src, dst from {0} union select r.src, e.dst from reach r join {0} e on e.src = r.dst",
}


@query("g2_graph_check", using("edges", CHECK, recursive=True, also={k: v.format("edges") for k, v in REACH.items()}))
def g2(spark, root):
    return G.graph_check(B.edges(spark, root))


@query(
    "g2_cycle_check",
    using(
        "edges",
        CHECK,
        recursive=True,
        also={"looped": "select * from edges union all select max(dst), cast(floor(max(dst) / 2) as bigint) from edges"}
        | {k: v.format("looped") for k, v in REACH.items()},
    ),
)
def g2_cycle(spark, root):
    """The last part becomes a prerequisite of its own parent, which holds up all that come after it."""
    edges = B.edges(spark, root)
    back = edges.agg(F.max("dst").alias("src")).withColumn("dst", F.floor(F.col("src") / 2))
    looped = edges.unionByName(back)
    return G.can_complete(looped.select(F.col("dst").alias("task"), F.col("src").alias("prerequisite")))


@query(
    "g3_first_breach",
    using("hourly_series", "select series, coalesce(min(pos) filter (n > 8), -1) as first_breach from hourly_series group by 1"),
)
def g3(spark, root):
    return Se.first_breach(B.hourly_series(spark, root), "series", "pos", "n", 8)


@query(
    "g4_min_batch_size",
    using(
        "hourly_series",
        """select min(b) as min_batch_size from (select b, sum(ceil(n / b)) as batches from hourly_series,
        (select unnest(range(1, (select max(n) + 1 from hourly_series))) as b) t group by b) u
      where batches <= 4500 or b = (select max(n) from hourly_series)""",
    ),
)
def g4(spark, root):
    return Se.min_batch_size(B.hourly_series(spark, root), "n", 4500)


@query(
    "g5_position_of",
    using("hourly_series", "select series, coalesce(min(pos) filter (n = 7), -1) as position from hourly_series group by 1"),
)
def g5(spark, root):
    return Se.position_of(B.hourly_series(spark, root), "series", "pos", "n", 7)


@query("g5_sorted_position", using("hourly_series", "select series, coalesce(min(pos) filter (n = 7), -1) as position from hourly_series group by 1"))
def g5_sorted(spark, root):
    """On series stored by value, with small row groups."""
    path = scratch_path(spark, "series")
    Se.store_sorted(B.hourly_series(spark, root), "series", "pos", "n", path, row_group_bytes=1 << 12)
    return Se.position_in_sorted(spark, path, "series", "pos", "n", 7)


@query("g3_sorted_breach", using("hourly_series", "select series, coalesce(min(pos) filter (n > 8), -1) as first_breach from hourly_series group by 1"))
def g3_sorted(spark, root):
    path = scratch_path(spark, "series")
    Se.store_sorted(B.hourly_series(spark, root), "series", "pos", "n", path, row_group_bytes=1 << 12)
    return Se.breach_in_sorted(spark, path, "series", "pos", "n", 8)


PAIRS = """select i, j, cast(a_i as double) as amount_i, cast(a_j as double) as amount_j from (
  select x.o_orderkey as i, y.o_orderkey as j, x.a as a_i, y.a as a_j, row_number() over (order by y.o_orderkey,
    x.o_orderkey desc) as rn from (select *, cast(o_totalprice as decimal(18,2)) as a from orders) x
  join (select *, cast(o_totalprice as decimal(18,2)) as a from orders) y
  on x.a = {target}::decimal(18,2) - y.a and x.o_orderkey < y.o_orderkey) t where rn = 1"""


@query("g6_pair_sum", PAIRS.format(target="500000.00"))
def g6(spark, root):
    return Se.pair_sum(B.table(spark, root, "orders"), "o_orderkey", "o_totalprice", "500000.00")


@query("j4_pair_join", PAIRS.format(target="400000.00"))
def j4(spark, root):
    return Se.pair_sum(B.table(spark, root, "orders"), "o_orderkey", "o_totalprice", "400000.00")
