"""Physical plans: what reaches the scans, and that no task gets a whole table."""

import re

import pytest
from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import reviews, topk
from bazaarflow.operators.ordered import position
from bazaarflow.plans.cohort_retention import cohort_retention
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.plans.fraud_patterns import fraud_patterns
from registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_only_needed_columns_are_read(spark, root):
    text = plan(daily_revenue(B.orders_fact(spark, root)))
    lineitem = next(x for x in re.findall(r"ReadSchema: (struct<.*>)", text) if "l_orderkey" in x)
    assert set(re.findall(r"(\w+):", lineitem)) == {"l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"}


def test_filters_reach_the_scan(spark, root):
    late = B.orders_fact(spark, root).filter(F.col("seller_id") == 7).groupBy("category").count()
    assert "EqualTo(l_suppkey,7)" in plan(late)
    assert "GreaterThan(n_chars,100)" in plan(B.table(spark, root, "documents").filter("n_chars > 100").select("doc_id"))


def test_order_events_are_filtered_in_the_scan(spark, root):
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(B.orders_placed(spark, root).select("event_id"))).group(1)
    assert "Not(In(event_type" in pushed


def test_largest_table_is_joined_last(spark, root):
    """Lines meet orders that already carry their customer and place."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = daily_revenue(B.orders_fact(spark, root))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = re.findall(r"SortMergeJoin \[(\w+)#", tree)
    assert joins == ["l_partkey", "l_orderkey", "o_custkey", "n_regionkey", "c_nationkey"]


def test_lake_filters_prune_partitions(spark, root, tmp_path):
    from bazaarflow.sources import lake

    path = str(tmp_path / "bronze")
    lake.archive_batch(B.events_fact(spark, root), 0, path)
    read = lake.read_lake(spark, path).filter("zone = 'orders' and day = '05'").select("event_id")
    text = plan(read)
    partition_filters = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "zone" in partition_filters and "day" in partition_filters
    assert read.count() > 0


@pytest.mark.parametrize(
    "name",
    ["m1_daily_revenue", "m2_cohort_retention", "m4_fraud_patterns", "m5_category_trends", "w6_trailing_count", "t1_velocity_alerts"],
)
def test_no_single_partition(spark, root, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, root))


def test_whole_table_positions_are_cut(spark, root):
    """Only the table of chunk totals may meet in one task, never the rows."""
    out = position(B.table(spark, root, "orders"), [], ["o_totalprice", "o_orderkey"], cut_all=True)
    tree = out._jdf.queryExecution().executedPlan().toString()
    single = [i for i, line in enumerate(tree.splitlines()) if "SinglePartition" in line]
    for i in single:
        below = "\n".join(tree.splitlines()[i + 1 : i + 4])
        assert "Aggregate" in below
    assert "_chunk" in re.search(r"Window \[.*sum\(1.*", tree).group(0)


def test_top_k_keeps_k_per_task(spark, root):
    orders = B.table(spark, root, "orders")
    assert "TakeOrderedAndProject" in plan(topk.top_by_count(orders, "o_custkey", 5))
    per_group = topk.top_per_group(orders, "o_orderstatus", [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)
    assert "WindowGroupLimit" in plan(per_group)


def test_cohorts_aggregate_before_their_window(spark, root):
    """The window per customer runs over weeks; orders are combined before it."""
    tree = cohort_retention(B.orders_fact(spark, root), ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Window") >= 1
    assert tree.rfind("HashAggregate") > tree.rfind("Window [min(")


def test_fraud_signals_share_one_aggregation(spark, root):
    tree = plan(fraud_patterns(B.orders_fact(spark, root), ordered=False))
    assert len(re.findall(r"Location: .*lineitem", tree)) == 1


def test_no_python_in_the_marts(spark, root):
    for name in ("m1_daily_revenue", "m2_cohort_retention", "m4_fraud_patterns", "m5_category_trends", "q5_suite"):
        text = plan(QUERIES[name](spark, root))
        assert "Python" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_results_do_not_depend_on_shuffle_width(spark, root, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name, total in SUMS.items():
            rows = sorted(map(repr, QUERIES[name](spark, root).collect()))
            assert total.setdefault("rows", rows) == rows
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


SUMS = {"m2_cohort_retention": {}, "w2_dense_rank": {}, "t3_allocate_stock": {}, "v2_semantic_search": {}}


def test_model_hooks_move_only_their_text(spark):
    df = spark.range(5).selectExpr("id", "concat('a', id) as p", "array(struct(id, 'x' as x)) as rest")
    out = reviews.embed(reviews.call_model(df, "p", lambda ps: [p.upper() for p in ps]), "p", lambda ts: [[3.0, 4.0] for _ in ts])
    found = plan(out)
    assert "ArrowEvalPython" in found and "MapInPandas" not in found
    rows = out.orderBy("id").collect()
    assert [r.raw_response for r in rows] == [f"A{k}" for k in range(5)]
    assert [r.embedding for r in rows] == [[0.6, 0.8]] * 5
    assert [r.rest[0].id for r in rows] == list(range(5))
    assert reviews.embed(df.filter("id < 0"), "p", lambda ts: [[1.0] for _ in ts]).count() == 0
