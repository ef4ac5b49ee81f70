"""Stored upserts, sorted series, file times, counters out of writes, distinct counts and maps."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import aggregates as A, reviews as R, series as Se, upsert as U
from bazaarflow.operators.counters import write_counted
from bazaarflow.plans.health import file_freshness
from bazaarflow.plans.seller_performance import seller_metrics
from bazaarflow.streaming.runner import run_counted


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path, cols = str(tmp_path / "table"), "k bigint, v string, version int"
    assert U.upsert_into(path, spark.range(500).selectExpr("id as k", "'old' as v", "0 as version"), ["k"], "version", buckets=16) == 16
    before = files(path)
    delta = spark.createDataFrame([(7, "mid", 1), (7, "new", 2), (1000, "added", 1)], cols)
    touched = U.upsert_into(path, delta, ["k"], "version", buckets=16)
    assert touched <= 2
    after = files(path)
    untouched = {f for f in before if f in after}
    assert all(after[f] == before[f] for f in untouched)
    assert len({os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in untouched}) == touched
    got = {r.k: r.v for r in U.read_table(spark, path).collect()}
    assert got == {k: "old" for k in range(500)} | {7: "new", 1000: "added"}
    # The same delta again changes nothing; an empty one writes nothing.
    U.upsert_into(path, delta, ["k"], "version", buckets=16)
    assert U.upsert_into(path, delta.limit(0), ["k"], "version", buckets=16) == 0
    assert {r.k: r.v for r in U.read_table(spark, path).collect()} == got
    with pytest.raises(ValueError):
        U.upsert_into(path, delta.withColumn("k", F.col("k") + 1), ["k"], "version", buckets=64)


def test_sorted_series_read_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "series")
    df = spark.range(200_000).selectExpr("concat('s', id % 4) as s", "id as pos", "(id * 7919) % 100003 as v")
    Se.store_sorted(df, "s", "pos", "v", path, row_group_bytes=1 << 14)
    for found, want in (
        (Se.position_in_sorted(spark, path, "s", "pos", "v", 5000), Se.position_of(df, "s", "pos", "v", 5000)),
        (Se.breach_in_sorted(spark, path, "s", "pos", "v", 100000), Se.first_breach(df, "s", "pos", "v", 100000)),
        (Se.position_in_sorted(spark, path, "s", "pos", "v", -1), Se.position_of(df, "s", "pos", "v", -1)),
    ):
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    text = Se.position_in_sorted(spark, path, "s", "pos", "v", 5000)._jdf.queryExecution().toString()
    assert "EqualTo(v,5000)" in text
    groups = []
    for name in files(f"{path}/rows"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("v")
        groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    held = [s for s in groups if s.min <= 5000 <= s.max]
    assert len(groups) >= 8 and 1 <= len(held) <= 2


def test_file_times(spark, tmp_path):
    for name, age in (("a", 3600), ("b", 90_000)):
        os.makedirs(tmp_path / "one" / name)
        file = tmp_path / "one" / name / "part.bin"
        file.write_bytes(b"12345")
        at = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp() - age
        os.utime(file, (at, at))
    os.makedirs(tmp_path / "empty")
    paths = {"both": str(tmp_path / "one"), "old": str(tmp_path / "one" / "b"), "empty": str(tmp_path / "empty"), "none": str(tmp_path / "none")}
    got = {r.name: (r.files, r.bytes, r.age_hours, r.fresh) for r in file_freshness(spark, paths, "2024-01-02 00:00:00").collect()}
    assert got == {"both": (2, 10, 1.0, True), "old": (1, 5, 25.0, False), "empty": (0, 0, None, False), "none": (0, 0, None, False)}


def test_counters_come_out_of_the_write(spark, root, tmp_path):
    rows = R.enrich(B.model_responses(spark, root))
    written, counters = write_counted(rows, str(tmp_path / "batch"), R.enrichment_numbers())
    want = R.enrichment_counters(rows).first().asDict()
    assert counters == want and written.count() == want["processed"]
    source = str(tmp_path / "source")
    B.model_responses(spark, root).repartition(5).write.parquet(source)
    stream = spark.readStream.schema(B.model_responses(spark, root).schema).option("maxFilesPerTrigger", 2).parquet(source)
    progress, streamed = run_counted(R.enrich(stream), R.enrichment_numbers(), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert streamed == want and progress.count() >= 3


def test_distinct_counts_do_not_copy_rows(spark, root):
    orders = B.orders_fact(spark, root)
    assert "Expand" not in plan(seller_metrics(orders))
    assert "Expand" not in plan(A.distinct_counts(orders, ["category"], ["customer_id", "seller_id", "city", "order_date"]))


def test_distinct_counts_with_nulls(spark):
    df = spark.createDataFrame([("a", 1, None, 2.5), ("a", 1, "x", 1.0), ("a", None, "y", None), (None, 3, "x", 4.0), ("b", None, None, None)], "k string, p int, q string, v double")
    got = A.totals_with_distincts(df, ["k"], {"total": F.col("v"), "n": F.lit(1)}, {"ps": "p", "qs": "q"})
    assert {r.k: tuple(r)[1:] for r in got.collect()} == {"a": (3.5, 3, 1, 2), None: (4.0, 1, 1, 1), "b": (None, 1, 0, 0)}
    assert {r.k: tuple(r)[1:] for r in A.distinct_counts(df, ["k"], ["p", "q"]).collect()} == {"a": (1, 2), None: (1, 1), "b": (0, 0)}


def test_sketches_merge_over_days(spark):
    """Estimates over thirty merged days stay within four standard errors, whatever values repeat between days."""
    df = spark.range(60_000).selectExpr("id % 30 as day", "cast(id * 31 % 20011 as string) as customer", "'k' as k")
    merged = A.sketched_counts(A.distinct_sketches(df, ["day", "k"], ["customer"]), ["k"], ["customer"]).first()
    exact = df.select("customer").distinct().count()
    assert abs(merged.distinct_customer - exact) <= 4 * 1.04 / 64 * exact


def test_maps_of_distributions(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "p string, q string").withColumn("amount_inr", F.lit(1).cast("decimal(18,2)"))
    got = {r.dimension: r.orders_by_value for r in A.distributions(A.counters(df, ["p", "q"])).collect()}
    assert got == {"p": {"a": 2, "b": 1}, "q": {"x": 1, "y": 1}}


def test_throughput_of_a_run(spark):
    from bazaarflow.plans.dashboard import snapshot_maps
    from bazaarflow.streaming.metrics import LiveMetrics

    progress = spark.createDataFrame([(0, 100, 50.0, True), (1, 300, 100.0, True), (2, 0, 0.0, True)], "batch_id bigint, input_rows bigint, rows_per_second double, drained boolean")
    assert LiveMetrics.throughput(progress) == 80.0
    assert LiveMetrics.throughput(progress.filter("input_rows = 0")) is None
    none = spark.createDataFrame([], "section string, place int, name string, value double, orders bigint, share_pct double")
    row = snapshot_maps(none, 80.0).first()
    assert row.total_orders is None and row.payment_distribution == {} and row.orders_per_second == 80.0
