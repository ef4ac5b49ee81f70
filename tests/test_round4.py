"""Bytes, reads and memory of single tasks: compressed rows, file sizes, distinct counts and stored upserts."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import upsert as U
from bazaarflow.operators.upsert import latest_per_key
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.schemas import ORDERS
from bazaarflow.session import materialize
from bazaarflow.sources import events as Ev
from registry import QUERIES


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_json_rows_are_compressed_in_small_files(spark, root, tmp_path):
    assert all(f.endswith(".json.gz") for f in QUERIES["s12_rows_to_table"](spark, root).inputFiles())
    path, orders = str(tmp_path / "rows"), B.orders_fact(spark, root)
    Ev.write_rows(orders, path, rows_per_file=500)
    back = Ev.read_rows(spark, path, ORDERS)
    assert all(spark.read.text(f).count() <= 500 for f in back.inputFiles())
    assert rows_of(back.select(orders.columns)) == rows_of(orders)


def daily_by_sets(orders):
    """The counts of the daily revenue, from sets."""
    groups = {}
    for r in orders.collect():
        group = groups.setdefault((r.order_date, r.category, r.city_tier, r.is_sale_day), [0, set(), set()])
        group[0] += r.order_id is not None
        group[1] |= {r.customer_id} - {None}
        group[2] |= {r.seller_id} - {None}
    return {k: (n, len(customers), len(sellers)) for k, (n, customers, sellers) in groups.items()}


def test_daily_revenue_counts_without_copies_of_rows(spark, root):
    """Repeated rows, nulls in every counted column and in the keys; no row enters an aggregate once per count."""
    orders = B.orders_fact(spark, root).withColumn("order_date", F.expr("date_trunc('year', order_date)").cast("date"))
    for name, every in (("customer_id", 3), ("seller_id", 5), ("order_id", 7), ("category", 11)):
        orders = orders.withColumn(name, F.when(F.pmod(F.xxhash64("order_id", F.lit(name)), F.lit(every)) != 0, F.col(name)))
    orders = spark.createDataFrame(orders.unionAll(orders.limit(2000)).collect(), orders.schema)
    daily = daily_revenue(orders)
    assert "Expand" not in daily._jdf.queryExecution().executedPlan().toString()
    keys = ["order_date", "category", "city_tier", "is_sale_day"]
    got = {tuple(r[k] for k in keys): (r.order_count, r.unique_customers, r.active_sellers) for r in daily.collect()}
    assert got == daily_by_sets(orders)


def test_files_of_a_stream_grow_in_number(spark, tmp_path):
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    assert Ev.write_for_stream(spark.range(100), few, rows_per_file=1000) == 2
    assert Ev.write_for_stream(spark.range(10_000), many, rows_per_file=1000) == 5
    assert Ev.write_for_stream(spark.range(0), str(tmp_path / "none"), rows_per_file=1000) == 2
    assert len(spark.read.parquet(few).inputFiles()) == 4
    sizes = [spark.read.parquet(f).count() for f in spark.read.parquet(many).inputFiles()]
    assert len(sizes) == 10 and sum(sizes) == 10_000 and max(sizes) <= 1100


def merged(table, delta):
    """Stored rows (a, b, v, version) after a delta: the last of each key enters, its like leaves; a null equals no other key."""
    last = {}
    for row in delta:
        # A version of null is the oldest; ties go by the text.
        place = (row[3] is not None, row[3] or 0, row[2])
        if row[:2] not in last or place > last[row[:2]][0]:
            last[row[:2]] = (place, row)
    kept = [r for r in table if r[:2] not in last or None in r[:2]]
    return kept + [row for _, row in last.values()]


def test_stored_upserts_deal_rows_once(spark, tmp_path, monkeypatch):
    """Nulls in keys and versions, repeated keys and ties; a delta of different keys is stored once and not grouped by rows."""
    path, cols, calls = str(tmp_path / "table"), "a bigint, b string, v string, version int", []
    monkeypatch.setattr(U, "materialize", lambda df: calls.append("stored") or materialize(df))
    monkeypatch.setattr(U, "latest_per_key", lambda *x, **ties: calls.append(ties["ties"]) or latest_per_key(*x, **ties))
    base = [(k % 50, f"b{k // 50}", f"v{k}", 0) for k in range(500)] + [(None, "x", "n0", 0), (7, None, "n1", 0), (None, None, "n2", None)]
    unique = [(3, "b1", "new", 1), (None, "x", "n3", 1), (7, None, "n4", 1), (900, "b1", "added", None)]
    repeated = [(3, "b1", "mid", 2), (3, "b1", "last", 3), (4, "b2", "u", None), (4, "b2", "w", 0), (None, None, "n5", 1), (None, None, "n6", 2)]
    tied = [(5, "b0", "p", 4), (5, "b0", "q", 4), (5, "b0", "z", 3), (None, "x", "n7", 2), (None, "x", "n8", 2)]
    want, steps = [], []
    for delta in (base, unique, repeated, tied):
        calls.clear()
        U.upsert_into(path, spark.createDataFrame(delta, cols), ["a", "b"], "version", buckets=4)
        want = merged(want, delta)
        steps.append(list(calls))
        assert sorted(map(repr, map(tuple, U.read_table(spark, path).select("a", "b", "v", "version").collect()))) == sorted(map(repr, want))
    assert steps == [["stored"], ["stored"], ["stored", False, "stored"], ["stored", True, "stored"]]


def test_json_breaks_ties_only(spark):
    delta = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, version int")
    once = latest_per_key(delta, ["k"], "version", ties=False)
    assert "to_json" not in once._jdf.queryExecution().optimizedPlan().toString() and once.first().v == "b"
