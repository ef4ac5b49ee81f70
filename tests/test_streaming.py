"""Streams against their batch forms: order, late data, rows without a time, repeated batches, restarts."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import alerts as Al, stock as St
from bazaarflow.plans.dashboard import live_dashboard
from bazaarflow.sources import events as Ev
from bazaarflow.streaming import fraud, keyed
from bazaarflow.streaming.fraud import FraudStream
from bazaarflow.streaming.inventory import InventoryStream
from bazaarflow.streaming.metrics import LiveMetrics
from bazaarflow.streaming.runner import LatestRows, read_output, run_bounded, write_output
from registry.events import AMOUNT, RULES

SHAPE = "event_type string, seller_id bigint, event_id bigint, ts timestamp, amount_inr decimal(18,2)"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def orders(spark, root):
    return B.orders_placed(spark, root).select(*[c.split()[0] for c in SHAPE.split(", ")]).persist()


def days(df, low, high):
    return df.filter((F.dayofmonth("ts") >= low) & (F.dayofmonth("ts") < high))


def feed(spark, path, run, *parts, end=True, schema=SHAPE):
    """One bounded run after each part of the input, and one after the end of the stream."""
    source = Ev.JsonFiles(str(path / "topic"))
    for part in parts:
        Ev.write_events(part, source)
        run(spark.readStream.schema(schema).json(source.path))
    if end:
        Ev.end_stream(spark, source)
        run(spark.readStream.schema(schema).json(source.path))


def job_of(spark, path, **given):
    return FraudStream(spark, str(path / "job"), **({"rules": RULES, "amount_rule": AMOUNT} | given))


ALERT = ["alert_id", "seller_id", "event_id", "alert_type", "evidence"]


def test_velocity_equals_batch_even_when_out_of_order(spark, orders, tmp_path):
    """Two parts overlap in time; a delay of two days keeps the order. Narrow slices change nothing."""
    job = job_of(spark, tmp_path, delay_seconds=2 * 86_400, slice_seconds=259_200)
    odd = F.col("event_id") % 2 == 1
    middle = days(orders, 10, 12)
    feed(spark, tmp_path, job.run_velocity, days(orders, 1, 10).unionAll(middle.filter(odd)), middle.filter(~odd), days(orders, 12, 32))
    assert rows(job.velocity().select(ALERT)) == rows(Al.velocity_alerts(orders, RULES).select(ALERT))
    assert job.late().count() == 0


def test_amounts_equal_batch(spark, orders, tmp_path):
    job = job_of(spark, tmp_path, delay_seconds=3600)
    feed(spark, tmp_path, job.run_amounts, days(orders, 1, 9), days(orders, 9, 32))
    assert rows(job.amounts().select(ALERT)) == rows(Al.amount_alerts(orders, AMOUNT).select(ALERT))


def test_late_orders_and_those_without_a_time_are_set_aside(spark, orders, tmp_path):
    job = job_of(spark, tmp_path)
    timeless = orders.filter("event_id % 30 = 0").withColumn("ts", F.lit(None).cast("timestamp"))
    other = orders.limit(5).withColumn("event_type", F.lit("inventory_update"))
    on_time, late = days(orders, 10, 20), days(orders, 1, 5)
    feed(spark, tmp_path, job.run_velocity, on_time, late.unionAll(timeless).unionAll(other))
    assert rows(job.late().select("event_id")) == rows(late.unionAll(timeless).select("event_id"))
    assert job.late().filter("at_us is null").count() == timeless.count()
    assert rows(job.velocity().select(ALERT)) == rows(Al.velocity_alerts(on_time, RULES).select(ALERT))


def test_state_of_past_slices_is_gone(spark, orders, tmp_path):
    """After the end of the stream no key holds anything."""
    job = job_of(spark, tmp_path, slice_seconds=259_200)
    feed(spark, tmp_path, job.run_velocity, days(orders, 1, 15), days(orders, 15, 32))
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "job" / "velocity-checkpoint" / "state") for f in names]
    assert files
    # A batch that comes after the end meets a watermark past everything: all late, nothing kept.
    feed(spark, tmp_path, job.run_velocity, orders.limit(3), end=False)
    assert job.late().count() == 3


def test_a_repeated_batch_replaces_its_output(spark, orders, tmp_path):
    path = str(tmp_path / "out")
    for part in (days(orders, 1, 9), days(orders, 1, 3)):
        write_output(part, path, 0)
    assert rows(read_output(spark, path)) == rows(days(orders, 1, 3))
    sink = LatestRows(spark, str(tmp_path / "latest"), ["k"], "k bigint, v bigint", merge_every=2)
    assert sink.read().collect() == []
    want = {}
    for batch in [0, 1, 2, 2, 3, 4, 5, 5, 6]:
        part = {k: batch * 10 + k for k in (batch % 3, 7)}
        sink.write(spark.createDataFrame(list(part.items()), "k bigint, v bigint"), batch)
        want |= part
    assert {r.k: r.v for r in sink.read().collect()} == want


def test_counts_follow_the_order_of_arrival_in_ties():
    first = {"at_us": np.array([5, 5, 5, 9, 20]), "cents": np.array([1, 2, 3, 4, 5])}
    assert fraud._recent(None, first, 4)[1]["n"].tolist() == [1, 2, 3, 4, 1]
    carry, made = fraud._recent(None, first, 100)
    assert made["sum"].tolist() == [1, 3, 6, 10, 15]
    assert fraud._recent(carry, {"at_us": np.array([21]), "cents": np.array([6])}, 100)[1]["sum"].tolist() == [21]


def test_counts_of_many_sellers_at_once():
    draw = np.random.default_rng(3)
    at = np.sort(draw.integers(0, 300, 500))
    rows_ = {"at_us": at, "event_id": np.arange(500), "seller_id": draw.choice([None, "a", "b", "c"], 500), "slice": draw.integers(0, 2, 500)}
    carry, got = None, []
    for low, high in ((0, 200), (200, 201), (201, 500)):
        carry, made = fraud._velocity((9, 1), carry, {n: v[low:high] for n, v in rows_.items()}, {"x": 7, "y": 40})
        got += list(zip(made["event_id"], made["n_x"], made["n_y"]))
    same = lambda i, w: sum(rows_["seller_id"][j] == rows_["seller_id"][i] and at[i] - w <= at[j] for j in range(i + 1))
    assert got == [(i, same(i, 7), same(i, 40)) for i in range(500) if rows_["slice"][i] == 1]


STOCK = "product_id bigint, event_id bigint, order_id string, ts timestamp, action string, qty int"


def test_inventory_stream_equals_batch(spark, root, tmp_path):
    events, seed = B.stock_events(spark, root), B.stock_seed(spark, root)
    job = InventoryStream(spark, str(tmp_path / "job"), seed, delay_seconds=3600)
    timed = events.withColumn("ts", F.timestamp_micros("at_us")).drop("at_us")
    middle = events.agg(F.percentile_approx("at_us", 0.5)).first()[0]
    cut = F.unix_micros("ts") <= middle
    feed(spark, tmp_path, job.run, timed.filter(cut), timed.filter(~cut), schema=STOCK)
    want = St.stock_decisions(events, seed)
    assert rows(St.allocations(job.decisions())) == rows(St.allocations(want))
    assert rows(St.change_log(job.decisions())) == rows(St.change_log(want))
    assert job.late().count() == 0


def test_live_metrics_equal_batch(spark, root, tmp_path):
    events = B.events_fact(spark, root)
    job = LiveMetrics(spark, str(tmp_path / "job"))
    timeless = B.orders_placed(spark, root).limit(0)
    feed(spark, tmp_path, job.run, days(events, 1, 12), days(events, 12, 32).unionAll(timeless.select(*events.columns)), end=False, schema=events.schema)
    last = B.orders_placed(spark, root).agg(F.max("ts").cast("string")).first()[0]
    assert rows(job.dashboard()) == rows(live_dashboard(B.orders_placed(spark, root), last))


def test_rolling_totals_of_the_dashboard(spark, tmp_path):
    def order(second, amount):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
        return ("order_placed", at, "c", "x", "UPI", "tier1", "S1", amount)

    cols = "event_type string, ts timestamp, category string, city string, payment_method string, city_tier string, seller_id string, amount_inr decimal(18,2)"
    job = LiveMetrics(spark, str(tmp_path / "job"))
    make = lambda *r: spark.createDataFrame([(*x[:-1], x[-1]) for x in r], cols.replace("decimal(18,2)", "int"))
    feed(spark, tmp_path, job.run, make(order(0, 100), order(239, 10), order(240, 20)), make(order(300, 5)), end=False, schema=cols)
    got = {r.name: r.value for r in job.dashboard().filter("section = 'rolling'").collect()}
    # Windows are closed: 300 s back still counts for five minutes, 60 s back for one.
    assert got == {"revenue_last_1min": 25.0, "revenue_last_5min": 135.0, "orders_last_1min": 2.0, "avg_order_last_5min": 33.75}


def test_late_rows_carry_the_watermark_they_met(spark, orders, tmp_path):
    out = str(tmp_path / "late")

    def run(stream):
        found = keyed.late_rows(stream, "ts", 60, ["event_id", "amount_inr"], F.col("event_id"))
        run_bounded(found, lambda batch, i: write_output(batch, out, i), str(tmp_path / "checkpoint"))

    timeless = orders.limit(4).withColumn("ts", F.lit(None).cast("timestamp"))
    feed(spark, tmp_path, run, days(orders, 10, 20), days(orders, 1, 5).unionAll(timeless), days(orders, 20, 32), end=False)
    found = read_output(spark, out)
    assert found.count() == days(orders, 10, 32).count() + days(orders, 1, 5).count() + 4
    late = found.filter("late")
    assert late.count() == days(orders, 1, 5).count() + 4
    newest = days(orders, 10, 20).agg(F.max(F.unix_millis("ts"))).first()[0]
    assert {r.watermark_us for r in late.collect()} == {(newest - 60_000) * 1000}
