"""Sources, sinks and the daily run."""

import pytest
from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.plans.health import escalation, freshness, outputs_exist, topic_health
from bazaarflow.plans.run_daily import ValidationFailed, run_daily
from bazaarflow.session import materialize, shared_dir
from bazaarflow.sources import events as Ev, lake as Lk, warehouse as Wh


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5))
    assert df.count() == 5 and spark.sparkContext.getCheckpointDir().startswith("file:" + shared_dir(spark))


def test_topics_need_a_kafka_source(spark):
    """The connector is not on this machine; the options are those of the public source."""
    source = Ev.Topics("broker:9092", ("orders", "inventory"), "earliest", max_per_trigger=1000)
    with pytest.raises(Exception, match="(?i)kafka"):
        Ev.read_events(spark, source)


def test_broken_lines_are_kept(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"event_id": 1, "city": "Surat"}',), ("{oops",)], "value string").write.text(path)
    rows = {r.event_id: (r.city, r._broken) for r in Ev.read_event_files(spark, path).collect()}
    assert rows == {1: ("Surat", None), None: (None, "{oops")}


def test_lake_repeats_replace_their_own_files(spark, root, tmp_path):
    path = str(tmp_path / "bronze")
    events = B.events_fact(spark, root)
    half = events.filter("event_id % 2 = 0")
    Lk.archive_batch(half, 0, path)
    Lk.archive_batch(events.filter("event_id % 2 = 1"), 1, path)
    Lk.archive_batch(half, 0, path)
    lake = Lk.read_lake(spark, path)
    assert lake.count() == events.count()
    assert lake.select("month").first().month == "01"
    found = Lk.lake_inventory(spark, path)
    assert found.agg(F.sum("events")).first()[0] == events.count()
    assert {r.zone for r in Lk.archive_counters(found).collect()} == {"orders", "inventory", "fraud_signals"}


def test_lake_drops_other_kinds(spark, root, tmp_path):
    events = B.events_fact(spark, root)
    other = events.withColumn("event_type", F.lit("something_else"))
    assert Lk.route_by_type(events.unionAll(other)).count() == events.count()


def test_columns_that_collide(spark):
    with pytest.raises(ValueError, match="a_b"):
        Wh.normalize_columns(spark.createDataFrame([(1, 2)], ["A b", "a-B"]))


def test_warehouse_statuses(spark, tmp_path):
    marts, out = str(tmp_path / "marts"), str(tmp_path / "out")
    spark.createDataFrame([(1, [1, 2])], "`Day Of` int, hours array<int>").write.parquet(f"{marts}/daily_revenue")
    spark.createDataFrame([(1, 2)], ["A b", "a_b"]).write.parquet(f"{marts}/fraud_patterns")
    got = {r.table: r.status for r in Wh.load_warehouse(spark, marts, out).collect()}
    assert got["mart_daily_revenue"] == "SUCCESS" and got["mart_cohort_retention"] == "SKIPPED"
    assert got["mart_fraud_patterns"].startswith("ERROR: columns collide")
    loaded = spark.read.parquet(f"{out}/mart_daily_revenue")
    assert loaded.columns == ["day_of", "hours"] and loaded.first().hours == "[1,2]"
    again = {r.table: r.status for r in Wh.load_warehouse(spark, marts, out, mode="append").collect()}
    assert again["mart_daily_revenue"] == "SUCCESS"
    assert spark.read.parquet(f"{out}/mart_daily_revenue").count() == 2
    assert {r.table: r.status for r in Wh.load_warehouse(spark, marts, out, mode="error").collect()}["mart_daily_revenue"] == "FAILED"


def test_missing_mart(spark, tmp_path):
    with pytest.raises(Wh.MartNotFound):
        Wh.read_mart(spark, str(tmp_path / "nothing"))


def test_daily_run(spark, root, tmp_path):
    out = str(tmp_path / "marts")
    done = run_daily(spark, B.orders_fact(spark, root), out)
    assert done.filter("not passed").count() == 0 and done.count() == 5
    bad = B.orders_fact(spark, root).withColumn("order_id", F.lit("same"))
    with pytest.raises(ValidationFailed, match="duplicate keys"):
        run_daily(spark, bad, str(tmp_path / "bad"))
    missing = outputs_exist(spark, str(tmp_path / "bad"))
    assert missing.filter("present").count() == 0


def test_health_of_silent_and_stale_topics(spark, root):
    orders = B.events_fact(spark, root).filter("event_type = 'order_placed'")
    got = {r.zone: (r.status, r.events > 0) for r in topic_health(orders, "2024-01-10 00:00:00").collect()}
    assert got == {"orders": ("healthy", True), "inventory": ("silent", False), "fraud_signals": ("silent", False)}
    fresh = {r.zone: r.fresh for r in freshness(orders, "2024-03-01 00:00:00").collect()}
    assert not any(fresh.values())
    found = spark.createDataFrame([("HIGH",)] * 10 + [("LOW",)], "fraud_risk_level string")
    assert escalation(found).first().escalation_required and not escalation(found, 11).first().escalation_required
