"""Answers that earlier fixtures did not reach: nulls, long numbers, mixed files, broken marts, many batches."""

import os

import pytest
from pyspark.sql import functions as F

from bazaarflow.operators.ranks import global_dense_rank, global_percent_rank
from bazaarflow.operators.search import NO_DATA, assemble_context
from bazaarflow.operators.stock import stock_decisions
from bazaarflow.operators.upsert import latest_per_key, upsert
from bazaarflow.operators.windows import trailing_window
from bazaarflow.session import ship_package
from bazaarflow.sources.warehouse import load_warehouse, read_mart
from bazaarflow.streaming.runner import run_bounded


def test_files_with_other_columns_unite_by_name(spark, tmp_path):
    root = f"{tmp_path}/mart"
    spark.createDataFrame([(1, "a")], "id int, name string").write.mode("append").parquet(root)
    spark.createDataFrame([(2, 0.5)], "id int, score double").write.mode("append").parquet(root)
    for k, text in enumerate(["id,name\n3,c\n", "name,id\nd,4\n"]):
        with open(f"{root}/part-{k}.csv", "w") as f:
            f.write(text)
    got = {(r["id"], r["name"], r["score"]) for r in read_mart(spark, root).collect()}
    assert got == {(1, "a", None), (2, None, 0.5), (3, "c", None), (4, "d", None)}


def test_a_broken_mart_does_not_stop_the_load(spark, tmp_path):
    os.makedirs(f"{tmp_path}/marts/bad")
    with open(f"{tmp_path}/marts/bad/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    spark.range(3).write.parquet(f"{tmp_path}/marts/good")
    tables = {"bad": "t_bad", "none": "t_none", "good": "t_good"}
    got = {r.table: r.status for r in load_warehouse(spark, f"{tmp_path}/marts", f"{tmp_path}/out", tables).collect()}
    assert got["t_good"] == "SUCCESS" and got["t_none"] == "SKIPPED" and got["t_bad"].startswith(("ERROR", "FAILED"))
    assert spark.read.parquet(f"{tmp_path}/out/t_good").count() == 3


def test_update_without_a_level_sets_zero(spark):
    events = spark.createDataFrame([(1, 1, "O1", 1, "update", None), (1, 2, "O2", 2, "order", None)], "product_id long, event_id long, order_id string, at_us long, action string, qty int")
    seed = spark.createDataFrame([(1, 50)], "product_id long, initial_stock int")
    got = {r.event_id: r for r in stock_decisions(events, seed).collect()}
    assert got[1].stock_after == 0


def test_ranks_of_long_numbers_and_nulls(spark):
    rows = [(2**53 + k,) for k in (1, 0, 3, 2)] + [(None,)]
    df = spark.createDataFrame(rows, "v bigint")
    up = {r.v: r.p for r in global_dense_rank(df, "v", "p").collect()}
    down = {r.v: r.p for r in global_dense_rank(df, "v", "p", descending=True).collect()}
    assert up == {None: 1, 2**53: 2, 2**53 + 1: 3, 2**53 + 2: 4, 2**53 + 3: 5}
    assert down == {2**53 + 3: 1, 2**53 + 2: 2, 2**53 + 1: 3, 2**53: 4, None: 5}
    share = {r.v: r.p for r in global_percent_rank(df.filter("v is not null"), "v", {"p": "v"}).collect()}
    assert sorted(share.values()) == [0.0, pytest.approx(1 / 3), pytest.approx(2 / 3), 1.0]


def test_null_and_equal_versions(spark):
    delta = spark.createDataFrame([("a", 2, None), ("b", 1, None), ("b", 2, 5), ("c", 1, 7), ("c", 9, 7)], "k string, v int, version int")
    got = {r.k: r.v for r in latest_per_key(delta, ["k"], "version").collect()}
    assert got == {"a": 2, "b": 2, "c": 9}
    base = spark.createDataFrame([("a", 1, 0), ("z", 3, 0)], "k string, v int, version int")
    assert {r.k: r.v for r in upsert(base, delta, ["k"], "version").collect()} == {"a": 2, "b": 2, "c": 9, "z": 3}


def test_trailing_sums_of_doubles_do_not_cancel(spark):
    df = spark.createDataFrame([("k", 1, 1, 1e16), ("k", 5, 2, 0.1), ("k", 20, 3, 0.2)], "key string, at long, id long, v double")
    got = {r.id: r.sum_w for r in trailing_window(df, ["key"], "at", "id", {"w": 10}, value="v").collect()}
    assert got[3] == 0.2 and got[2] == 1e16


def test_every_question_has_a_context(spark):
    hits = spark.createDataFrame([], "query_id int, place int, review_id string, similarity_score double")
    kinds = """review_id string, sentiment string, seller_id long, one_line_summary string, review_text string, rating int,
      sentiment_score double, urgency_level string, requires_action boolean, review_date date, city string,
      primary_category string, suggested_action string, enrichment_success boolean"""
    questions = spark.createDataFrame([(1,), (2,)], "query_id int")
    got = assemble_context(hits, spark.createDataFrame([], kinds), questions=questions).collect()
    assert [(r.query_id, r.context) for r in sorted(got)] == [(1, NO_DATA), (2, NO_DATA)]


def test_a_run_reports_all_of_its_batches(spark, tmp_path):
    for k in range(150):
        with open(f"{tmp_path}/in-{k:03}.json", "w") as f:
            f.write('{"v": 1}\n')
    stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in-*.json")
    got = run_bounded(stream, lambda df, n: None, f"{tmp_path}/checkpoint")
    assert got.count() == 150 and got.filter("drained").count() == 150


def test_the_package_reaches_python_workers(spark):
    ship_package(spark)

    def where(batches):
        import sys

        for b in batches:
            yield b.assign(found=any(p.endswith("bazaarflow.zip") for p in sys.path))

    assert spark.range(1).mapInPandas(where, "id long, found boolean").filter("found").count() == 1
