"""Sharding against a plain version, and the law of the keys."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from bazaarflow.llm import sharding
from bazaarflow.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, source string"


def draw(key, shard, weight=1.0):
    u = (int(hashlib.md5(f"{key}@{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return -weight / math.log(u)


def home(doc_id, weights):
    key = "-" if doc_id is None else f"{len(str(doc_id))}:{doc_id}"
    return max(range(len(weights)), key=lambda i: (draw(key, i, weights[i]), -i))


def checked(found, rows, weights, new_weight=1.0):
    """``found`` holds each of ``rows`` at the shard that a plain version names, with slots from 0 in every shard."""
    want = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        want[(doc_id, len(data) + 8, zlib.crc32(data), home(doc_id, weights), home(doc_id, [*weights, new_weight]))] += 1
    got = found.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert {r.law for r in got} <= {"key"}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_registered_query_equals_a_plain_version(spark, root):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    got = checked(QUERIES["op13_sharding"](spark, root), rows, [1.0] * 24)
    assert all(r.grown_shard in (r.shard, 24) for r in got)
    again = QUERIES["op13_sharding"](spark, root).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_edges_and_repeated_rows(spark):
    rows = [(None, None), (None, ""), (1, None), (1, "ü€𝄞"), (2, "a" * 300_000), (-7, "x\x00y")] + [(3, "same")] * 2500 + [(3, f"t{i}") for i in range(3000)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA)
    checked(sharding.placed(docs, shards=5), rows, [1.0] * 5)
    checked(sharding.placed(docs, shards=1), rows, [1.0])
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("size", "slot", "shard", "place", "part", "n", "law", "text_crc32", "best", "piece", "held")])
    checked(sharding.placed(clash, shards=3), rows, [1.0] * 3)
    assert sharding.placed(docs.limit(0)).collect() == []


def test_many_ranges_count_on(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 16)
    monkeypatch.setattr(sharding, "COPIES", 8)
    rows = [(i % 700, f"text {i % 900}") for i in range(3000)] + [(5, "hot")] * 1500
    docs = spark.createDataFrame([(*r, "s") for r in rows], SCHEMA)
    checked(sharding.placed(docs, shards=7), rows, [1.0] * 7)


def test_shares_follow_weights_and_growth_moves_only_into_the_new_shard(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    weights = [1.0, 2.0, 5.0]
    counts = {r.shard: r.n_rows for r in sharding.shard_report(sharding.placed(docs, shards=3, weights=weights)).collect()}
    assert all(abs(counts[i] / 40_000 - w / 8) < 0.01 for i, w in enumerate(weights))
    wide = sharding.placed(docs, shards=10, new_weight=2.0)
    moved = wide.filter("grown_shard <> shard")
    assert {r.grown_shard for r in moved.select("grown_shard").distinct().collect()} == {10}
    assert abs(moved.count() / 40_000 - 2 / 12) < 0.01
    # What is named for one more shard is what that shard count gives; losing the last shard moves its rows alone.
    more = sharding.sharded(docs, shards=11, weights=[1.0] * 10 + [2.0])
    assert wide.join(more.select("doc_id", F.col("shard").alias("later")), "doc_id").filter("grown_shard <> later").count() == 0


def test_rows_keep_their_columns_and_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", "s", "old") for i in range(300)], SCHEMA + ", shard string")
    found = sharding.sharded(docs, shards=4)
    assert found.columns == docs.columns and {r.shard for r in found.collect()} == {0, 1, 2, 3}
    assert "Exchange" not in found._jdf.queryExecution().toString()
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, shards=4)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((r.doc_id, r.text, r.shard) for r in found.collect())
    pair = sharding.sharded(docs, key_cols=["source", "doc_id"], shards=4)
    assert {r.shard for r in pair.collect()} == {0, 1, 2, 3}
