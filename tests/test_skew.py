"""Heavy keys are cut into chunks; results must not depend on it."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from bazaarflow.operators import alerts as Al, stock as St, windows as Wn
from bazaarflow.operators.ordered import CHUNK, SkewPolicy, hot_keys, position, running, with_chunks
from bazaarflow.operators.ranks import global_dense_rank, global_percent_rank
from bazaarflow.plans.fraud_patterns import geo_impossible

CUT = SkewPolicy(max_group_rows=20, max_chunks=7)
PLAIN = SkewPolicy()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, a third of those at the same instant; a null key too."""
    rnd = random.Random(7)
    data = []
    for i in range(1500):
        key = 1 if i % 3 == 0 else (None if i % 50 == 1 else rnd.randrange(2, 40))
        at = 5_000_000 if key == 1 and i % 9 == 0 else rnd.randrange(0, 10_000_000)
        data.append((key, at, i, rnd.choice("abc"), rnd.randrange(1, 6)))
    return spark.createDataFrame(data, "key bigint, at_us bigint, id bigint, city string, v bigint").persist()


def test_all_hot_keys_are_found_and_cut(skewed):
    heavy = rows(skewed.groupBy("key").count().filter("count > 20"))
    assert rows(hot_keys(skewed, ["key"], CUT)) == heavy and len(heavy) > 10
    assert hot_keys(skewed, ["key"], PLAIN).isEmpty()
    chunked, _ = with_chunks(skewed, ["key"], ["at_us", "id"], CUT)
    assert chunked.filter(f"{CHUNK} >= 0").groupBy("key", CHUNK).count().agg(F.max("count")).first()[0] <= 5
    assert {r[0] for r in rows(chunked.filter(f"{CHUNK} < 0").select("key").distinct())}.isdisjoint(k for k, _ in heavy)


@pytest.mark.parametrize("policy", [PLAIN, CUT, SkewPolicy(1, 3)])
def test_running_equals_window(skewed, policy):
    order = ["at_us", "id"]
    w = W.partitionBy("key").orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    odd = F.when(F.col("v") == 3, F.col("id"))
    want = skewed.select(
        "id", F.sum("v").over(upto), F.lag("city").over(w), F.last(odd, ignorenulls=True).over(upto)
    )
    got = running(
        skewed, ["key"], order, sums={"s": F.col("v")}, previous={"p": "city"}, latest={"l": odd}, policy=policy
    ).select("id", "s", "p", "l")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("order", [["at_us", "id"], ["one", "at_us", "id"], ["one", "two", "id"]])
def test_no_chunk_holds_the_heavy_key(skewed, order):
    """Also when many rows, or all, are equal in the first order columns."""
    df = skewed.withColumns({"one": F.lit(1), "two": F.lit(2)})
    chunked, cut = with_chunks(df, ["key"], order, SkewPolicy(max_group_rows=300))
    sizes = chunked.filter("key = 1").groupBy(CHUNK).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("a"))
    assert cut
    # 500 rows in 7 chunks of about 75.
    assert sizes.agg(F.max("n")).first()[0] <= 150
    firsts = [r.a for r in sizes.orderBy(CHUNK).collect()]
    assert firsts == sorted(firsts)


def test_global_position(skewed):
    got = position(skewed, [], ["at_us", "id"], cut_all=True).orderBy("at_us", "id").select("pos").collect()
    assert [r.pos for r in got] == list(range(1500))


@pytest.mark.parametrize("policy", [PLAIN, CUT])
def test_trailing_window_equals_queue(skewed, policy):
    out = Wn.trailing_window(skewed, ["key"], "at_us", "id", {"w": 300_000, "x": 1_000_000}, "v", policy)
    got = {r.id: (r.n_w, r.sum_w, r.n_x, r.sum_x) for r in out.collect()}
    queues, want = {}, {}
    for r in sorted(skewed.collect(), key=lambda r: (r.at_us, r.id)):
        q = queues.setdefault(r.key, [])
        q.append((r.at_us, r.v))
        w = [v for t, v in q if t >= r.at_us - 300_000]
        x = [v for t, v in q if t >= r.at_us - 1_000_000]
        want[r.id] = (len(w), sum(w), len(x), sum(x))
    assert got == want


@pytest.mark.parametrize("policy", [PLAIN, CUT])
def test_sessions(skewed, policy):
    some = skewed.filter("key is not null")
    got = rows(Wn.sessions(some, "key", "at_us", "id", "v", 200_000, policy))
    assert got == rows(Wn.sessions(some, "key", "at_us", "id", "v", 200_000, PLAIN))
    assert sum(r[4] for r in got) == some.count()


def test_amount_baselines_do_not_depend_on_blocks(spark):
    rnd = random.Random(3)
    data = [(1 if i % 3 else 2, i, i * 1_000, rnd.randrange(1, 100_000) / 100) for i in range(6000)]
    orders = spark.createDataFrame(data, "seller_id bigint, event_id bigint, us bigint, a double").select(
        "seller_id", "event_id", F.timestamp_micros("us").alias("ts"), F.col("a").cast("decimal(18,2)").alias("amount_inr")
    )
    rule = Al.AmountRule()
    cols = ["event_id", "amount", "baseline"]
    plain = rows(Al.amount_baselines(orders, rule).select(cols))
    cut = rows(Al.amount_baselines(orders, rule, policy=SkewPolicy(1200, 5)).select(cols))
    assert len(plain) == 5992
    assert cut == plain


@pytest.mark.parametrize("price", [100.0, 349.0, 99.9, 12.34])
def test_constant_prices_give_one_baseline_under_any_policy(spark, price):
    """A constant price has several fixed points in double arithmetic."""
    data = [(1, i, i * 1_000, 5000.0 if i < 20 else price) for i in range(6000)]
    orders = spark.createDataFrame(data, "seller_id bigint, event_id bigint, us bigint, a double").select(
        "seller_id", "event_id", F.timestamp_micros("us").alias("ts"), F.col("a").cast("decimal(18,2)").alias("amount_inr")
    )
    rule = Al.AmountRule(window_seconds=1)
    plain = rows(Al.amount_baselines(orders, rule).select("event_id", "baseline"))
    assert rows(Al.amount_baselines(orders, rule, policy=SkewPolicy(1200, 5)).select("event_id", "baseline")) == plain
    level, want = None, []
    for i in range(6000):
        amount = data[i][3]
        if i >= 4:
            level = sum(d[3] for d in data[: i + 1]) / (i + 1) if level is None else level
            want.append((i, level))
            level = rule.keep * level + rule.gain * amount
    assert plain == sorted(want, key=repr)


@pytest.mark.parametrize("keep", [0.0, 1.0, -0.5])
def test_a_baseline_must_forget(keep):
    with pytest.raises(ValueError):
        Al.AmountRule(keep=keep)


@pytest.mark.parametrize("policy", [PLAIN, CUT])
def test_stock_equals_sequential_store(spark, policy):
    rnd = random.Random(11)
    events, seed = [], {p: rnd.randrange(0, 60) for p in range(6)}
    for i in range(1200):
        p = 0 if i % 3 == 0 else (None if i % 7 == 0 else rnd.randrange(0, 8))
        action = rnd.choices(["order", "sold", "update", "other"], [6, 3, 1, 1])[0]
        qty = rnd.randrange(0, 80) if action == "update" else rnd.randrange(1, 7)
        events.append((p, i, f"O{i}", i // 2, action, qty))
    df = spark.createDataFrame(events, "product_id bigint, event_id bigint, order_id string, at_us bigint, action string, qty int")
    seeds = spark.createDataFrame(list(seed.items()), "product_id bigint, initial_stock int")
    stock, reserved, want = dict(seed), {}, {}
    for p, i, _, _, action, q in events:
        s, r = stock.get(p, 0), reserved.get(p, 0)
        free = max(0, s - r)
        reason = None
        if action == "order":
            reason = "OUT_OF_STOCK" if free <= 0 else "INSUFFICIENT_STOCK" if free < q else "APPROVED"
            if reason == "APPROVED":
                reserved[p] = r + q
        elif action == "sold":
            stock[p], reserved[p] = max(0, s - q), max(0, r - q)
        elif action == "update":
            stock[p] = q
        want[i] = (reason, free, stock.get(p, 0), reserved.get(p, 0))
    decided = St.stock_decisions(df, seeds, policy)
    got = {r.event_id: (r.reason, r.available, r.stock_after, r.reserved_after) for r in decided.collect()}
    assert got == want
    final = {r.product_id: (r.stock, r.reserved) for r in St.final_state(decided, seeds).collect()}
    assert final == {p: (stock.get(p, 0), reserved.get(p, 0)) for p in set(stock) | {e[0] for e in events}}


def test_baselines_with_missing_sellers_and_amounts(spark):
    data = [(None if i % 2 else 9_007_199_254_740_993, i, i * 1_000, None if i == 20 else 10.0) for i in range(40)]
    orders = spark.createDataFrame(data, "seller_id bigint, event_id bigint, us bigint, a double").select(
        "seller_id", "event_id", F.timestamp_micros("us").alias("ts"), F.col("a").cast("decimal(18,2)").alias("amount_inr")
    )
    got = {r.event_id: (r.seller_id, r.baseline) for r in Al.amount_baselines(orders).collect()}
    assert len(got) == 32
    assert got[21] == (None, 10.0) and got[20] == (9_007_199_254_740_993, 10.0)
    # The missing amount counts as zero.
    assert got[22][1] == 9.0


@pytest.mark.parametrize("policy", [PLAIN, CUT])
def test_longest_streak(spark, policy):
    rnd = random.Random(5)
    data = [(k, p, rnd.randrange(0, 4)) for k in "ab" for p in range(300 if k == "a" else 30)]
    df = spark.createDataFrame(data, "k string, pos bigint, n bigint")
    want = {}
    for k in "ab":
        best = run = 0
        for _, _, n in sorted(d for d in data if d[0] == k):
            run = run + 1 if n >= 1 else 0
            best = max(best, run)
        want[k] = best
    assert dict(map(tuple, Wn.longest_streak(df, "k", "pos", "n", 1, policy).collect())) == want


@pytest.mark.parametrize("block", [8, 1_000_000])
def test_blocks_of_positions(spark, block):
    rnd = random.Random(9)
    data = [("a", p, rnd.randrange(0, 50)) for p in range(100)]
    df = spark.createDataFrame(data, "k string, pos bigint, n bigint")
    values = [d[2] for d in data]
    got = Wn.rolling_average(df, "k", "pos", "n", 5, block=block).orderBy("pos").collect()
    assert len(got) == 100
    for p, r in enumerate(got):
        part = values[max(0, p - 4) : p + 1]
        assert abs(r.rolling_avg - sum(part) / len(part)) < 0.006
    peaks = [
        p
        for p in range(100)
        if (p == 0 or values[p - 1] <= values[p]) and (p == 99 or values[p + 1] < values[p])
    ]
    assert [r.pos for r in Wn.local_peaks(df, "k", "pos", "n", block=block).orderBy("pos").collect()] == peaks


@pytest.mark.parametrize("policy", [PLAIN, CUT])
def test_geo_impossible(skewed, policy):
    events = skewed.filter("key is not null").withColumn("ts", F.timestamp_micros("at_us"))
    got = rows(geo_impossible(events, "key", "city", "ts", "id", minutes=0.001, policy=policy))
    assert got == rows(geo_impossible(events, "key", "city", "ts", "id", minutes=0.001)) and got


@pytest.mark.parametrize("width", [2, 3, 50])
def test_global_ranks_with_ties_and_nulls(spark, width):
    rnd = random.Random(width)
    data = [(i, None if i % 17 == 0 else rnd.randrange(0, 12) / 4) for i in range(200)]
    df = spark.createDataFrame(data, "id bigint, v double")
    policy = SkewPolicy(max_group_rows=4 * width, max_chunks=width)
    plain = Wn.W.orderBy(F.col("v").asc_nulls_first())
    want = rows(df.select("id", F.percent_rank().over(plain)))
    assert rows(global_percent_rank(df, "id", {"r": "v"}, policy).select("id", "r")) == want
    some = df.filter("v is not null")
    dense = rows(some.select("id", "v", F.dense_rank().over(W.orderBy(F.desc("v"))).cast("bigint")))
    assert rows(global_dense_rank(some, "v", "d", True, policy).select("id", "v", "d")) == dense


def test_one_row_ranks_zero(spark):
    one = spark.createDataFrame([(1, 5.0)], "id bigint, v double")
    assert global_percent_rank(one, "id", {"r": "v"}).first().r == 0.0
