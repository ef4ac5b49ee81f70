"""Small cases with known answers."""

import pytest
from pyspark.sql import functions as F

from bazaarflow.operators import aggregates as A, graph as G, series as Se, setops, stock as St, topk, windows as Wn
from bazaarflow.operators.alerts import VELOCITY_RULES, amount_alerts, velocity_alerts

EVENT = "product_id string, event_id bigint, order_id string, at_us bigint, action string, qty int"


@pytest.fixture(scope="module")
def seed(spark):
    return spark.createDataFrame([("PROD-001", 100), ("PROD-002", 5), ("PROD-003", 0)], "product_id string, initial_stock int")


def stock(spark, seed, events):
    rows = [(p, i, f"O{i}", i, a, q) for i, (p, a, q) in enumerate(events)]
    return St.stock_decisions(spark.createDataFrame(rows, EVENT), seed)


def test_available_stock(spark, seed):
    state = St.final_state(stock(spark, seed, []), seed)
    asked = spark.createDataFrame([("PROD-001",), ("PROD-002",), ("PROD-003",), ("PROD-999",)], "product_id string")
    got = {r.product_id: r.available_stock for r in St.available_stock(asked, state).collect()}
    assert got == {"PROD-001": 100, "PROD-002": 5, "PROD-003": 0, "PROD-999": 0}


def test_reserve(spark, seed):
    decided = stock(spark, seed, [("PROD-001", "order", 10), ("PROD-002", "order", 10), ("PROD-003", "order", 1)])
    got = {r.product_id: (r.approved, r.reason, r.available) for r in St.allocations(decided).collect()}
    assert got["PROD-001"] == (True, "APPROVED", 100)
    assert got["PROD-002"] == (False, "INSUFFICIENT_STOCK", 5)
    assert got["PROD-003"] == (False, "OUT_OF_STOCK", 0)
    left = {r.product_id: r.available_stock for r in St.final_state(decided, seed).collect()}
    assert left["PROD-001"] == 90 and left["PROD-002"] == 5


def test_confirm_sale(spark, seed):
    decided = stock(spark, seed, [("PROD-001", "order", 10), ("PROD-001", "sold", 10)])
    state = {r.product_id: (r.stock, r.reserved, r.available_stock) for r in St.final_state(decided, seed).collect()}
    assert state["PROD-001"] == (90, 0, 90)
    log = [(r.action, r.quantity, r.new_stock) for r in St.change_log(decided).orderBy("event_id").collect()]
    assert log == [("reserved", 10, None), ("sold", 10, 90)]


def test_unknown_product_and_default_quantity(spark, seed):
    decided = stock(spark, seed, [("NEW", "update", 3), ("NEW", "order", None)])
    row = St.allocations(decided).first()
    assert (row.approved, row.requested, row.remaining_after_reserve) == (True, 1, 2)


def test_low_stock(spark, seed):
    state = St.final_state(stock(spark, seed, []), seed)
    got = [(r.product_id, r.alert_level) for r in topk.low_stock(state, threshold=10).collect()]
    assert got == [("PROD-002", "WARNING")]


def test_duplicates(spark):
    ids = spark.createDataFrame([(x,) for x in ("O1", "O2", "O1", "O3", "O2")], "id string")
    assert {r.id for r in A.duplicate_keys(ids, ["id"]).collect()} == {"O1", "O2"}
    assert A.duplicate_keys(ids.limit(0), ["id"]).count() == 0


def pairs(spark, amounts, target):
    df = spark.createDataFrame([(i, float(a)) for i, a in enumerate(amounts)], "pos bigint, amount double")
    return [(r.i, r.j) for r in Se.pair_sum(df, "pos", "amount", target).collect()]


def test_pair_sum(spark):
    assert pairs(spark, [200, 500, 300, 800], "800") == [(1, 2)]
    assert pairs(spark, [100, 200, 300], "999") == []
    assert pairs(spark, [400, 400, 400], "800") == [(0, 1)]
    assert pairs(spark, [400], "800") == []
    # The newest earlier partner counts.
    assert pairs(spark, [100, 100, 5, 700], "800") == [(1, 3)]
    assert pairs(spark, [400, 700, 400, 100], "800") == [(0, 2)]


def sales(spark, rows):
    return spark.createDataFrame(rows, "seller string, amount decimal(18,2)")


def test_top_sellers(spark):
    from decimal import Decimal as D

    df = sales(spark, [("S1", D(1000)), ("S2", D(5000)), ("S3", D(3000)), ("S4", D(2000))])
    assert [r.seller for r in topk.top_by_sum(df, "seller", "amount", 3).collect()] == ["S2", "S3", "S4"]
    twice = sales(spark, [("S1", D(1000)), ("S1", D(2000))])
    assert topk.top_by_sum(twice, "seller", "amount", 3).first().total == 3000.0
    assert topk.top_by_sum(df.limit(0), "seller", "amount", 3).count() == 0


def test_kth_largest(spark):
    df = spark.createDataFrame([(float(x),) for x in (3000, 1500, 8000, 500, 12000, 2500)], "v double")
    assert [topk.kth_largest(df, "v", k).first()[0] for k in (1, 2, 3, 99)] == [12000, 8000, 3000, 500]


def test_most_frequent(spark):
    df = spark.createDataFrame([(x,) for x in ["purchase"] * 3 + ["view"] * 2 + ["cart"]], "e string")
    assert [r.e for r in topk.top_by_count(df, "e", 2).collect()] == ["purchase", "view"]


def clicks(spark, rows):
    """(seller, second) orders."""
    data = [(s, i, int(t * 1_000_000)) for i, (s, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "seller_id string, event_id bigint, us bigint")
    return df.select("seller_id", "event_id", F.timestamp_micros("us").alias("ts"), F.lit(1).cast("decimal(18,2)").alias("amount_inr"))


def last_count(spark, rows):
    from bazaarflow.operators.alerts import trailing_counts

    out = trailing_counts(clicks(spark, rows), VELOCITY_RULES[:1])
    return {r.seller_id: r.n for r in out.groupBy("seller_id").agg(F.max_by("n_VELOCITY_1MIN", "event_id").alias("n")).collect()}


def test_window_counts(spark):
    base = 1_000_000.0
    assert last_count(spark, [("S", base + i) for i in range(5)])["S"] == 5
    assert last_count(spark, [("S", base - 120)] * 10 + [("S", base)])["S"] == 1
    # The window is closed: an event exactly 60 seconds old still counts.
    assert last_count(spark, [("S", base - 60), ("S", base)])["S"] == 2
    assert last_count(spark, [("A", base), ("A", base + 1), ("B", base + 2)]) == {"A": 2, "B": 1}


def test_velocity(spark):
    base = 1_000_000.0
    hot = velocity_alerts(clicks(spark, [("S", base + i * 0.1) for i in range(35)])).collect()
    assert len(hot) == 5 and {a.alert_type for a in hot} == {"VELOCITY_1MIN"}
    assert hot[0].severity == "HIGH" and hot[0].action_recommended == "FLAG_FOR_REVIEW"
    assert velocity_alerts(clicks(spark, [("S", base + i) for i in range(10)])).count() == 0


def test_first_baseline_never_fires(spark):
    rows = [("S", i, i * 1_000_000, float(a)) for i, a in enumerate([1, 1, 1, 1, 1000, 1000, 1, 20000])]
    df = spark.createDataFrame(rows, "seller_id string, event_id bigint, us bigint, a double").select(
        "seller_id", "event_id", F.timestamp_micros("us").alias("ts"), F.col("a").cast("decimal(18,2)").alias("amount_inr")
    )
    got = [(r.event_id, r.alert_type, r.severity) for r in amount_alerts(df).collect()]
    assert got == [(7, "AMOUNT_ANOMALY", "MEDIUM")]


def series(spark, values):
    return spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(values)], "k string, pos bigint, v double")


def test_streak_and_rolling(spark):
    assert Wn.longest_streak(series(spark, [10, 5, 8, 12, 15, 3, 9, 11]), "k", "pos", "v", 7).first()[1] == 3
    assert Wn.longest_streak(series(spark, [1, 2]), "k", "pos", "v", 7).first()[1] == 0
    got = Wn.rolling_average(series(spark, [100, 200, 300, 400, 500]), "k", "pos", "v", 3).orderBy("pos").collect()
    assert [r.rolling_avg for r in got] == [100, 150, 200, 300, 400]


def edges(spark, pairs_):
    return spark.createDataFrame(pairs_, "src string, dst string")


def test_topological_levels(spark):
    chain = edges(spark, [("A", "B"), ("B", "C"), ("C", "D")])
    got = {r.node: (r.level, r.place) for r in G.topo_order(G.topo_levels(chain)).collect()}
    assert got == {"A": (0, 0), "B": (1, 1), "C": (2, 2), "D": (3, 3)}
    assert G.graph_check(chain).first().valid
    loop = edges(spark, [("A", "B"), ("B", "C"), ("C", "A"), ("X", "A"), ("X", "Y")])
    assert tuple(G.graph_check(loop).first()) == (5, 2, False)
    none = edges(spark, []).limit(0)
    nodes = spark.createDataFrame([("A",), ("B",)], "node string")
    assert G.graph_check(none, nodes).first().valid
    # A repeated edge counts twice on both sides.
    assert G.graph_check(edges(spark, [("A", "B"), ("A", "B")])).first().valid


def test_prerequisites(spark):
    def check(pairs_):
        df = spark.createDataFrame(pairs_, "task bigint, prerequisite bigint")
        return G.can_complete(df).first().valid

    assert check([(1, 0), (2, 1), (3, 2)])
    assert not check([(1, 0), (0, 1)])


def merged(spark, lists):
    frames = [
        spark.createDataFrame([(float(v), i) for i, v in enumerate(x)], "value double, pos bigint") for x in lists
    ]
    out = setops.merge_sorted(frames).orderBy("merged_pos").collect()
    assert [r.merged_pos for r in out] == list(range(len(out)))
    return [(r.value, r.source) for r in out]


def test_merges(spark):
    assert [v for v, _ in merged(spark, [[1, 3, 5], [2, 4, 6]])] == [1, 2, 3, 4, 5, 6]
    four = [[1, 5, 9], [2, 6, 10], [3, 7, 11], [4, 8, 12]]
    assert [v for v, _ in merged(spark, four)] == list(range(1, 13))
    assert [v for v, _ in merged(spark, [[1, 2], [], [3]])] == [1, 2, 3]
    assert [v for v, _ in merged(spark, [[1, 2, 3]])] == [1, 2, 3]
    assert merged(spark, [[1, 2], [1, 2]]) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_random_merges(spark):
    import random

    rnd = random.Random(1)
    lists = [sorted(rnd.random() for _ in range(20)) for _ in range(5)]
    assert [v for v, _ in merged(spark, lists)] == sorted(v for x in lists for v in x)


@pytest.mark.parametrize(
    "values, threshold, want",
    [([100, 150, 200, 250, 300, 350], 220, 3), ([100, 150, 200], 500, -1), ([300, 400, 500], 100, 0)],
)
def test_first_breach(spark, values, threshold, want):
    assert Se.first_breach(series(spark, values), "k", "pos", "v", threshold).first()[1] == want


@pytest.mark.parametrize("values, target, want", [([1, 3, 5, 7, 9], 5, 2), ([1, 3, 5, 7, 9], 1, 0), ([1, 3, 5, 7, 9], 9, 4), ([1, 3, 5], 4, -1)])
def test_position_of(spark, values, target, want):
    assert Se.position_of(series(spark, values), "k", "pos", "v", target).first()[1] == want


@pytest.mark.parametrize("width", [1, 2, 3, 1000])
@pytest.mark.parametrize("hours, limit, want", [([3, 6, 7, 11], 8, 4), ([10], 10, 1), ([30, 11, 23, 4, 20], 6, 23), ([5, 5], 1, 5)])
def test_min_batch_size(spark, hours, limit, want, width):
    df = spark.createDataFrame([(h,) for h in hours], "n bigint")
    assert Se.min_batch_size(df, "n", limit, width).first()[0] == want


def test_peak(spark):
    got = Wn.local_peaks(series(spark, [1, 3, 7, 12, 8, 4, 2]), "k", "pos", "v").collect()
    assert [r.pos for r in got] == [3]
