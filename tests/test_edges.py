"""Empty inputs, single rows, nulls, ties, zero denominators."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from bazaarflow.functions import numeric as N, text as Tx
from bazaarflow.operators import aggregates as A, reviews as R, search as S, upsert as U
from bazaarflow.plans import dashboard, quality, reports
from bazaarflow.plans.category_trends import category_trends, trend
from bazaarflow.plans.cohort_retention import cohort_retention
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.plans.fraud_patterns import collusion_pairs, fraud_patterns
from bazaarflow.plans.seller_performance import seller_performance
from bazaarflow.schemas import ORDERS


def order(n, **kw):
    row = dict(
        order_id=f"O{n}",
        seller_id=1,
        customer_id=1,
        product_id=1,
        category="Kids",
        subcategory="x",
        amount_inr=D("100.00"),
        quantity=1,
        payment_method="UPI",
        city="Surat",
        state="Gujarat",
        city_tier="tier2",
        order_date=dt.date(2024, 1, 1),
        order_hour=3,
        is_sale_day=False,
        device_type="android",
    )
    return tuple((row | kw)[f.name] for f in ORDERS.fields)


@pytest.fixture(scope="module")
def orders(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), ORDERS)

    return make


def test_empty_orders(orders):
    none = orders()
    for mart in (daily_revenue, cohort_retention, fraud_patterns, category_trends, seller_performance):
        assert mart(none).count() == 0
    assert collusion_pairs(none).count() == 0
    report = quality.quality_report(none, "orders", ["order_id"], ["order_id"], {"amount_inr": (0, 10)})
    assert [r.check for r in report.filter("not passed").collect()] == ["not_empty"]


def test_one_order(orders):
    one = orders(order(1))
    day = daily_revenue(one).first()
    assert (day.total_revenue, day.order_count, day.upi_share_pct, day.revenue_per_customer) == (100.0, 1, 100.0, 100.0)
    seller = seller_performance(one).first()
    assert (seller.performance_score, seller.seller_tier, seller["rank"]) == (0.0, "BRONZE", 1)
    fraud = fraud_patterns(one).first()
    assert (fraud.round_number_rate, fraud.off_hours_rate, fraud.fraud_risk_level) == (1.0, 1.0, "HIGH")
    assert fraud.active_hours == [3]


def test_zero_revenue_has_no_share(orders):
    day = daily_revenue(orders(order(1, amount_inr=D("0.00")))).first()
    assert day.upi_share_pct is None and day.revenue_per_customer == 0.0


def test_trend_labels(spark):
    values = [(25.0,), (10.0,), (0.5,), (0.0,), (-9.99,), (-10.0,), (None,)]
    got = [r.t for r in spark.createDataFrame(values, "p double").select(trend("p").alias("t")).collect()]
    assert got == ["GROWING_FAST", "GROWING", "GROWING", "DECLINING", "DECLINING", "DECLINING_FAST", "BASELINE"]


def test_previous_week_skips_gaps_and_zero(orders):
    weeks = [dt.date(2024, 1, 1), dt.date(2024, 1, 22), dt.date(2024, 1, 29)]
    amounts = [D("0.00"), D("50.00"), D("75.00")]
    rows = [order(i, order_date=w, amount_inr=a) for i, (w, a) in enumerate(zip(weeks, amounts))]
    got = [(r.prev_week_revenue, r.revenue_wow_pct, r.trend) for r in category_trends(orders(*rows)).collect()]
    assert got == [(None, None, "BASELINE"), (0.0, None, "BASELINE"), (50.0, 50.0, "GROWING_FAST")]


def test_cohorts(orders):
    d = dt.date
    rows = [
        order(1, customer_id=1, order_date=d(2024, 1, 3)),
        order(2, customer_id=1, order_date=d(2024, 1, 8)),
        order(3, customer_id=1, order_date=d(2024, 1, 9)),
        order(4, customer_id=2, order_date=d(2024, 1, 7)),
    ]
    got = [tuple(r) for r in cohort_retention(orders(*rows)).select("weeks_since_signup", "retained_users", "cohort_size", "retention_rate_pct").collect()]
    assert got == [(0, 2, 2, 100.0), (1, 1, 2, 50.0)]


def test_quality_lists_every_bad_column(orders):
    rows = [order(1, seller_id=None, city=None), order(1, amount_inr=D("-5.00")), order(2, amount_inr=None)]
    report = quality.quality_report(orders(*rows), "orders", ["seller_id", "city", "order_id"], ["order_id"], {"amount_inr": (0, 999999)})
    got = {(r.check, r.column): (r.passed, r.bad_rows) for r in report.collect()}
    assert got[("no_nulls", "seller_id")] == (False, 1) and got[("no_nulls", "city")] == (False, 1)
    assert got[("no_nulls", "order_id")] == (True, 0)
    assert got[("no_duplicates", "order_id")] == (False, 1)
    assert got[("value_range", "amount_inr")] == (False, 1)
    assert not quality.all_passed(report)


def test_rounding(spark):
    values = [1.005, 2.5, -2.5, -0.001, 0.125, None]
    got = [r.r for r in spark.createDataFrame([(v,) for v in values], "v double").select(N.round_half_up("v", 2).alias("r")).collect()]
    assert got[:5] == [1.0, 2.5, -2.5, 0.0, 0.13] and got[5] is None
    assert str(got[3]) == "0.0"


def test_shares_and_totals_of_nothing(spark):
    none = spark.createDataFrame([], "payment_method string, amount_inr decimal(18,2)")
    assert A.shares(none, "payment_method").count() == 0
    assert tuple(A.overall_totals(none).first()) == (0, 0.0, 0.0)


def test_dashboard_of_nothing(spark):
    none = spark.createDataFrame(
        [], "ts timestamp, category string, city string, payment_method string, city_tier string, seller_id bigint, amount_inr decimal(18,2)"
    )
    got = {(r.section, r.name): r.value for r in dashboard.live_dashboard(none, "2024-01-01 00:00:00").collect()}
    assert got[("summary", "total_orders")] == 0.0 and got[("rolling", "avg_order_last_5min")] == 0.0


def test_dashboard_defaults_for_missing_fields(spark):
    rows = [(dt.datetime(2024, 1, 1), None, None, None, None, None, None)]
    df = spark.createDataFrame(
        rows, "ts timestamp, category string, city string, payment_method string, city_tier string, seller_id bigint, amount_inr decimal(18,2)"
    )
    got = {(r.section, r.name) for r in dashboard.live_dashboard(df, "2024-01-01 00:00:00").collect()}
    assert {("top_categories", "Unknown"), ("city_tier_distribution", "unknown"), ("top_sellers", "")} <= got


def test_counters_keep_null_values_apart(spark):
    df = spark.createDataFrame([("a", None, D(1)), (None, "x", D(2))], "k string, c string, amount_inr decimal(18,2)")
    got = {(r.dimension, r.value): (r.orders, r.revenue) for r in A.counters(df, ["k", "c"]).collect()}
    assert got == {("k", "a"): (1, 1.0), ("k", None): (1, 2.0), ("c", None): (1, 1.0), ("c", "x"): (1, 2.0)}


def test_distinct_counts_approximate(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id % 50 as a")
    exact = {r.k: r.distinct_a for r in A.distinct_counts(df, ["k"], ["a"]).collect()}
    rough = {r.k: r.distinct_a for r in A.distinct_counts(df, ["k"], ["a"], approximate=True).collect()}
    assert exact == {0: 50, 1: 50, 2: 50} and all(abs(v - 50) <= 5 for v in rough.values())


def test_fences(spark):
    raw = ['  {"a":1} ', '```json\n{"a":1}\n```', '```{"a":1}```', "```", ""]
    got = [r.s for r in spark.createDataFrame([(x,) for x in raw], "r string").select(Tx.strip_fence("r").alias("s")).collect()]
    assert [g.strip() for g in got] == ['{"a":1}'] * 3 + ["", ""]


def test_hinglish_is_a_substring_test(spark):
    texts = ["Bahut ACCHA product", "the sheltered milan", "plain words", "a family"]
    got = [r.h for r in spark.createDataFrame([(x,) for x in texts], "t string").select(Tx.language_hint("t").alias("h")).collect()]
    assert got == ["hinglish", "hinglish", "english", "english"]


ANSWER = '{"sentiment":"%s","sentiment_score":%s,"primary_category":"delivery","urgency_level":"low","key_entities":[],' \
         '"one_line_summary":"s","requires_action":true}'


def test_validation_reasons(spark):
    raws = [
        ANSWER % ("positive", "0.5"),
        ANSWER % ("positive", '"0.25"'),
        ANSWER % ("great", "1.5"),
        "not json",
        '{"sentiment":"NEUTRAL"}',
        None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw_response string")
    out = R.validate_answers(R.parse_answers(df)).orderBy("id").collect()
    assert [r.validation_passed for r in out] == [True, True, False, False, False, False]
    assert out[1].sentiment_score == 0.25 and out[0].sentiment == "POSITIVE"
    assert out[2].failure_reasons == ["invalid sentiment", "score out of range"]
    assert out[3].failure_reasons == ["invalid json"] and out[5].failure_reasons == ["invalid json"]
    assert "missing requires_action" in out[4].failure_reasons and len(out[4].failure_reasons) == 6


def test_fallback_rows_go_to_the_dead_letters(spark):
    rows = [(f"R{i}", "text", "s", "c", "x", stars, dt.date(2024, 1, 1), "broken") for i, stars in enumerate([5, 3, 1])]
    df = spark.createDataFrame(
        rows, "review_id string, review_text string, seller_id string, product_category string, city string, rating int, review_date date, raw_response string"
    )
    good, dead = R.split_dead_letters(R.enrich(df), "2024-01-01 00:00:00")
    assert good.count() == 0 and dead.count() == 3
    got = [(r.sentiment, r.sentiment_score, r.urgency_level, r.model_used, r.key_entities) for r in R.enrich(df).orderBy("review_id").collect()]
    assert got == [("POSITIVE", 1.0, "LOW", "fallback", []), ("NEUTRAL", 0.6, "LOW", "fallback", []), ("NEGATIVE", 0.2, "LOW", "fallback", [])]


def test_judge_defaults(spark):
    good = '{"confidence_score":0.9,"sentiment_correct":true,"category_correct":true,"summary_accurate":false,"overall_verdict":"FAIL","reasoning":"r"}'
    df = spark.createDataFrame([(1, good), (2, "?"), (3, '{"overall_verdict":"PASS"}')], "id int, judge_response string")
    out = R.judge_verdicts(df).orderBy("id").collect()
    assert (out[0].overall_verdict, out[0].inconsistent, out[0].summary_accurate) == ("FAIL", True, False)
    for r in out[1:]:
        assert (r.overall_verdict, r.confidence_score, r.judged, r.inconsistent) == ("PASS", 0.5, False, False)
    assert tuple(R.judge_counters(R.judge_verdicts(df)).first()) == (1, 0, 1)


def test_judge_sample_share(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("R"), "id").alias("review_id"), F.lit(True).alias("enrichment_success"), F.lit("LOW").alias("urgency_level"), F.lit("PRICING").alias("primary_category")
    )
    share = df.filter(R.wants_judge()).count() / 5000
    assert 0.17 < share < 0.23
    assert df.withColumn("urgency_level", F.lit("CRITICAL")).filter(R.wants_judge()).count() == 5000
    assert df.withColumn("enrichment_success", F.lit(False)).filter(R.wants_judge()).count() == 0


def test_model_hook_retries(spark):
    def flaky(prompts):
        import os
        import tempfile

        mark = os.path.join(tempfile.gettempdir(), f"flaky-{prompts[0]}")
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("busy")
        return [p.upper() for p in prompts]

    def broken(prompts):
        raise RuntimeError("down")

    import uuid

    df = spark.createDataFrame([(uuid.uuid4().hex,)], "p string")
    assert R.call_model(df, "p", flaky, wait_seconds=0.01).first().raw_response is not None
    assert R.call_model(df, "p", broken, wait_seconds=0.01).first().raw_response is None


def vectors(spark, rows):
    return spark.createDataFrame(rows, "review_id string, embedding array<float>, sentiment string")


def test_search_ties_limits_and_filter(spark):
    rows = [(f"R{i:03d}", [1.0, 0.0], "POSITIVE") for i in range(40)] + [("Z", [0.6, 0.8], "NEGATIVE")]
    queries = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 1.0])], "query_id int, query_vector array<float>")
    df = vectors(spark, rows).repartition(4)
    got = [(r.query_id, r.review_id, r.similarity_score) for r in S.semantic_search(queries, df, k=3).orderBy("query_id", "place").collect()]
    assert got == [(1, "R000", 1.0), (1, "R001", 1.0), (1, "R002", 1.0), (2, "Z", 0.8), (2, "R000", 0.0), (2, "R001", 0.0)]
    assert [r.review_id for r in S.semantic_search(queries, df, sentiment="NEGATIVE").collect()] == ["Z", "Z"]
    assert S.semantic_search(queries, df, sentiment="NONE").count() == 0
    assert S.semantic_search(queries.limit(0), df).count() == 0
    # Several passes over the queries give the same rows.
    split = S.semantic_search(queries, df, k=3, max_query_bytes=16)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, S.semantic_search(queries, df, k=3).collect()))


def test_upsert_keeps_one_row_per_key(spark):
    cols = "k string, v string, version int"
    base = spark.createDataFrame([("a", "old", 0), ("b", "old", 0)], cols)
    delta = spark.createDataFrame([("b", "mid", 1), ("b", "new", 2), ("c", "new", 1)] + [("d", "copy", 1)] * 30, cols)
    got = {r.k: r.v for r in U.upsert(base, delta, ["k"], "version").collect()}
    assert got == {"a": "old", "b": "new", "c": "new", "d": "copy"}
    assert U.upsert(base, delta, ["k"], "version").count() == 4
    assert U.upsert(base, delta.limit(0), ["k"], "version").count() == 2


def test_reports_have_their_limits(orders):
    rows = [order(i, seller_id=i, order_date=dt.date(2024, 1, 1) + dt.timedelta(days=i), category=f"c{i % 9}") for i in range(40)]
    df = orders(*rows)
    assert reports.latest_days(daily_revenue(df)).count() == 6
    assert reports.latest_days(daily_revenue(df)).first().order_date == dt.date(2024, 2, 9)
    assert reports.early_retention(cohort_retention(df)).count() <= 12
    assert reports.latest_trends(category_trends(df)).count() == 6
    assert reports.high_risk_sellers(fraud_patterns(df)).count() == 5
