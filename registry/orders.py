"""W, K, U, Q and M8 queries."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.functions.dates import micros
from bazaarflow.operators import setops, topk, windows as Wn
from bazaarflow.operators.ranks import global_dense_rank, global_percent_rank
from bazaarflow.plans import health, quality, reports
from bazaarflow.plans.category_trends import category_trends, weekly_totals
from bazaarflow.plans.cohort_retention import cohort_retention
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.plans.seller_performance import seller_performance
from bazaarflow.session import scratch_path

from .base import big, day, div, query, rnd, stamp, using
from .marts import M1, M2_FIRST, M3_SQL, M4_FIXTURE, M5_SQL, fraud_fixture

DAY_US = 86_400_000_000

# ---- windows --------------------------------------------------------------------------


@query(
    "w1_percent_rank",
    """select p_partkey, percent_rank() over (order by p_retailprice nulls first) as price_rank,
    percent_rank() over (order by p_size nulls first) as size_rank from part""",
)
def w1(spark, root):
    parts = B.table(spark, root, "part")
    return global_percent_rank(parts, "p_partkey", {"price_rank": "p_retailprice", "size_rank": "p_size"})


@query(
    "w2_dense_rank",
    "select o_orderkey, o_totalprice, dense_rank() over (order by o_totalprice desc) as place from orders",
)
def w2(spark, root):
    orders = B.table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return global_dense_rank(orders, "o_totalprice", "place", descending=True)


@query(
    "w3_rank_per_week",
    using(
        "orders_fact",
        f"""select {day('order_week')} as order_week, category, weekly_revenue,
      dense_rank() over (partition by order_week order by weekly_revenue desc) as place from weekly""",
        also={"weekly": M5_SQL["weekly"]},
    ),
)
def w3(spark, root):
    from pyspark.sql import Window

    weekly = weekly_totals(B.orders_fact(spark, root)).select("order_week", "category", "weekly_revenue")
    best = Window.partitionBy("order_week").orderBy(F.desc("weekly_revenue"))
    return weekly.withColumn("place", F.dense_rank().over(best))


@query(
    "w4_previous_week",
    using(
        "orders_fact",
        f"""select {day('order_week')} as order_week, category, weekly_orders,
      lag(weekly_orders) over (partition by category order by order_week) as prev_week_orders from weekly""",
        also={"weekly": M5_SQL["weekly"]},
    ),
)
def w4(spark, root):
    weekly = weekly_totals(B.orders_fact(spark, root)).select("order_week", "category", "weekly_orders")
    return Wn.step_change(weekly, "category", "order_week", "weekly_orders", "prev_week_orders")


@query(
    "w5_rolling_average",
    using(
        "hourly_series",
        f"""select series, pos, n, {rnd('''(cast(sum(n) over w as double) / count(*) over w)''', 2)} as rolling_avg
      from hourly_series window w as (partition by series order by pos rows between 6 preceding and current row)""",
    ),
)
def w5(spark, root):
    return Wn.rolling_average(B.hourly_series(spark, root).select("series", "pos", "n"), "series", "pos", "n", 7)


@query(
    "w6_trailing_count",
    using(
        "events_fact",
        """select seller_id, event_id, count(*) over (partition by seller_id order by ts
      range between interval 1 day preceding and current row) as n_day from events_fact""",
    ),
)
def w6(spark, root):
    events = B.events_fact(spark, root).select("seller_id", "event_id", micros("ts").alias("at_us"))
    return Wn.trailing_window(events, ["seller_id"], "at_us", "event_id", {"day": DAY_US}).drop("at_us")


@query(
    "w7_trailing_sum",
    using(
        "events_fact",
        f"""select seller_id, event_id, count(*) over w as n_day, cast(sum(amount_inr) over w as double) as sum_day,
      {div('sum(amount_inr) over w', 'count(*) over w')} as avg_day from events_fact
      window w as (partition by seller_id order by ts range between interval 1 day preceding and current row)""",
    ),
)
def w7(spark, root):
    events = B.events_fact(spark, root).select("seller_id", "event_id", "amount_inr", micros("ts").alias("at_us"))
    out = Wn.trailing_window(events, ["seller_id"], "at_us", "event_id", {"day": DAY_US}, value="amount_inr")
    average = F.col("sum_day").cast("double") / F.col("n_day").cast("double")
    return out.select("seller_id", "event_id", "n_day", "sum_day", average.alias("avg_day"))


@query(
    "w8_active_keys",
    using(
        "events_fact",
        f"""select seller_id, {stamp('max(ts)')} as last_seen from events_fact
      where ts between timestamp '2024-01-29 00:00:00' and timestamp '2024-01-30 00:00:00' group by 1""",
    ),
)
def w8(spark, root):
    return Wn.active_keys(B.events_fact(spark, root), "seller_id", "ts", "2024-01-30 00:00:00", 86400)


@query(
    "w9_longest_streak",
    using(
        "hourly_series",
        """select series, coalesce(max(len), 0)::bigint as longest_streak from (
      select series, count(*) filter (n >= 2) as len from (select *, pos - count(*) filter (n >= 2) over
        (partition by series order by pos rows unbounded preceding) as run from hourly_series) t
      group by series, run) u group by series""",
    ),
)
def w9(spark, root):
    return Wn.longest_streak(B.hourly_series(spark, root), "series", "pos", "n", 2)


@query(
    "w10_local_peaks",
    using(
        "hourly_series",
        """select series, pos, n from (select *, lag(n) over w as b, lead(n) over w as a from hourly_series
      window w as (partition by series order by pos)) t where (b is null or b <= n) and (a is null or a < n)""",
    ),
)
def w10(spark, root):
    return Wn.local_peaks(B.hourly_series(spark, root), "series", "pos", "n")


# ---- sorts and top-k ------------------------------------------------------------------


@query(
    "k1_multi_key_sort",
    "select n_regionkey::bigint as n_regionkey, n_name, c_custkey, c_acctbal from customer"
    " join nation on c_nationkey = n_nationkey",
)
def k1(spark, root):
    n, c = B.table(spark, root, "nation"), B.table(spark, root, "customer")
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select("n_regionkey", "n_name", "c_custkey", "c_acctbal")
    return joined.orderBy("n_regionkey", F.desc("c_acctbal"), "c_custkey")


K2 = """select review_id, seller_id, city, urgency_level, primary_category, one_line_summary, suggested_action,
    {when} as review_date
  from reviews_fact where urgency_level in ('HIGH', 'CRITICAL') and requires_action
  order by urgency_level = 'HIGH', review_date desc, review_id
  limit {n}"""


@query("k2_urgent_reviews", using("reviews_fact", K2.format(n=10, when=day("review_date"))))
def k2(spark, root):
    return topk.urgent_reviews(B.reviews_fact(spark, root))


@query(
    "k3_top_sellers",
    using(
        "orders_placed",
        """select seller_id, cast(sum(amount_inr) as double) as total from orders_placed group by 1
      order by total desc, seller_id limit 10""",
    ),
)
def k3(spark, root):
    return topk.top_by_sum(B.orders_placed(spark, root), "seller_id", "amount_inr", 10)


@query(
    "k4_top_categories_and_cities",
    using(
        "orders_placed",
        """select * from (select 'category' as dimension, category as value, count(*) as orders,
        cast(sum(amount_inr) as double) as revenue, row_number() over (order by sum(amount_inr) desc, category) as place
        from orders_placed group by category
      union all select 'city', city, count(*), cast(sum(amount_inr) as double),
        row_number() over (order by count(*) desc, city) from orders_placed group by city) t where place <= 5""",
    ),
)
def k4(spark, root):
    from bazaarflow.operators.aggregates import counters

    found = counters(B.orders_placed(spark, root), ["category", "city"])
    score = F.when(F.col("dimension") == "category", F.col("revenue")).otherwise(F.col("orders").cast("double"))
    best = topk.top_per_group(found.withColumn("_score", score), "dimension", [F.desc("_score"), F.asc("value")], 5)
    return best.drop("_score")


@query(
    "k5_kth_largest",
    "select min(o_totalprice) as kth_largest from (select o_totalprice from orders order by o_totalprice desc limit 25) t",
)
def k5(spark, root):
    return topk.kth_largest(B.table(spark, root, "orders"), "o_totalprice", 25)


@query(
    "k6_most_frequent",
    "select user_id, count(*) as n from events group by 1 order by n desc, user_id desc limit 20",
)
def k6(spark, root):
    return topk.top_by_count(B.table(spark, root, "events"), "user_id", 20)


@query(
    "k7_top_per_group",
    using(
        "orders_fact",
        """select category, order_id, cast(amount_inr as double) as amount_inr, place from (select *, row_number() over
      (partition by category order by amount_inr desc, order_id) as place from orders_fact) t where place <= 3""",
    ),
)
def k7(spark, root):
    slim = B.orders_fact(spark, root).select("category", "order_id", "amount_inr")
    return topk.top_per_group(slim, "category", [F.desc("amount_inr"), F.asc("order_id")], 3)


# ---- set operations -------------------------------------------------------------------

AMOUNTS = {
    "customer": ("c_acctbal", "c_custkey"),
    "supplier": ("s_acctbal", "s_suppkey"),
    "part": ("p_retailprice", "p_partkey"),
    "orders": ("o_totalprice", "o_orderkey"),
}


def sorted_inputs(spark, root, names):
    return [setops.sorted_input(B.table(spark, root, n), *AMOUNTS[n]) for n in names]


def merge_sql(names):
    parts = " union all ".join(
        f"select {AMOUNTS[n][0]} as value, {i}::bigint as source,"
        f" row_number() over (order by {AMOUNTS[n][0]}, {AMOUNTS[n][1]}) - 1 as pos from {n}"
        for i, n in enumerate(names)
    )
    return f"select *, row_number() over (order by value, source, pos) - 1 as merged_pos from ({parts}) t"


@query("u1_merge_sorted", merge_sql(list(AMOUNTS)))
def u1(spark, root):
    return setops.merge_sorted(sorted_inputs(spark, root, list(AMOUNTS)))


@query("u2_merge_two", merge_sql(["part", "orders"]))
def u2(spark, root):
    return setops.merge_sorted(sorted_inputs(spark, root, ["part", "orders"]))


# ---- data quality ---------------------------------------------------------------------


def check_sql(check, column, bad, message):
    return f"""select '{check}' as "check", '{column}' as "column", {bad} = 0 as passed, {big(bad)} as bad_rows,
      {message} as message from s"""


def nulls_sql(c, table):
    return check_sql("no_nulls", c, f"null_{c}", f"concat('{table}.{c}: ', null_{c}, ' nulls')")


REQUIRED = ["order_id", "seller_id", "amount_inr"]
SCAN = {
    "s": """select count(*) as n, count(*) filter (order_id is null) as null_order_id, count(*) filter (seller_id is null)
      as null_seller_id, count(*) filter (amount_inr is null) as null_amount_inr,
      count(*) filter (amount_inr < 0 or amount_inr > 90000) as range_amount_inr, count(*) - count(distinct order_id) as dupes
      from orders_fact"""
}
Q1 = check_sql("not_empty", "*", "(case when n = 0 then 1 else 0 end)", "concat('orders: ', n, ' rows')")
Q2 = " union all ".join(nulls_sql(c, "orders") for c in REQUIRED)
Q3 = check_sql("no_duplicates", "order_id", "dupes", "concat('orders: ', dupes, ' duplicate keys on order_id')")
Q4 = check_sql(
    "value_range", "amount_inr", "range_amount_inr", "concat('orders.amount_inr: ', range_amount_inr, ' values outside [0, 90000]')"
)
LIMITS = {"amount_inr": (0, 90000)}


@query("q1_not_empty", using("orders_fact", Q1, also=SCAN))
def q1(spark, root):
    return quality.scan_checks(B.orders_fact(spark, root), "orders")


@query("q2_no_nulls", using("orders_fact", Q2, also=SCAN))
def q2(spark, root):
    return quality.scan_checks(B.orders_fact(spark, root), "orders", REQUIRED, not_empty=False)


@query(
    "q3_no_duplicates",
    using(
        "orders_fact",
        Q3
        + " union all "
        + """select 'no_duplicates', 'l_orderkey,l_linenumber', dupes = 0, dupes,
        concat('lineitem: ', dupes, ' duplicate keys on l_orderkey,l_linenumber') from
        (select count(*) - count(distinct (l_orderkey, l_linenumber)) as dupes from lineitem) t""",
        also=SCAN,
    ),
)
def q3(spark, root):
    good = quality.duplicate_check(B.orders_fact(spark, root), "orders", ["order_id"])
    lines = B.table(spark, root, "lineitem")
    return good.unionByName(quality.duplicate_check(lines, "lineitem", ["l_orderkey", "l_linenumber"]))


@query("q4_value_range", using("orders_fact", Q4, also=SCAN))
def q4(spark, root):
    return quality.scan_checks(B.orders_fact(spark, root), "orders", ranges=LIMITS, not_empty=False)


@query("q5_suite", using("orders_fact", " union all ".join([Q1, Q2, Q3, Q4]), also=SCAN))
def q5(spark, root):
    return quality.quality_report(B.orders_fact(spark, root), "orders", REQUIRED, ["order_id"], LIMITS)


ZONE = """case event_type when 'order_placed' then 'orders' when 'inventory_update' then 'inventory'
  else 'fraud_signals' end"""
HEALTH = f"""select {ZONE} as zone, count(*) as events, max(ts) as last_ts, 'healthy' as status from events_fact
  where ts > timestamp '2024-01-29 00:00:00' group by 1"""
FRESH = f"""select *, coalesce(age_hours <= 24, false) as fresh from (select zone, last_ts,
  (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last_ts)) / 3600000000.0::double as age_hours
  from (select {ZONE} as zone, max(ts) as last_ts from events_fact group by 1) t) u"""
ESCALATION = """select count(*) filter (fraud_risk_level = 'HIGH') as high_risk_count,
  count(*) filter (fraud_risk_level = 'HIGH') >= 10 as escalation_required from m4"""


@query("q6_topic_health", using("events_fact", f"select * replace ({stamp('last_ts')} as last_ts) from ({HEALTH}) t"))
def q6(spark, root):
    return health.topic_health(B.events_fact(spark, root), "2024-01-29 00:00:00")


@query("q7_freshness", using("events_fact", f"select * replace ({stamp('last_ts')} as last_ts) from ({FRESH}) t"))
def q7(spark, root):
    return health.freshness(B.events_fact(spark, root), "2024-01-31 00:00:00")


@query(
    "q7_file_freshness",
    """select name, name <> 'missing' as found, name in ('orders', 'events') and late = 'no' as fresh, late
      from (select unnest(['orders', 'events', 'missing']) as name) t, (select unnest(['yes', 'no']) as late) u""",
)
def q7_files(spark, root):
    """File times long before one point in time, and all after another."""
    paths = {"orders": f"{root}/orders.parquet", "events": f"{root}/events.parquet", "missing": scratch_path(spark, "missing")}
    found = [health.file_freshness(spark, paths, as_of).withColumn("late", F.lit(late)) for as_of, late in (("2200-01-01", "yes"), ("1970-01-01", "no"))]
    return found[0].unionByName(found[1]).select("name", (F.col("files") > 0).alias("found"), "fresh", "late")


@query("q9_escalation", using("orders_fact", ESCALATION, also=M4_FIXTURE))
def q9(spark, root):
    return health.escalation(fraud_fixture(spark, root))


Q10 = {
    "health": HEALTH,
    "fresh": FRESH,
    "alert": ESCALATION,
    "counts": """select alert.*, 3 - (select count(*) from health) as silent_topics,
      (select count(*) from fresh where not fresh) as stale_zones from alert""",
}


@query(
    "q10_run_summary",
    using(
        "orders_fact events_fact",
        """select *, concat('run 2024-01-31: ', status, '; silent topics ', silent_topics, '; stale zones ', stale_zones,
      '; high-risk sellers ', high_risk_count, '; tables 5') as summary
      from (select *, case when silent_topics = 0 and stale_zones = 0 then 'SUCCESS' else 'FAILED' end as status
        from counts) t""",
        also=M4_FIXTURE | Q10,
    ),
)
def q10(spark, root):
    events = B.events_fact(spark, root)
    return health.run_summary(
        health.topic_health(events, "2024-01-29 00:00:00"),
        health.freshness(events, "2024-01-31 00:00:00"),
        health.escalation(fraud_fixture(spark, root)),
        "2024-01-31",
    )


# ---- report views ---------------------------------------------------------------------


@query(
    "m8_latest_days",
    using("orders_fact", f"select * from ({M1}) t order by order_date desc, total_revenue desc limit 6"),
)
def m8_days(spark, root):
    return reports.latest_days(daily_revenue(B.orders_fact(spark, root), ordered=False))


@query(
    "m8_leaderboard",
    using(
        "orders_fact",
        """select rank, seller_id, total_revenue, total_orders, seller_tier, performance_score from m3
      order by rank, seller_id limit 5""",
        also=M3_SQL,
    ),
)
def m8_sellers(spark, root):
    return reports.leaderboard(seller_performance(B.orders_fact(spark, root), ordered=False))


@query(
    "m8_early_retention",
    using(
        "orders_fact",
        f"""select * replace ({day('cohort_week')} as cohort_week) from m2 where weeks_since_signup <= 3
      order by m2.cohort_week, weeks_since_signup limit 12""",
        also=M2_FIRST,
    ),
)
def m8_cohorts(spark, root):
    return reports.early_retention(cohort_retention(B.orders_fact(spark, root), ordered=False))


@query(
    "m8_latest_trends",
    using(
        "orders_fact",
        f"""select * replace ({day('order_week')} as order_week) from m5
      order by m5.order_week desc, revenue_rank_this_week, category limit 6""",
        also=M5_SQL,
    ),
)
def m8_trends(spark, root):
    return reports.latest_trends(category_trends(B.orders_fact(spark, root), ordered=False))


@query(
    "m8_high_risk",
    using(
        "orders_fact",
        """select seller_id, fraud_risk_level, round_number_rate, off_hours_rate, fraud_signal_count from m4
      where fraud_risk_level = 'HIGH' order by round_number_rate desc, seller_id limit 5""",
        also=M4_FIXTURE,
    ),
)
def m8_fraud(spark, root):
    return reports.high_risk_sellers(fraud_fixture(spark, root))
