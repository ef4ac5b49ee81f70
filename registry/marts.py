"""M: the end-to-end marts."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.plans.category_trends import category_trends
from bazaarflow.plans.cohort_retention import cohort_retention
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.plans.fraud_patterns import collusion_pairs, fraud_patterns, geo_impossible
from bazaarflow.plans.seller_performance import seller_performance

from .base import day, div, pct, query, rnd, stamp, using

M1_CORE = """select order_date, category, city_tier, is_sale_day, cast(sum(amount_inr) as double) as total_revenue,
  count(order_id) as order_count, count(distinct customer_id) as unique_customers,
  count(distinct seller_id) as active_sellers,
  cast(sum(case when payment_method = 'UPI' then amount_inr else 0 end) as double) as upi_revenue
  from orders_fact group by all"""

M1 = f"""select * replace ({day('order_date')} as order_date), {div('total_revenue', 'order_count')} as avg_order_value,
  {pct('upi_revenue', 'total_revenue')} as upi_share_pct,
  {rnd(div('total_revenue', 'unique_customers'), 2)} as revenue_per_customer from ({M1_CORE}) t"""


@query("m1_daily_revenue", using("orders_fact", M1))
def m1(spark, root):
    return daily_revenue(B.orders_fact(spark, root))


M2_FIRST = {
    "first_order": "select customer_id, min(order_date) as cohort_date from orders_fact group by 1",
    "with_cohort": """select o.*, cast(date_trunc('week', cohort_date) as date) as cohort_week,
      cast(datediff('day', date_trunc('week', cohort_date), date_trunc('week', order_date)) / 7 as bigint) as weeks_since_signup
      from orders_fact o join first_order using (customer_id)""",
    "sizes": """select cohort_week, count(distinct customer_id) as cohort_size from with_cohort
      where weeks_since_signup = 0 group by 1""",
    "retention": """select cohort_week, weeks_since_signup, count(distinct customer_id) as retained_users,
      cast(sum(amount_inr) as double) as cohort_revenue from with_cohort group by 1, 2""",
    "m2": f"""select cohort_week, weeks_since_signup, retained_users, cohort_revenue, cohort_size,
      {pct('retained_users', 'cohort_size')} as retention_rate_pct from retention left join sizes using (cohort_week)""",
}


@query(
    "m2_cohort_retention",
    using("orders_fact", f"select * replace ({day('cohort_week')} as cohort_week) from m2", also=M2_FIRST),
)
def m2(spark, root):
    return cohort_retention(B.orders_fact(spark, root))


M3_SQL = {
    "metrics": f"""select *, {div('total_revenue', 'total_orders')} as avg_order_value,
      {pct('(tier2_orders + tier3_orders)', 'total_orders')} as tier2_tier3_share,
      {rnd(div('total_revenue', 'active_days'), 2)} as revenue_per_active_day
      from (select seller_id, cast(sum(amount_inr) as double) as total_revenue, count(order_id) as total_orders,
        count(distinct customer_id) as unique_customers, count(distinct city) as cities_reached,
        count(distinct category) as categories_sold, count(distinct order_date) as active_days,
        count(*) filter (city_tier = 'tier2') as tier2_orders, count(*) filter (city_tier = 'tier3') as tier3_orders
        from orders_fact group by 1) t""",
    "ranked": """select *, percent_rank() over (order by total_revenue nulls first) as revenue_percentile,
      percent_rank() over (order by total_orders nulls first) as volume_percentile,
      percent_rank() over (order by cities_reached nulls first) as reach_percentile,
      percent_rank() over (order by unique_customers nulls first) as diversity_percentile,
      percent_rank() over (order by tier2_tier3_share nulls first) as tier_reach_percentile from metrics""",
    "scored": f"""select *, {rnd('''(revenue_percentile * 0.40::double + volume_percentile * 0.20::double
      + reach_percentile * 0.15::double + diversity_percentile * 0.15::double
      + tier_reach_percentile * 0.10::double)''', 4)} as performance_score from ranked""",
    "m3": """select *, case when performance_score >= 0.8::double then 'PLATINUM'
      when performance_score >= 0.6::double then 'GOLD' when performance_score >= 0.4::double then 'SILVER'
      else 'BRONZE' end as seller_tier, dense_rank() over (order by performance_score desc) as rank from scored""",
}


@query("m3_seller_performance", using("orders_fact", "select * from m3", also=M3_SQL))
def m3(spark, root):
    return seller_performance(B.orders_fact(spark, root))


def m4_sql(amount: str, multiple: int, round_limit: float) -> dict[str, str]:
    return {
        "rates": f"""select *, {rnd(div('round_number_orders', 'total_orders'), 4)} as round_number_rate,
      {rnd(div('off_hours_orders', 'total_orders'), 4)} as off_hours_rate
      from (select seller_id, count(*) filter ({amount} % {multiple} = 0) as round_number_orders,
        count(order_id) as total_orders, count(*) filter (order_hour < 7 or order_hour > 23) as off_hours_orders,
        array_to_string(list_sort(list(distinct order_hour)), ',') as active_hours from orders_fact group by 1) t""",
        "signals": f"""select *, round_number_rate > {round_limit}::double as round_number_signal,
      off_hours_rate > 0.3::double as timing_signal from rates""",
        "m4": """select *, fraud_signal_count: cast(cast(round_number_signal as int) + cast(timing_signal as int) as bigint),
      case when cast(round_number_signal as int) + cast(timing_signal as int) >= 2 then 'HIGH'
      when cast(round_number_signal as int) + cast(timing_signal as int) = 1 then 'MEDIUM' else 'LOW' end
      as fraud_risk_level from signals""",
    }


M4_FIXTURE = m4_sql("(quantity * 10)", 100, 0.1)


def fraud_fixture(spark, root):
    """Round amounts are taken from quantity * 10, which spreads seller rates around 0.1."""
    orders = B.orders_fact(spark, root).withColumn("round_base", F.col("quantity") * 10)
    return fraud_patterns(orders, amount="round_base", round_limit=0.1)


@query("m4_fraud_patterns", using("orders_fact", "select * from m4", also=M4_FIXTURE))
def m4(spark, root):
    return fraud_fixture(spark, root)


@query(
    "m4_fraud_patterns_defaults",
    using("orders_fact", "select * from m4", also=m4_sql("amount_inr", 100, 0.5)),
)
def m4_defaults(spark, root):
    return fraud_patterns(B.orders_fact(spark, root))


A10 = """select seller_id, customer_id, count(order_id) as pair_order_count,
  cast(sum(amount_inr) as double) as pair_revenue, count(distinct order_date) as pair_active_days,
  count(order_id) > {n} as collusion_signal from orders_fact group by 1, 2"""


@query("m4b_collusion_pairs", using("orders_fact", A10.format(n=3)))
def m4b(spark, root):
    return collusion_pairs(B.orders_fact(spark, root), more_than=3)


@query(
    "m4c_geo_impossible",
    using(
        "orders_placed",
        f"""select customer_id, event_id, {stamp('ts')} as ts, prev_city, city,
      {div('(at_us - prev_at)', '1000000')} as seconds_apart
      from (select *, lag(city) over w as prev_city, lag(at_us) over w as prev_at
        from (select *, updated_stock as customer_id, epoch_us(ts) as at_us from orders_placed) t
        window w as (partition by customer_id order by at_us, event_id)) u
      where city <> prev_city and at_us - prev_at <= 14400000000""",
    ),
)
def m4c(spark, root):
    events = B.orders_placed(spark, root).withColumn("customer_id", F.col("updated_stock"))
    return geo_impossible(events, "customer_id", "city", "ts", "event_id", minutes=240)


M5_SQL = {
    "weekly": """select cast(date_trunc('week', order_date) as date) as order_week, category,
      cast(sum(amount_inr) as double) as weekly_revenue, count(order_id) as weekly_orders,
      count(distinct customer_id) as weekly_customers from orders_fact group by 1, 2""",
    "lagged": """select *, lag(weekly_revenue) over w as prev_week_revenue, lag(weekly_orders) over w as prev_week_orders
      from weekly window w as (partition by category order by order_week)""",
    "changed": f"""select *, case when prev_week_revenue > 0 then
      {pct('(weekly_revenue - prev_week_revenue)', 'prev_week_revenue')} end as revenue_wow_pct from lagged""",
    "m5": """select *, case when revenue_wow_pct > 10 then 'GROWING_FAST' when revenue_wow_pct > 0 then 'GROWING'
      when revenue_wow_pct is null then 'BASELINE' when revenue_wow_pct > -10 then 'DECLINING'
      else 'DECLINING_FAST' end as trend,
      dense_rank() over (partition by order_week order by weekly_revenue desc) as revenue_rank_this_week from changed""",
}


@query(
    "m5_category_trends",
    using("orders_fact", f"select * replace ({day('order_week')} as order_week) from m5", also=M5_SQL),
)
def m5(spark, root):
    return category_trends(B.orders_fact(spark, root))
