"""P, J, A and scalar-function queries."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.functions.buckets import rating_sentiment, sentiment_band
from bazaarflow.functions.dates import week_start, weeks_between
from bazaarflow.functions.numeric import floored_ratio, percent, ratio, round_half_up
from bazaarflow.functions.text import language_hint
from bazaarflow.operators import aggregates as A
from bazaarflow.operators.topk import stock_alert
from bazaarflow.plans.category_trends import trend
from bazaarflow.plans.cohort_retention import customer_weeks
from bazaarflow.plans.fraud_patterns import is_off_hours, is_round, risk_level
from bazaarflow.plans.seller_performance import seller_tier

from bazaarflow.sources import warehouse as Wh

from .base import big, day, div, pct, query, rnd, using
from .marts import A10, M2_FIRST

# ---- projections and predicates -------------------------------------------------------


@query(
    "p1_derived_columns",
    f"""select p_partkey, {div('p_retailprice', 'p_size')} as price_per_size,
    {pct('p_size', 'p_retailprice')} as size_share_pct,
    {rnd('(p_retailprice * 0.4::double + p_size * 0.6::double)', 4)} as weighted from part""",
)
def p1(spark, root):
    c = F.col
    return B.table(spark, root, "part").select(
        "p_partkey",
        ratio("p_retailprice", "p_size").alias("price_per_size"),
        percent("p_size", "p_retailprice").alias("size_share_pct"),
        round_half_up(c("p_retailprice") * F.lit(0.4) + c("p_size") * F.lit(0.6), 4).alias("weighted"),
    )


@query(
    "p2_case_buckets",
    using(
        "reviews_fact",
        """select review_id, case when sentiment_score >= 0.8::double then 'PLATINUM' when sentiment_score >= 0.6::double
      then 'GOLD' when sentiment_score >= 0.4::double then 'SILVER' else 'BRONZE' end as tier,
      case when rating >= 2 then 'HIGH' when rating = 1 then 'MEDIUM' else 'LOW' end as risk,
      case when change > 10 then 'GROWING_FAST' when change > 0 then 'GROWING' when change is null then 'BASELINE'
        when change > -10 then 'DECLINING' else 'DECLINING_FAST' end as trend,
      case when rating <= 2 then 'CRITICAL' else 'WARNING' end as alert,
      case when sentiment_score >= 0.7::double then 'STRONG' when sentiment_score >= 0.4::double then 'MIXED'
        else 'POOR' end as band,
      case when rating >= 4 then 'POSITIVE' when rating <= 2 then 'NEGATIVE' else 'NEUTRAL' end as fallback
      from (select *, case when rating <> 3 then cast(doc_id % 41 - 20 as double) end as change from reviews_fact) t""",
    ),
)
def p2(spark, root):
    change = F.when(F.col("rating") != 3, (F.col("doc_id") % 41 - 20).cast("double"))
    return B.reviews_fact(spark, root).select(
        "review_id",
        seller_tier(F.col("sentiment_score")).alias("tier"),
        risk_level("rating").alias("risk"),
        trend(change).alias("trend"),
        stock_alert("rating").alias("alert"),
        sentiment_band("sentiment_score").alias("band"),
        rating_sentiment("rating").alias("fallback"),
    )


@query(
    "p3_predicates",
    using(
        "orders_fact",
        """select order_id, cast(amount_inr as double) as amount_inr, order_hour from orders_fact
      where payment_method = 'UPI' and amount_inr >= 1000 and amount_inr <= 90000 and city is not null
        and (order_hour < 7 or order_hour > 21) and not is_sale_day""",
    ),
)
def p3(spark, root):
    c = F.col
    hit = (
        (c("payment_method") == "UPI")
        & c("amount_inr").between(1000, 90000)
        & c("city").isNotNull()
        & ((c("order_hour") < 7) | (c("order_hour") > 21))
        & ~c("is_sale_day")
    )
    return B.orders_fact(spark, root).filter(hit).select("order_id", "amount_inr", "order_hour")


@query(
    "p4_round_numbers",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber, l_quantity from lineitem
    where (cast(l_quantity * 10 as decimal(18,2)) % 100) = 0""",
)
def p4(spark, root):
    amount = (F.col("l_quantity") * 10).cast("decimal(18,2)")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return B.table(spark, root, "lineitem").filter(is_round(amount) == 1).select(*cols)


@query(
    "p5_in_and_flag",
    using(
        "reviews_fact",
        """select review_id, urgency_level from reviews_fact
      where urgency_level in ('HIGH', 'CRITICAL') and requires_action""",
    ),
)
def p5(spark, root):
    hit = F.col("urgency_level").isin("HIGH", "CRITICAL") & F.col("requires_action")
    return B.reviews_fact(spark, root).filter(hit).select("review_id", "urgency_level")


@query("p6_column_subset", using("orders_fact", "select order_id, seller_id, category, payment_method from orders_fact"))
def p6(spark, root):
    return B.orders_fact(spark, root).select("order_id", "seller_id", "category", "payment_method")


@query(
    "p7_field_defaults",
    f"""select event_id, coalesce({big("json_extract_string(props, '$.k')")}, 0) as k,
    coalesce(json_extract_string(props, '$.city'), 'Unknown') as city,
    coalesce({big("json_extract_string(props, '$.quantity')")}, 1) as quantity from events""",
)
def p7(spark, root):
    parsed = F.from_json("props", "k int, city string, quantity int")
    return B.table(spark, root, "events").select(
        "event_id",
        F.coalesce(parsed["k"], F.lit(0)).alias("k"),
        F.coalesce(parsed["city"], F.lit("Unknown")).alias("city"),
        F.coalesce(parsed["quantity"], F.lit(1)).alias("quantity"),
    )


@query(
    "p8_casts",
    using(
        "orders_fact",
        """select order_id, cast(is_sale_day as bigint) as sale_flag, cast(trunc(amount_inr) as bigint) as whole_amount,
      cast(quantity as double) as quantity_double, cast(try_cast(city_tier as int) as bigint) as not_a_number
      from orders_fact""",
    ),
)
def p8(spark, root):
    c = F.col
    return B.orders_fact(spark, root).select(
        "order_id",
        c("is_sale_day").cast("int").alias("sale_flag"),
        c("amount_inr").cast("bigint").alias("whole_amount"),
        c("quantity").cast("double").alias("quantity_double"),
        c("city_tier").try_cast("int").alias("not_a_number"),
    )


@query("p9_lookup_by_key", using("reviews_fact", "select review_id, rating, sentiment from reviews_fact where seller_id = 7"))
def p9(spark, root):
    return spark.sql(
        "select review_id, rating, sentiment from {reviews} where seller_id = :seller",
        args={"seller": 7},
        reviews=B.reviews_fact(spark, root),
    )


# ---- joins ----------------------------------------------------------------------------


@query(
    "j1_cohort_size_join",
    using(
        "orders_fact",
        f"""select {day('cohort_week')} as cohort_week, weeks_since_signup, retained_users, cohort_size
      from retention left join sizes using (cohort_week)""",
        also={k: M2_FIRST[k] for k in ("first_order", "with_cohort", "sizes", "retention")},
    ),
)
def j1(spark, root):
    weeks = customer_weeks(B.orders_fact(spark, root))
    since = weeks_between("activity_week", "cohort_week")
    retained = weeks.groupBy("cohort_week", since.alias("weeks_since_signup")).agg(F.count("*").alias("retained_users"))
    sizes = weeks.filter(since == 0).groupBy("cohort_week").agg(F.count("*").alias("cohort_size"))
    return A.signal_join(retained, [sizes], "cohort_week")


@query(
    "j2_signal_join",
    using(
        "orders_fact reviews_fact",
        """select s.seller_id, off_hours, negative from
      (select seller_id, count(*) filter (order_hour < 7 or order_hour > 23) as off_hours from orders_fact group by 1) s
      left join (select seller_id, count(*) filter (sentiment = 'NEGATIVE') as negative from reviews_fact group by 1) r
      using (seller_id)""",
    ),
)
def j2(spark, root):
    off = B.orders_fact(spark, root).groupBy("seller_id").agg(F.sum(is_off_hours("order_hour")).alias("off_hours"))
    negative = F.count_if(F.col("sentiment") == "NEGATIVE").alias("negative")
    return A.signal_join(off, [B.reviews_fact(spark, root).groupBy("seller_id").agg(negative)], "seller_id")


# ---- aggregates -----------------------------------------------------------------------


@query(
    "a1_totals",
    using(
        "orders_fact",
        f"""select category, payment_method, cast(sum(amount_inr) as double) as total, count(amount_inr) as n,
      {div('sum(amount_inr)', 'count(amount_inr)')} as average from orders_fact group by 1, 2""",
    ),
)
def a1(spark, root):
    return A.totals_by(B.orders_fact(spark, root), ["category", "payment_method"], "amount_inr")


@query(
    "a2_distinct_counts",
    using(
        "orders_fact",
        """select category, count(distinct customer_id) as distinct_customer_id, count(distinct seller_id) as
      distinct_seller_id, count(distinct city) as distinct_city, count(distinct order_date) as distinct_order_date
      from orders_fact group by 1""",
    ),
)
def a2(spark, root):
    cols = ["customer_id", "seller_id", "city", "order_date"]
    return A.distinct_counts(B.orders_fact(spark, root), ["category"], cols)


@query(
    "a3_conditional_sums",
    using(
        "orders_fact",
        """select seller_id, cast(sum(case when payment_method = 'UPI' then amount_inr else 0 end) as double) as upi_amount,
      count(*) filter (payment_method = 'UPI') as upi_orders,
      cast(sum(case when city_tier = 'tier3' then amount_inr else 0 end) as double) as tier3_amount,
      count(*) filter (city_tier = 'tier3') as tier3_orders from orders_fact group by 1""",
    ),
)
def a3(spark, root):
    conditions = {"upi": F.col("payment_method") == "UPI", "tier3": F.col("city_tier") == "tier3"}
    return A.conditional_sums(B.orders_fact(spark, root), ["seller_id"], "amount_inr", conditions)


@query(
    "a4_active_hours",
    using(
        "orders_fact",
        """select seller_id, array_to_string(list_sort(list(distinct order_hour)), ',') as active_hours
      from orders_fact group by 1""",
    ),
)
def a4(spark, root):
    return A.value_sets(B.orders_fact(spark, root), ["seller_id"], "order_hour", "active_hours")


A5 = f"""select count(*) as total_orders, {rnd('cast(coalesce(sum(amount_inr), 0) as double)', 2)} as total_revenue_inr,
  {rnd('(cast(coalesce(sum(amount_inr), 0) as double) / greatest(1, count(*)))', 2)} as avg_order_value from orders_placed"""


@query("a5_overall_totals", using("orders_placed", A5))
def a5(spark, root):
    return A.overall_totals(B.orders_placed(spark, root))


A6 = " union all ".join(
    f"select '{d}' as dimension, {d} as value, count(*) as orders, cast(sum(amount_inr) as double) as revenue"
    f" from orders_placed group by {d}"
    for d in ("category", "city", "payment_method", "city_tier")
)


@query("a6_counters", using("orders_placed", A6))
def a6(spark, root):
    return A.counters(B.orders_placed(spark, root), ["category", "city", "payment_method", "city_tier"])


@query(
    "scalar_map",
    using(
        "orders_placed",
        f"""select dimension, concat('{{', string_agg(concat('"', value, '":', orders), ',' order by value), '}}') as orders_by_value,
      count(*) as n_values, max(orders) as most, max(case when value in ('tier1', 'C1') then orders end) as known
      from ({A6}) t group by dimension""",
    ),
)
def scalar_map(spark, root):
    """Distributions as maps, looked up, and stored as JSON."""
    maps = A.distributions(A.counters(B.orders_placed(spark, root), ["category", "city", "payment_method", "city_tier"]))
    by = F.col("orders_by_value")
    known = F.coalesce(F.try_element_at(by, F.lit("tier1")), F.try_element_at(by, F.lit("C1")))
    looked = maps.select("dimension", by, F.size(by).cast("bigint").alias("n_values"), F.array_max(F.map_values(by)).alias("most"), known.alias("known"))
    return Wh.stringify_nested(looked)


@query(
    "a2_daily_sketches",
    using(
        "orders_fact",
        "select category, true as customers_near, true as dates_near from orders_fact group by 1",
    ),
)
def a2_sketches(spark, root):
    """Sketches per day and category, merged over the days, lie within four standard errors of the exact counts."""
    orders, cols = B.orders_fact(spark, root), ["customer_id", "order_date"]
    merged = A.sketched_counts(A.distinct_sketches(orders, ["order_date", "category"], cols), ["category"], cols)
    exact = A.distinct_counts(orders, ["category"], cols).withColumnsRenamed({f"distinct_{c}": f"exact_{c}" for c in cols})
    near = lambda c: F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= F.greatest(F.lit(1.0), F.col(f"exact_{c}") * 4 * 1.04 / 64)
    return merged.join(exact, "category").select("category", near("customer_id").alias("customers_near"), near("order_date").alias("dates_near"))


@query(
    "a7_shares",
    using(
        "orders_placed",
        f"""select payment_method, n, {pct('n', '(select count(*) from orders_placed)', 1)} as share_pct
      from (select payment_method, count(*) as n from orders_placed group by 1) t""",
    ),
)
def a7(spark, root):
    return A.shares(B.orders_placed(spark, root), "payment_method")


@query(
    "a8_duplicate_keys",
    "select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
)
def a8(spark, root):
    return A.duplicate_keys(B.table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "a9_one_per_key",
    using(
        "orders_fact",
        f"""select seller_id, customer_id, {day('order_date')} as order_date, order_id from
      (select *, row_number() over (partition by seller_id, customer_id order by order_date, order_id) as rn
       from orders_fact) t where rn = 1""",
    ),
)
def a9(spark, root):
    slim = B.orders_fact(spark, root).select("seller_id", "customer_id", "order_date", "order_id")
    return A.one_per_key(slim, ["seller_id", "customer_id"], ["order_date", "order_id"])


@query("a10_pair_frequency", using("orders_fact", A10.format(n=10)))
def a10(spark, root):
    from bazaarflow.plans.fraud_patterns import collusion_pairs

    return collusion_pairs(B.orders_fact(spark, root))


@query(
    "a14_first_order_date",
    using(
        "orders_fact",
        f"""select order_id, customer_id, {day('min(order_date) over (partition by customer_id)')} as first_order_date
      from orders_fact""",
    ),
)
def a14(spark, root):
    slim = B.orders_fact(spark, root).select("order_id", "customer_id", "order_date")
    return A.with_group_minimum(slim, "customer_id", "order_date", "first_order_date").drop("order_date")


# ---- scalar functions -----------------------------------------------------------------


@query(
    "scalar_functions",
    f"""select p_partkey, {rnd('p_retailprice', 1)} as rounded, p_partkey % 7 as modulo,
    upper(p_name) as up, coalesce(nullif(p_size, 1), 0)::bigint as defaulted from part""",
)
def scalar(spark, root):
    return B.table(spark, root, "part").select(
        "p_partkey",
        round_half_up("p_retailprice", 1).alias("rounded"),
        (F.col("p_partkey") % 7).alias("modulo"),
        F.upper("p_name").alias("up"),
        F.coalesce(F.nullif("p_size", F.lit(1)), F.lit(0)).alias("defaulted"),
    )


@query(
    "scalar_math",
    f"""select s_suppkey, abs(s_acctbal) as magnitude, greatest(s_acctbal, 0::double) as floored,
    least(s_acctbal, 100::double) as capped, cast(ceil(s_acctbal / 100) as bigint) as hundreds,
    {rnd('s_acctbal', 0)} as whole, s_acctbal / greatest(1::double, s_suppkey) as floored_ratio from supplier""",
)
def scalar_math(spark, root):
    c = F.col("s_acctbal")
    return B.table(spark, root, "supplier").select(
        "s_suppkey",
        F.abs(c).alias("magnitude"),
        F.greatest(c, F.lit(0.0)).alias("floored"),
        F.least(c, F.lit(100.0)).alias("capped"),
        F.ceil(c / 100).alias("hundreds"),
        round_half_up(c, 0).alias("whole"),
        floored_ratio(c, "s_suppkey").alias("floored_ratio"),
    )


@query(
    "scalar_date",
    f"""select o_orderkey, {day('date_trunc(' + "'week', o_orderdate)")} as week,
    datediff('day', date '1995-01-01', cast(o_orderdate as date)) as days,
    cast(floor(datediff('day', cast(date_trunc('week', date '1995-01-01') as date),
      cast(date_trunc('week', o_orderdate) as date)) / 7) as bigint) as weeks,
    strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month, strftime(o_orderdate, '%d') as day
    from orders""",
)
def scalar_date(spark, root):
    d = F.col("o_orderdate").cast("date")
    start = F.lit("1995-01-01").cast("date")
    return B.table(spark, root, "orders").select(
        "o_orderkey",
        week_start(d).alias("week"),
        F.date_diff(d, start).alias("days"),
        weeks_between(week_start(d), week_start(start)).alias("weeks"),
        F.date_format(d, "yyyy").alias("year"),
        F.date_format(d, "MM").alias("month"),
        F.date_format(d, "dd").alias("day"),
    )


@query(
    "scalar_string",
    """select doc_id, md5(lower(text)) as lower_md5, substr(source, 2, 3) as part, length(trim(text, ' ')) as trimmed_length,
    replace(lang, 'e', '_') as replaced, concat_ws(' | ', lang, source) as label,
    regexp_matches(lower(text), 'bahut|accha|mila|bilkul|deta|hoon') as marked from documents""",
)
def scalar_string(spark, root):
    return B.table(spark, root, "documents").select(
        "doc_id",
        F.md5(F.lower("text").cast("binary")).alias("lower_md5"),
        F.substring("source", 2, 3).alias("part"),
        F.length(F.trim("text")).alias("trimmed_length"),
        F.translate("lang", "e", "_").alias("replaced"),
        F.concat_ws(" | ", "lang", "source").alias("label"),
        (language_hint("text") == "hinglish").alias("marked"),
    )


@query(
    "scalar_json",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
    concat('{"event_id":', event_id, ',"user_id":', user_id, ',"event_type":"', event_type, '"}') as as_json,
    event_type in ('click', 'view') as listed, 2::bigint as pair_size from events""",
)
def scalar_json(spark, root):
    pair = F.array("user_id", "event_id")
    return B.table(spark, root, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct("event_id", "user_id", "event_type")).alias("as_json"),
        F.array_contains(F.array(F.lit("click"), F.lit("view")), F.col("event_type")).alias("listed"),
        F.size(pair).alias("pair_size"),
    )
