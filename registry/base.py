"""Registration of queries and the shared SQL inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaarflow.session import apply_rules

from .portable import portable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, root) -> DataFrame, with its SQL counterpart if it has one."""

    def add(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return portable(fn(apply_rules(spark), root))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def rnd(x: str, digits: int) -> str:
    """SQL twin of round_half_up."""
    s = f"{10**digits}.0::double"
    return f"(sign({x}) * floor(abs({x}) * {s} + 0.5::double) / {s} + 0.0::double)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def pct(num: str, den: str, digits: int = 2) -> str:
    return rnd(f"({dbl(num)} / nullif({dbl(den)}, 0) * 100.0::double)", digits)


def div(num: str, den: str) -> str:
    return f"({dbl(num)} / nullif({dbl(den)}, 0))"


K = "cast(json_extract_string(props, '$.k') as bigint)"

# Each shared input by name: the names it needs first, then its SQL.
INPUTS: dict[str, tuple[list[str], str]] = {
    "orders_fact": (
        [],
        """
    select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2))*100 as bigint)) as order_id,
      l_suppkey as seller_id, o_custkey as customer_id, l_partkey as product_id, p_type as category, p_brand as subcategory,
      cast(l_extendedprice as decimal(18,2)) as amount_inr, cast(l_quantity as int) as quantity,
      case o_orderpriority when '1-URGENT' then 'UPI' when '2-HIGH' then 'Credit Card' when '3-MEDIUM' then 'Debit Card'
        when '4-NOT SPECIFIED' then 'Net Banking' else 'Cash on Delivery' end as payment_method,
      n_name as city, r_name as state, concat('tier', n_nationkey % 3 + 1) as city_tier,
      cast(o_orderdate as date) as order_date, cast((l_orderkey*7+l_linenumber) % 24 as bigint) as order_hour,
      day(o_orderdate) in (7,14,21,28) as is_sale_day, c_mktsegment as device_type
    from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
      join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
      join region on n_regionkey=r_regionkey""",
    ),
    "events_fact": (
        [],
        f"""
    select event_id, case event_type when 'signup' then 'inventory_update' when 'error' then 'seller_activity'
        else 'order_placed' end as event_type,
      concat('ORD-', event_id) as order_id, user_id as seller_id, user_id as product_id,
      cast(value as decimal(18,2)) as amount_inr, {K} % 5 + 1 as quantity, {K} as updated_stock, event_type as category,
      concat('C', user_id % 12) as city, concat('tier', user_id % 3 + 1) as city_tier,
      concat('P', {K} % 5) as payment_method, {K} % 5 as orders_last_minute,
      case when {K} % 4 = 0 then ['stock_multiple_of_four'] else cast([] as varchar[]) end as risk_signals, ts
    from events""",
    ),
    "orders_placed": (["events_fact"], "select * from events_fact where event_type = 'order_placed'"),
    "stock_seed": (
        [],
        "select distinct user_id as product_id, cast(50 + user_id % 100 as int) as initial_stock from events",
    ),
    "stock_events": (
        ["events_fact"],
        """
    select product_id, event_id, order_id, epoch_us(ts) as at_us, action,
      case when action = 'update' then updated_stock else quantity end as qty
    from (select *, case when event_type = 'inventory_update' then 'update' when category = 'purchase' then 'sold'
        when event_type = 'order_placed' then 'order' end as action from events_fact) t
    where action is not null""",
    ),
    "reviews_fact": (
        [],
        """
    select concat('REV-', d.doc_id) as review_id, d.doc_id, text as review_text, d.doc_id % 50 as seller_id,
      source as product_category, lang as city,
      cast(case when toxic=1 then 1 + d.doc_id % 2 when quality=1 then 4 + d.doc_id % 2 when quality=0 then 2 else 3 end
        as bigint) as rating,
      date '2024-01-01' + cast(d.doc_id % 28 as int) as review_date,
      case when toxic=1 or quality=0 then 'NEGATIVE' when quality=1 then 'POSITIVE' else 'NEUTRAL' end as sentiment,
      cast(d.doc_id * 37 % 101 as double) / 100 as sentiment_score,
      ['LOW','MEDIUM','HIGH','CRITICAL'][d.doc_id % 4 + 1] as urgency_level,
      ['PRODUCT_QUALITY','DELIVERY','PRICING','FRAUD_SUSPICION','CUSTOMER_SERVICE','RETURN_REFUND',
        'GENERAL_FEEDBACK'][d.doc_id % 7 + 1] as primary_category,
      d.doc_id % 3 = 0 as requires_action, concat('summary ', d.doc_id) as one_line_summary, concat('action ', d.doc_id) as suggested_action,
      d.doc_id % 10 <> 0 as enrichment_success
    from documents d left join labels l on d.doc_id = l.doc_id""",
    ),
    "model_responses": (
        ["reviews_fact"],
        """
    select * exclude (body), case when doc_id % 17 = 0 then '{"sentiment": "POS'
        when doc_id % 5 = 0 then concat('```json', body, '```') else body end as raw_response
    from (select *, concat('{"sentiment":"', case when doc_id % 13 = 0 then 'ANGRY' else lower(sentiment) end,
        '","sentiment_score":', case when doc_id % 11 = 0 then '7' else '0' end, '.5,"primary_category":"',
        primary_category, '","urgency_level":"', urgency_level, '","key_entities":["a","b"],"one_line_summary":"',
        one_line_summary, '","requires_action":', case when requires_action then 'true' else 'false' end, '}') as body
      from reviews_fact) t""",
    ),
    "judge_responses": (
        ["reviews_fact"],
        """
    select * exclude (body, conf), case when doc_id % 23 = 0 then 'no verdict'
        when doc_id % 5 = 0 then concat('```json', chr(10), body, chr(10), '```') else body end as judge_response
    from (select *, concat('{"confidence_score":', cast(cast(conf as double) / 100 as varchar),
        ',"sentiment_correct":true,"category_correct":', case when doc_id % 3 <> 0 then 'true' else 'false' end,
        ',"summary_accurate":true,"overall_verdict":"',
        case when (conf >= 70) <> (doc_id % 19 = 0) then 'PASS' else 'FAIL' end, '","reasoning":"r', doc_id, '"}') as body
      from (select *, doc_id * 37 % 101 as conf from reviews_fact) t) u""",
    ),
    "vectors": (
        [],
        """
    select concat('REV-', vec_id) as review_id, vec_id, embedding, label,
      case label % 3 when 0 then 'POSITIVE' when 1 then 'NEGATIVE' else 'NEUTRAL' end as sentiment from embeddings""",
    ),
    "search_queries": (
        [],
        "select label as query_id, min_by(embedding, vec_id) as query_vector from embeddings group by label",
    ),
    "edges": (
        [],
        """
    select distinct src, dst from (
      select cast(floor(p_partkey / 3) as bigint) as src, p_partkey as dst from part where p_partkey > 0
      union all select cast(floor(p_partkey / 2) as bigint), p_partkey from part where p_partkey > 0) t""",
    ),
    "hourly_series": (
        [],
        """
    select series, h, n, row_number() over (partition by series order by h) - 1 as pos
    from (select event_type as series, date_trunc('hour', ts) as h, count(*) as n from events group by 1, 2) t""",
    ),
}


def using(names: str, body: str, recursive: bool = False, also: dict[str, str] | None = None) -> str:
    """SQL over shared inputs, given as a space-separated list; ``also`` adds more of them."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        needs, text = INPUTS[name]
        for n in needs:
            add(n)
        ordered[name] = text

    for name in names.split():
        add(name)
    ordered |= also or {}
    parts = ", ".join(f"{n} as ({t})" for n, t in ordered.items())
    word = "with recursive " if recursive else "with "
    return word + parts + " " + body
