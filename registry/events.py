"""T queries (batch forms), K8, A13 over stock, M6."""

from pyspark.sql import functions as F

from bazaarflow import bindings as B
from bazaarflow.functions.dates import from_micros, micros
from bazaarflow.operators import alerts as Al, stock as St, topk, windows as Wn
from bazaarflow.operators.counters import write_counted
from bazaarflow.plans.dashboard import DISTRIBUTIONS, live_dashboard, snapshot_maps
from bazaarflow.session import scratch_path

from .base import big, pct, query, rnd, stamp, using

# The events are sparse, so the rules run with days instead of minutes.
RULES = (
    Al.VelocityRule("VELOCITY_1DAY", 86_400, 4, "HIGH", "FLAG_FOR_REVIEW", "1 day"),
    Al.VelocityRule("VELOCITY_3DAY", 259_200, 9, "CRITICAL", "FREEZE_SELLER_ACCOUNT", "3 days"),
)
AMOUNT = Al.AmountRule(window_seconds=604_800, factor=3.0)


def alert_id(rule):
    return f"concat('ALERT-', upper(substr(md5(concat_ws('|', seller_id, event_id, {rule})), 1, 16)))"


def velocity_sql(rules):
    parts = []
    for r in rules:
        parts.append(
            f"""select {alert_id(f"'{r.name}'")} as alert_id, seller_id, event_id, '{r.name}' as alert_type,
        '{r.severity}' as severity, concat('Seller placed ', n, ' orders in {r.label}') as description,
        n as orders_in_window, {r.threshold}::bigint as threshold, {r.window_seconds}::bigint as window_seconds,
        {stamp('ts')} as ts, '{r.action}' as action_recommended
        from (select *, count(*) over (partition by seller_id order by ts
          range between interval {r.window_seconds} seconds preceding and current row) as n from orders_placed) t
        where n > {r.threshold}"""
        )
    return " union all ".join(parts)


def flat(alerts):
    return alerts.select("*", "evidence.*").drop("evidence")


@query("t1_velocity_alerts", using("orders_placed", velocity_sql(RULES)))
def t1(spark, root):
    return flat(Al.velocity_alerts(B.orders_placed(spark, root), RULES))


@query("t1_velocity_alerts_defaults", using("orders_placed", velocity_sql(Al.VELOCITY_RULES)))
def t1_defaults(spark, root):
    return flat(Al.velocity_alerts(B.orders_placed(spark, root)))


AMOUNT_FOLD = {
    "judged": """select *, row_number() over (partition by seller_id order by ts, event_id) as i from (
      select seller_id, event_id, ts, cast(amount_inr as double) as amount, count(*) over w as n,
        cast(sum(amount_inr) over w as double) / cast(count(*) over w as double) as average from orders_placed
      window w as (partition by seller_id order by ts range between interval 604800 seconds preceding and current row)
      ) t where n >= 5""",
    "fold": """select seller_id, event_id, ts, amount, i, average as baseline from judged where i = 1
      union all select j.seller_id, j.event_id, j.ts, j.amount, j.i,
        0.9::double * f.baseline + 0.1::double * f.amount
      from fold f join judged j on j.seller_id = f.seller_id and j.i = f.i + 1""",
}
AMOUNT_SQL = f"""select {alert_id("'AMOUNT_ANOMALY'")} as alert_id, seller_id, event_id, 'AMOUNT_ANOMALY' as alert_type,
  'MEDIUM' as severity, concat('Order ', cast(floor(amount + 0.5::double) as bigint), ' is 3x above avg ',
    cast(floor(baseline + 0.5::double) as bigint)) as description, amount as order_amount,
  {rnd('baseline', 2)} as seller_avg, {rnd('(amount / greatest(1.0::double, baseline))', 1)} as ratio, {stamp('ts')} as ts,
  'MANUAL_REVIEW' as action_recommended from fold where amount > baseline * 3.0::double"""


@query("t2_amount_anomaly", using("orders_placed", AMOUNT_SQL, recursive=True, also=AMOUNT_FOLD))
def t2(spark, root):
    return flat(Al.amount_alerts(B.orders_placed(spark, root), AMOUNT))


@query(
    "t2_amount_baselines",
    using(
        "orders_placed",
        "select seller_id, event_id, amount, baseline from fold",
        recursive=True,
        also=AMOUNT_FOLD,
    ),
)
def t2_baselines(spark, root):
    return Al.amount_baselines(B.orders_placed(spark, root), AMOUNT).select("seller_id", "event_id", "amount", "baseline")


STOCK = {
    "numbered": """select *, row_number() over (partition by product_id order by at_us, event_id) as i from stock_events""",
    "fold": """select product_id, 0::bigint as i, null::bigint as event_id, null::varchar as order_id, null::varchar as action,
        0::bigint as qty, 0::bigint as stock_before, initial_stock::bigint as stock_after, 0::bigint as reserved_before,
        0::bigint as reserved_after from stock_seed
      union all
      select n.product_id, n.i, n.event_id, n.order_id, n.action, n.qty, f.stock_after,
        case n.action when 'update' then n.qty when 'sold' then greatest(0, f.stock_after - n.qty) else f.stock_after end,
        f.reserved_after,
        case when n.action = 'sold' then greatest(0, f.reserved_after - n.qty)
          when n.action = 'order' and f.stock_after - f.reserved_after > 0
            and f.stock_after - f.reserved_after >= n.qty then f.reserved_after + n.qty
          else f.reserved_after end
      from fold f join numbered n on n.product_id = f.product_id and n.i = f.i + 1""",
    "decided": """select *, greatest(0, stock_before - reserved_before) as available from fold where i > 0""",
    "outcome": """select product_id, event_id, order_id, available, qty as requested,
      case when available <= 0 then 'OUT_OF_STOCK' when available < qty then 'INSUFFICIENT_STOCK' else 'APPROVED' end as reason
      from decided where action = 'order'""",
    "state": """select product_id, stock_after as stock, reserved_after as reserved,
      greatest(0, stock_after - reserved_after) as available_stock
      from (select *, row_number() over (partition by product_id order by i desc) as back from fold) t where back = 1""",
}


def decisions(spark, root):
    return St.stock_decisions(B.stock_events(spark, root), B.stock_seed(spark, root))


def stock_sql(body):
    return using("stock_events stock_seed", body, recursive=True, also=STOCK)


@query(
    "t3_allocate_stock",
    stock_sql(
        """select product_id, event_id, order_id, reason = 'APPROVED' as approved, reason, available, requested,
      case when reason = 'APPROVED' then available - requested end as remaining_after_reserve from outcome"""
    ),
)
def t3(spark, root):
    return St.allocations(decisions(spark, root))


@query(
    "t4_stock_updates",
    stock_sql(
        """select product_id, event_id, stock_before as old_stock, stock_after as new_stock, reserved_after,
      abs(stock_before - stock_after) > 10 as large_change from decided where action = 'update'"""
    ),
)
def t4(spark, root):
    return St.stock_updates(decisions(spark, root))


@query(
    "t5_confirmed_sales",
    stock_sql(
        """select product_id, event_id, order_id, qty, stock_after as new_stock, reserved_after
      from decided where action = 'sold'"""
    ),
)
def t5(spark, root):
    return St.confirmed_sales(decisions(spark, root))


@query(
    "t6_available_stock",
    stock_sql(
        """select p_partkey as product_id, coalesce(available_stock, 0) as available_stock
      from part left join state on p_partkey = product_id"""
    ),
)
def t6(spark, root):
    seed = B.stock_seed(spark, root)
    products = B.table(spark, root, "part").select(F.col("p_partkey").alias("product_id"))
    return St.available_stock(products, St.final_state(decisions(spark, root), seed))


@query(
    "t7_change_log",
    stock_sql(
        """select product_id, event_id, order_id, 'reserved' as action, requested as quantity, null::bigint as new_stock
      from outcome where reason = 'APPROVED'
      union all select product_id, event_id, order_id, 'sold', qty, stock_after from decided where action = 'sold'"""
    ),
)
def t7(spark, root):
    return St.change_log(decisions(spark, root))


@query(
    "k8_low_stock",
    stock_sql(
        """select product_id, available_stock, case when available_stock <= 2 then 'CRITICAL' else 'WARNING' end as alert_level
      from state where available_stock > 0 and available_stock <= 5"""
    ),
)
def k8(spark, root):
    state = St.final_state(decisions(spark, root), B.stock_seed(spark, root))
    return topk.low_stock(state.select("product_id", "available_stock"))


@query(
    "a13_stock_counters",
    stock_sql(
        f"""select *, {rnd('(approved::double / greatest(1::double, total_checks) * 100.0::double)', 2)} as approval_rate,
      (select count(*) from state) as products_tracked,
      (select count(*) from state where available_stock between 1 and 5) as low_stock_count
      from (select count(*) as total_checks, count(*) filter (reason = 'APPROVED') as approved,
        count(*) filter (reason = 'OUT_OF_STOCK') as rejected_no_stock,
        count(*) filter (reason = 'INSUFFICIENT_STOCK') as rejected_insufficient from outcome) t"""
    ),
)
def a13_stock(spark, root):
    """The decisions are written once; their counters come out of that write, the state is read from it."""
    decided, counters = write_counted(decisions(spark, root), scratch_path(spark, "decisions"), St.stock_numbers())
    return St.stock_stats(counters, St.final_state(decided, B.stock_seed(spark, root)))


@query(
    "t9_seller_signals",
    using(
        "events_fact",
        """select event_id, seller_id, array_to_string(risk_signals, ',') as risk_signals from events_fact
      where event_type = 'seller_activity' and len(risk_signals) > 0""",
    ),
)
def t9(spark, root):
    return Al.seller_signals(B.events_fact(spark, root))


ALERTS = {
    "alerts": f"""select alert_type, seller_id from ({velocity_sql(RULES)}) v
      union all select alert_type, seller_id from ({AMOUNT_SQL}) a"""
}


@query(
    "t10_fraud_counters",
    using(
        "orders_placed",
        """select 'alert_type' as kind, alert_type as name, count(*) as n from alerts group by 2
      union all select 'seller', seller_id::varchar, count(*) from alerts group by 2
      union all select 'total_alerts', '*', count(*) from alerts
      union all select 'total_orders', '*', count(*) from orders_placed""",
        recursive=True,
        also=AMOUNT_FOLD | ALERTS,
    ),
)
def t10(spark, root):
    orders = B.orders_placed(spark, root)
    velocity = Al.velocity_alerts(orders, RULES).select("alert_type", "seller_id")
    amounts = Al.amount_alerts(orders, AMOUNT).select("alert_type", "seller_id")
    return Al.fraud_counters(orders, velocity.unionByName(amounts))


# ---- event-time windows ---------------------------------------------------------------


@query(
    "t12_tumbling_windows",
    using(
        "orders_placed",
        f"""select {stamp("time_bucket(interval '6 hours', ts)")} as start,
      {stamp("time_bucket(interval '6 hours', ts) + interval '6 hours'")} as "end", category, count(*) as n,
      cast(sum(amount_inr) as double) as total from orders_placed group by all""",
    ),
)
def t12_tumbling(spark, root):
    return Wn.tumbling(B.orders_placed(spark, root), "ts", "6 hours", ["category"], "amount_inr")


@query(
    "t12_sliding_windows",
    using(
        "orders_placed",
        f"""select {stamp('start')} as start, {stamp("start + interval '6 hours'")} as "end", category, count(*) as n,
      cast(sum(amount_inr) as double) as total from (select *, unnest([time_bucket(interval '3 hours', ts),
        time_bucket(interval '3 hours', ts) - interval '3 hours']) as start from orders_placed) t group by start, category""",
    ),
)
def t12_sliding(spark, root):
    return Wn.tumbling(B.orders_placed(spark, root), "ts", "6 hours", ["category"], "amount_inr", slide="3 hours")


SESSIONS = {
    "timed": "select *, epoch_us(ts) as at_us from orders_placed",
    "marked": """select *, case when at_us - lag(at_us) over w < 21600000000 then 0 else 1 end as begins from timed
      window w as (partition by seller_id order by at_us, event_id)""",
    "numbered": """select *, cast(sum(begins) over (partition by seller_id order by at_us, event_id) as bigint) as session
      from marked""",
}


@query(
    "t12_sessions",
    using(
        "orders_placed",
        f"""select seller_id, session, {stamp('min(ts)')} as first_ts, {stamp('max(ts)')} as last_ts, count(*) as n,
      cast(sum(amount_inr) as double) as total from numbered group by 1, 2""",
        also=SESSIONS,
    ),
)
def t12_sessions(spark, root):
    orders = B.orders_placed(spark, root).select("seller_id", "event_id", "amount_inr", micros("ts").alias("at_us"))
    out = Wn.sessions(orders, "seller_id", "at_us", "event_id", "amount_inr", 6 * 3_600_000_000)
    return out.select(
        "seller_id", "session", from_micros("first_at").alias("first_ts"), from_micros("last_at").alias("last_ts"), "n", "total"
    )


# ---- dashboard ------------------------------------------------------------------------

AS_OF = "2024-01-28 12:00:00"


def dashboard_sql(as_of):
    def section(dim, label, score, limit, share):
        return f"""select '{label}' as section, place, name, {rnd('revenue', 2)} as value, orders, {share} as share_pct
          from (select *, row_number() over (order by {score} desc, name) as place from (select {dim}::varchar as name,
            count(*) as orders, cast(sum(amount_inr) as double) as revenue from upto group by 1) t) u where place <= {limit}"""

    parts = [
        f"""select m.section, m.place, m.name, m.value, null::bigint as orders, null::double as share_pct from (
        select unnest([
        {{section: 'summary', place: 1::bigint, name: 'total_orders', value: n::double}},
        {{section: 'summary', place: 2, name: 'total_revenue_inr', value: {rnd('r', 2)}}},
        {{section: 'summary', place: 3, name: 'avg_order_value', value: {rnd('(r / greatest(1::double, n))', 2)}}},
        {{section: 'rolling', place: 1, name: 'revenue_last_1min', value: {rnd('r1', 2)}}},
        {{section: 'rolling', place: 2, name: 'revenue_last_5min', value: {rnd('r5', 2)}}},
        {{section: 'rolling', place: 3, name: 'orders_last_1min', value: n1::double}},
        {{section: 'rolling', place: 4, name: 'avg_order_last_5min', value: {rnd('(r5 / greatest(1::double, n5))', 2)}}}
        ]) as m from totals) t""",
        section("category", "top_categories", "revenue", 5, pct("revenue", "(select greatest(1::double, r) from totals)", 1)),
        section("seller_id", "top_sellers", "revenue", 10, "null::double"),
        section("city", "top_cities", "orders", 5, "null::double"),
        section("payment_method", "payment_distribution", "orders", 1000000, pct("orders", "(select greatest(1, n) from totals)", 1)),
        section("city_tier", "city_tier_distribution", "orders", 1000000, pct("orders", "(select greatest(1, n) from totals)", 1)),
    ]
    since = f"filter (ts >= {as_of} - interval {{}} minutes)"
    also = {
        "upto": f"select * from orders_placed where ts <= {as_of}",
        "totals": f"""select count(*) as n, coalesce(sum(amount_inr), 0)::double as r,
          count(*) {since.format(1)} as n1, count(*) {since.format(5)} as n5,
          coalesce(sum(amount_inr) {since.format(1)}, 0)::double as r1,
          coalesce(sum(amount_inr) {since.format(5)}, 0)::double as r5 from upto""",
    }
    return using("orders_placed", " union all ".join(parts), also=also)


@query("m6_live_dashboard", dashboard_sql(f"timestamp '{AS_OF}'"))
def m6(spark, root):
    return live_dashboard(B.orders_placed(spark, root), AS_OF)


@query(
    "m6_snapshot_maps",
    f"""select d.section, name, share_pct, total_orders, total_revenue_inr from ({dashboard_sql(f"timestamp '{AS_OF}'")}) d,
      (select max(value) filter (name = 'total_orders') as total_orders, max(value) filter (name = 'total_revenue_inr') as total_revenue_inr
       from ({dashboard_sql(f"timestamp '{AS_OF}'")}) t where section = 'summary') s
      where d.section in ('payment_distribution', 'city_tier_distribution')""",
)
def m6_maps(spark, root):
    """The distributions of the snapshot as maps, taken apart again."""
    row = snapshot_maps(live_dashboard(B.orders_placed(spark, root), AS_OF))
    parts = [row.select(F.lit(d).alias("section"), F.explode(d).alias("name", "share_pct"), "total_orders", "total_revenue_inr") for d in DISTRIBUTIONS]
    return parts[0].unionByName(parts[1])
