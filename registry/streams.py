"""S queries and the streaming forms of T, each fed from the given tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from bazaarflow import bindings as B
from bazaarflow.operators import alerts as Al, stock as St, windows as Wn
from bazaarflow.plans.dashboard import dashboard_lines, live_dashboard
from bazaarflow.plans.health import outputs_exist
from bazaarflow.plans.run_daily import run_daily
from bazaarflow.plans.category_trends import category_trends
from bazaarflow.plans.daily_revenue import daily_revenue
from bazaarflow.schemas import ORDERS
from bazaarflow.session import scratch_path
from bazaarflow.sources import events as Ev, lake as Lk, warehouse as Wh
from bazaarflow.streaming.fraud import FraudStream
from bazaarflow.streaming.inventory import InventoryStream
from bazaarflow.streaming.keyed import late_rows
from bazaarflow.streaming.metrics import LiveMetrics
from bazaarflow.streaming.runner import drop_repeats, read_output, run_bounded, run_to_files, write_output

from .base import SQL, big, day, dbl, query, stamp, using
from .events import AMOUNT, AS_OF, RULES, dashboard_sql, flat
from .marts import M1_CORE, M2_FIRST, M3_SQL, M5_SQL, m4_sql

# ---- feeding a stream from the event table --------------------------------------------

CUTS = ("2024-01-11", "2024-01-21")


def replay(spark, df, run, ts="ts"):
    """Publish events as JSON lines, ten days at a time, with one bounded run after each part.

    ``run`` gets the folder; every run goes on from the checkpoint of the one before. Events without a time come last.
    """
    path, results = scratch_path(spark, "topic"), []
    edges = [None, *CUTS, None]
    for low, high in zip(edges, edges[1:]):
        part = df
        if low:
            after = F.col(ts) >= F.to_timestamp(F.lit(low))
            part = part.filter(after if high else after | F.col(ts).isNull())
        if high:
            part = part.filter(F.col(ts) < F.to_timestamp(F.lit(high)))
        Ev.write_events(part, Ev.JsonFiles(path))
        results.append(run(path))
    return results


def replay_events(spark, root, handle, label):
    """Runs of a batch handler over the event stream; their progress."""
    checkpoint = scratch_path(spark, f"{label}-checkpoint")

    def run(path):
        return run_bounded(Ev.read_events(spark, Ev.JsonFiles(path)).drop(Ev.BROKEN), handle, checkpoint)

    return replay(spark, B.events_fact(spark, root), run)


def replay_to_end(spark, df, run, stream):
    """As ``replay``, then the end of the stream, with which everything that waits is done."""
    last = []

    def step(path):
        last[:] = [path]
        return run(stream(path))

    replay(spark, df, step)
    Ev.end_stream(spark, Ev.JsonFiles(last[0]))
    run(stream(last[0]))


EVENT_COLUMNS = f"""event_id, event_type, order_id, seller_id, product_id, {dbl('amount_inr')} as amount_inr, quantity,
  updated_stock, category, city, city_tier, payment_method, orders_last_minute,
  array_to_string(risk_signals, ',') as risk_signals, {stamp('ts')} as ts"""


@query("s1_read_events", using("events_fact", f"select {EVENT_COLUMNS} from events_fact"))
def s1(spark, root):
    out, checkpoint = scratch_path(spark, "s1"), scratch_path(spark, "s1-checkpoint")

    def run(path):
        return run_to_files(Ev.read_events(spark, Ev.JsonFiles(path)).drop(Ev.BROKEN), out, checkpoint)

    replay(spark, B.events_fact(spark, root), run)
    return spark.read.parquet(out)


@query("s2_write_events", using("events_fact", f"select {EVENT_COLUMNS} from events_fact"))
def s2(spark, root):
    path = scratch_path(spark, "s2")
    Ev.write_events(B.events_fact(spark, root), Ev.JsonFiles(path))
    return Ev.read_event_files(spark, path).drop(Ev.BROKEN)


@query(
    "s2_message_text",
    using(
        "events_fact",
        """select seller_id::varchar as key, concat('{"event_id":', event_id, ',"seller_id":', seller_id, ',"city":"', city,
      '","quantity":', quantity, '}') as value from events_fact""",
    ),
)
def s2_text(spark, root):
    slim = B.events_fact(spark, root).select("event_id", "seller_id", "city", "quantity")
    return Ev.to_messages(slim, key="seller_id")


ROUTED = """select event_id, case event_type when 'order_placed' then 'orders' when 'inventory_update' then 'inventory'
  else 'fraud_signals' end as zone, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day
  from events_fact"""


@query("s4_route_by_type", using("events_fact", ROUTED))
def s4(spark, root):
    routed = Lk.with_partitions(Lk.route_by_type(B.events_fact(spark, root)))
    return routed.select("event_id", *Lk.PARTITIONS)


def archive(spark, root):
    path = scratch_path(spark, "bronze")

    replay_events(spark, root, lambda batch, batch_id: Lk.archive_batch(batch, batch_id, path), "bronze")
    return path


@query(
    "s3_bronze_sink",
    using(
        "events_fact",
        f"""select r.* exclude (part), count(*) over (partition by zone, part) as _batch_size, true as stamped
      from (select *, case when year || month || day < '20240111' then 0 when year || month || day < '20240121' then 1
        else 2 end as part from ({ROUTED}) q) r""",
    ),
)
def s3(spark, root):
    path = archive(spark, root)
    stamped = F.col("_archived_at").isNotNull().alias("stamped")
    return Lk.read_lake(spark, path).select("event_id", *Lk.PARTITIONS, "_batch_size", stamped)


@query("s5_flush_all", using("events_fact", "select event_type, count(*) as events from events_fact group by 1"))
def s5(spark, root):
    """Everything is archived after one bounded run, also the last, partial batch."""
    path = archive(spark, root)
    return Lk.read_lake(spark, path).groupBy("event_type").agg(F.count("*").alias("events"))


@query(
    "s6_lake_inventory",
    using("events_fact", f"select zone, count(*) as events_archived, true as has_files from ({ROUTED}) t group by 1"),
)
def s6(spark, root):
    path = archive(spark, root)
    counters = Lk.archive_counters(Lk.lake_inventory(spark, path))
    has = (F.col("files_written") > 0) & (F.col("bytes") > 0)
    return counters.select("zone", "events_archived", has.alias("has_files"))


M1_ROWS = f"select * replace ({day('order_date')} as order_date) from ({M1_CORE}) t"


@query("s7_save_mart", using("orders_fact", M1_ROWS))
def s7(spark, root):
    path = Wh.save_mart(daily_revenue(B.orders_fact(spark, root), ordered=False), "daily_revenue", scratch_path(spark, "s7"))
    return spark.read.parquet(path).drop("avg_order_value", "upi_share_pct", "revenue_per_customer")


MIXED = """select p_partkey, p_name, p_size::bigint as p_size, null::varchar as s_name, null::bigint as s_suppkey from part
  union all select null, null, null, s_name, s_suppkey from supplier"""


@query("s8_read_mart", MIXED)
def s8(spark, root):
    """A mart of parquet and csv files with different columns."""
    path = scratch_path(spark, "s8")
    B.table(spark, root, "part").select("p_partkey", "p_name", "p_size").write.parquet(f"{path}/a")
    B.table(spark, root, "supplier").select("s_name", "s_suppkey").write.option("header", True).csv(f"{path}/b")
    out = Wh.read_mart(spark, path)
    return out.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query("u3_concat_files", MIXED)
def u3(spark, root):
    return s8(spark, root)


@query(
    "s9_load_warehouse",
    """select * from (values ('mart_category_trends', 'SKIPPED'), ('mart_cohort_retention', 'SKIPPED'),
    ('mart_daily_revenue', 'SUCCESS'), ('mart_fraud_patterns', 'SKIPPED'), ('mart_seller_performance', 'SKIPPED'))
    t("table", status)""",
)
def s9(spark, root):
    """One mart is there, the others are missing."""
    marts, out = scratch_path(spark, "s9"), scratch_path(spark, "s9-warehouse")
    Wh.save_mart(daily_revenue(B.orders_fact(spark, root), ordered=False), "daily_revenue", marts)
    return Wh.load_warehouse(spark, marts, out)


@query("s9_loaded_table", using("orders_fact", M1_ROWS))
def s9_table(spark, root):
    marts, out = scratch_path(spark, "s9"), scratch_path(spark, "s9-warehouse")
    Wh.save_mart(daily_revenue(B.orders_fact(spark, root), ordered=False), "daily_revenue", marts)
    Wh.load_warehouse(spark, marts, out)
    loaded = spark.read.parquet(f"{out}/mart_daily_revenue")
    return loaded.drop("avg_order_value", "upi_share_pct", "revenue_per_customer")


@query("s10_normalize_columns", "select p_partkey as part_key, p_name as part_name, p_type as part_type, p_brand as brand from part")
def s10(spark, root):
    raw = B.table(spark, root, "part").select(
        F.col("p_partkey").alias("Part Key"),
        F.col("p_name").alias("part-name"),
        F.col("p_type").alias("part.type"),
        F.col("p_brand").alias("BRAND"),
    )
    return Wh.normalize_columns(raw)


@query(
    "s11_stringify_nested",
    """select doc_id, concat('["', lang, '","', source, '"]') as tags,
    concat('{"doc_id":', doc_id, ',"lang":"', lang, '"}') as info from documents""",
)
def s11(spark, root):
    nested = B.table(spark, root, "documents").select(
        "doc_id", F.array("lang", "source").alias("tags"), F.struct("doc_id", "lang").alias("info")
    )
    return Wh.stringify_nested(nested)


@query(
    "s12_rows_to_table",
    using(
        "orders_fact",
        f"select * replace ({dbl('amount_inr')} as amount_inr, {day('order_date')} as order_date, {big('quantity')} as quantity)"
        " from orders_fact",
    ),
)
def s12(spark, root):
    path = scratch_path(spark, "s12")
    Ev.write_rows(B.orders_fact(spark, root), path)
    return Ev.read_rows(spark, path, ORDERS)


@query(
    "s15_console_lines",
    using(
        "orders_placed",
        """select order_id, concat('Order ID: ', order_id, ' | City: ', city, ' | Amount: ₹', amount_inr) as line
      from orders_placed""",
    ),
)
def s15(spark, root):
    return Ev.order_lines(B.orders_placed(spark, root))


LINES = f"""select section, place, concat(section, ' ', place, '. ', name, ': ', printf('%.2f', value),
  case when orders is null then '' else concat(' | ', orders, ' orders') end,
  case when share_pct is null then '' else concat(' | ', printf('%.1f', share_pct), '% ',
    repeat('█', cast(floor(share_pct / 3) as int))) end) as line from ({dashboard_sql(f"timestamp '{AS_OF}'")}) d"""


@query("s15_dashboard_lines", LINES)
def s15_dashboard(spark, root):
    return dashboard_lines(live_dashboard(B.orders_placed(spark, root), AS_OF))


@query(
    "s16_cached_input",
    using(
        "orders_fact",
        f"""select 'daily_revenue' as mart, count(*) as row_count from ({M1_CORE}) t
      union all select 'category_trends', count(*) from weekly""",
        also={"weekly": M5_SQL["weekly"]},
    ),
)
def s16(spark, root):
    path = scratch_path(spark, "s16")
    with Wh.cached_input(B.orders_fact(spark, root)) as orders:
        Wh.save_mart(daily_revenue(orders, ordered=False), "daily_revenue", path)
        Wh.save_mart(category_trends(orders, ordered=False), "category_trends", path)
    found = outputs_exist(spark, path)
    return found.filter("present").select("mart", "row_count")


RUN_ROWS = f"""select 'daily_revenue' as mart, count(*) as row_count from ({M1_CORE}) t
  union all select 'cohort_retention', count(*) from m2 union all select 'seller_performance', count(*) from m3
  union all select 'fraud_patterns', count(*) from m4 union all select 'category_trends', count(*) from m5"""
RUN_ALSO = M2_FIRST | M3_SQL | m4_sql("amount_inr", 100, 0.5) | M5_SQL


@query("m7_run_daily", using("orders_fact", RUN_ROWS, also=RUN_ALSO))
def m7(spark, root):
    done = run_daily(spark, B.orders_fact(spark, root), scratch_path(spark, "m7"))
    return done.select("mart", "row_count")


@query(
    "q8_outputs_exist",
    using("orders_fact", f"select *, true as present, row_count > 0 as passed from ({RUN_ROWS}) t", also=RUN_ALSO),
)
def q8(spark, root):
    path = scratch_path(spark, "q8")
    run_daily(spark, B.orders_fact(spark, root), path)
    return outputs_exist(spark, path)


# ---- streaming forms ------------------------------------------------------------------


def event_stream(spark):
    return lambda path: Ev.read_events(spark, Ev.JsonFiles(path)).drop(Ev.BROKEN)


def fraud_stream(spark):
    return FraudStream(spark, scratch_path(spark, "fraud"), delay_seconds=3600, rules=RULES, amount_rule=AMOUNT)


@query("t1_stream_velocity", SQL["t1_velocity_alerts"])
def t1_stream(spark, root):
    job = fraud_stream(spark)
    replay_to_end(spark, B.events_fact(spark, root), job.run_velocity, event_stream(spark))
    return flat(job.velocity())


@query("t2_stream_amounts", SQL["t2_amount_anomaly"])
def t2_stream(spark, root):
    job = fraud_stream(spark)
    replay_to_end(spark, B.events_fact(spark, root), job.run_amounts, event_stream(spark))
    return flat(job.amounts())


def inventory_stream(spark, root):
    schema = "product_id bigint, event_id bigint, order_id string, ts timestamp, action string, qty int"
    job = InventoryStream(spark, scratch_path(spark, "stock"), B.stock_seed(spark, root), delay_seconds=3600)
    events = B.stock_events(spark, root).withColumn("ts", F.timestamp_micros("at_us")).drop("at_us")
    replay_to_end(spark, events, job.run, lambda path: spark.readStream.schema(schema).json(path))
    return job


@query("t3_stream_allocation", SQL["t3_allocate_stock"])
def t3_stream(spark, root):
    return St.allocations(inventory_stream(spark, root).decisions())


@query("j3_stream_stock_join", SQL["t7_change_log"])
def j3(spark, root):
    """Orders of a stream meet the keyed stock state; what it reserves and sells."""
    return St.change_log(inventory_stream(spark, root).decisions())


@query("t8_live_metrics", dashboard_sql("(select max(ts) from orders_placed)"))
def t8(spark, root):
    job, stream = LiveMetrics(spark, scratch_path(spark, "metrics")), event_stream(spark)
    replay(spark, B.events_fact(spark, root), lambda path: job.run(stream(path)))
    return job.dashboard()


@query(
    "t11_run_bounded",
    """select count(*) as events, count(distinct case when ts < timestamp '2024-01-11' then 0
      when ts < timestamp '2024-01-21' then 1 else 2 end) as batches from events""",
)
def t11(spark, root):
    out = scratch_path(spark, "t11")

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    progress = reduce(DataFrame.unionAll, replay_events(spark, root, handle, "t11"))
    batches = progress.filter("input_rows > 0").agg(F.count("*").alias("b")).scalar()
    return read_output(spark, out).agg(F.count("*").alias("events")).withColumn("batches", batches)


@query("t12_stream_windows", SQL["t12_tumbling_windows"])
def t12_stream(spark, root):
    """Event-time windows behind a watermark, updated as events come in."""
    out, checkpoint = scratch_path(spark, "t12"), scratch_path(spark, "t12-checkpoint")

    def handle(batch, batch_id):
        batch.withColumn("seen_in", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run(path):
        events = Ev.read_events(spark, Ev.JsonFiles(path)).filter("event_type = 'order_placed'")
        counted = Wn.tumbling(events.withWatermark("ts", "1 hour"), "ts", "6 hours", ["category"], "amount_inr")
        return run_bounded(counted, handle, checkpoint, mode="update")

    replay(spark, B.events_fact(spark, root), run)
    # A window that got more events later appears again; its last state counts.
    rows = read_output(spark, out)
    newest = rows.groupBy("start", "end", "category").agg(F.max_by(F.struct("n", "total"), "seen_in").alias("s"))
    return newest.select("start", "end", "category", "s.n", "s.total")


LATE = """select event_id, category, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, mark // 1000 as watermark_ms from (
    select *, max(epoch_us(ts) // 1000 * 1000) filter (part < 1) over () - 3600000000 as mark_1,
      max(epoch_us(ts) // 1000 * 1000) filter (part < 2) over () - 3600000000 as mark_2,
      case part when 1 then mark_1 when 2 then mark_2 end as mark
    from (select *, least(2, case when ts < timestamp '2024-01-11' then 0 when ts < timestamp '2024-01-21' then 1 else 2 end
        + case when event_id % 40 = 0 then 1 else 0 end) as part from orders_placed) p) q
  where ts is null or epoch_us(ts) <= mark"""


def late_parts(df):
    """Every fortieth event comes one part late; ``sent`` stands for the time of sending."""
    number = F.when(F.col("ts") < F.lit("2024-01-11").cast("timestamp"), 0).when(F.col("ts") < F.lit("2024-01-21").cast("timestamp"), 1).otherwise(2)
    part = F.least(F.lit(2), number + F.when(F.col("event_id") % 40 == 0, 1).otherwise(0))
    return df.withColumn("sent", F.element_at(F.array(*[F.to_timestamp(F.lit(d)) for d in ("2024-01-01", *CUTS)]), part + 1))


@query("t12_late_rows", using("orders_placed", LATE))
def t12_late(spark, root):
    """Rows that windows behind a watermark leave out, kept with the watermark that they met."""
    out, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "late-checkpoint")
    schema = B.orders_placed(spark, root).schema

    def handle(batch, batch_id):
        write_output(batch.filter("late"), out, batch_id)

    def run(path):
        events = spark.readStream.schema(schema).json(path)
        return run_bounded(late_rows(events, "ts", 3600, ["event_id", "category"], F.col("event_id")), handle, checkpoint)

    replay(spark, late_parts(B.orders_placed(spark, root)), run, ts="sent")
    found = read_output(spark, out)
    return found.select("event_id", "category", F.timestamp_micros("at_us").alias("ts"), F.expr("watermark_us div 1000").alias("watermark_ms"))


@query("a9_stream_drop_repeats", using("events_fact", "select event_id, seller_id from events_fact"))
def a9_stream(spark, root):
    """Every event sent twice, kept once."""
    events = B.events_fact(spark, root).select("event_id", "seller_id", "ts")
    schema = "event_id bigint, seller_id bigint, ts timestamp"
    out, checkpoint = scratch_path(spark, "a9"), scratch_path(spark, "a9-checkpoint")

    def run(path):
        once = drop_repeats(spark.readStream.schema(schema).json(path), ["event_id"], "ts", "31 days")
        return run_to_files(once, out, checkpoint)

    replay(spark, events.unionAll(events), run)
    return spark.read.parquet(out).drop("ts")
