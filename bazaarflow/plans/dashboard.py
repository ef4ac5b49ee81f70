"""Snapshot of the live dashboard at a point in time, as rows (section, place, name, ...)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.numeric import floored_ratio, percent, round_half_up
from ..operators.topk import top_per_group
from ..session import materialize

DIMENSIONS = ["category", "city", "payment_method", "city_tier", "seller_id"]

# What an order counts under when a field is missing.
MISSING = {"category": "Unknown", "city": "Unknown", "payment_method": "Unknown", "city_tier": "unknown", "seller_id": ""}


def with_defaults(orders: DataFrame) -> DataFrame:
    cols = {d: F.coalesce(F.col(d).cast("string"), F.lit(v)) for d, v in MISSING.items()}
    cols["amount_inr"] = F.coalesce(F.col("amount_inr"), F.lit(0).cast("decimal(18,2)"))
    return orders.select("ts", *[c.alias(n) for n, c in cols.items()])


def _grouped(orders: DataFrame):
    """Grouping by each dimension alone and by nothing, in one pass."""
    return orders.groupingSets([*[[F.col(d)] for d in DIMENSIONS], []], *[F.col(d) for d in DIMENSIONS])


def _dimension(gid: str) -> F.Column:
    full = (1 << len(DIMENSIONS)) - 1
    out = F.when(F.col(gid) == full, "all")
    for i, d in enumerate(DIMENSIONS):
        out = out.when(F.col(gid) == full ^ (1 << (len(DIMENSIONS) - 1 - i)), d)
    return out


def _labels() -> list[F.Column]:
    return [_dimension("g").alias("dimension"), F.coalesce(*DIMENSIONS, F.lit("*")).alias("name"), F.col("orders")]


def all_time_counters(orders: DataFrame) -> DataFrame:
    """Orders and exact revenue per value of each dimension and overall; adds up over batches."""
    sets = _grouped(orders).agg(F.grouping_id().alias("g"), F.count("*").alias("orders"), F.sum("amount_inr").alias("revenue"))
    return sets.select(*_labels(), "revenue")


def _recent_columns(now) -> list[F.Column]:
    def recent(minutes: int):
        return F.col("ts") >= now - F.make_dt_interval(mins=F.lit(minutes))

    amount, zero = F.col("amount_inr"), F.lit(0).cast("decimal(18,2)")
    return [
        F.count_if(recent(1)).alias("orders_1"),
        F.count_if(recent(5)).alias("orders_5"),
        F.sum(F.when(recent(1), amount).otherwise(zero)).alias("revenue_1"),
        F.sum(F.when(recent(5), amount).otherwise(zero)).alias("revenue_5"),
    ]


def _money(columns: tuple[str, ...]) -> list[F.Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]


def dashboard_counters(orders: DataFrame, as_of: str) -> DataFrame:
    """Counters up to a point in time with those of the last one and five minutes."""
    now = F.to_timestamp(F.lit(as_of))
    upto = with_defaults(orders).filter(F.col("ts") <= now)
    sets = _grouped(upto).agg(
        F.grouping_id().alias("g"), F.count("*").alias("orders"), F.sum("amount_inr").alias("revenue"), *_recent_columns(now)
    )
    return sets.select(*_labels(), "orders_1", "orders_5", *_money(("revenue", "revenue_1", "revenue_5")))


def add_recent(counters: DataFrame, recent: DataFrame) -> DataFrame:
    """All-time counters plus the last minutes of ``recent`` orders, as of the newest of them."""
    now = recent.agg(F.max("ts").alias("t")).scalar()
    last = recent.agg(*_recent_columns(now))
    extra = {c: last.select(c).scalar() for c in ("orders_1", "orders_5", "revenue_1", "revenue_5")}
    full = counters.withColumns(extra)
    return full.select("dimension", "name", "orders", "orders_1", "orders_5", *_money(("revenue", "revenue_1", "revenue_5")))


def snapshot(counters: DataFrame, k_sellers: int = 10, k: int = 5) -> DataFrame:
    """Dashboard sections from the counters, which are read several times."""
    # An aggregate, so that there is a row of zeros before the first order.
    numbers = ("orders", "orders_1", "orders_5", "revenue", "revenue_1", "revenue_5")
    total = counters.filter("dimension = 'all'").agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in numbers])
    revenue = total.select(F.greatest(F.lit(1.0), F.max("revenue")).alias("r")).scalar()
    orders = total.select(F.greatest(F.lit(1), F.max("orders")).alias("n")).scalar()

    def measure(section: str, place: int, name: str, value) -> F.Column:
        return F.struct(
            F.lit(section).alias("section"), F.lit(place).alias("place"), F.lit(name).alias("name"), value.alias("value")
        )

    c = F.col
    head = [
        measure("summary", 1, "total_orders", c("orders").cast("double")),
        measure("summary", 2, "total_revenue_inr", round_half_up("revenue", 2)),
        measure("summary", 3, "avg_order_value", round_half_up(floored_ratio("revenue", "orders"), 2)),
        measure("rolling", 1, "revenue_last_1min", round_half_up("revenue_1", 2)),
        measure("rolling", 2, "revenue_last_5min", round_half_up("revenue_5", 2)),
        measure("rolling", 3, "orders_last_1min", c("orders_1").cast("double")),
        measure("rolling", 4, "avg_order_last_5min", round_half_up(floored_ratio("revenue_5", "orders_5"), 2)),
    ]
    single = total.select(F.explode(F.array(*head)).alias("m")).select(
        "m.section",
        "m.place",
        "m.name",
        "m.value",
        F.lit(None).cast("bigint").alias("orders"),
        F.lit(None).cast("double").alias("share_pct"),
    )

    def section(dimension: str, label: str, score: str, limit: int | None, share=None) -> DataFrame:
        rows = counters.filter(c("dimension") == dimension)
        by = [F.desc(score), F.asc("name")]
        if limit is None:
            placed = rows.withColumn("place", F.row_number().over(W.partitionBy("dimension").orderBy(*by)))
        else:
            # Sellers are many: each task keeps only its own best before the shuffle.
            placed = top_per_group(rows, "dimension", by, limit)
        return placed.select(
            F.lit(label).alias("section"),
            "place",
            "name",
            round_half_up("revenue", 2).alias("value"),
            "orders",
            (share if share is not None else F.lit(None).cast("double")).alias("share_pct"),
        )

    parts = [
        single,
        section("category", "top_categories", "revenue", k, percent("revenue", revenue, 1)),
        section("seller_id", "top_sellers", "revenue", k_sellers),
        section("city", "top_cities", "orders", k),
        section("payment_method", "payment_distribution", "orders", None, percent("orders", orders, 1)),
        section("city_tier", "city_tier_distribution", "orders", None, percent("orders", orders, 1)),
    ]
    return reduce(DataFrame.unionByName, parts)


def live_dashboard(orders: DataFrame, as_of: str, k_sellers: int = 10, k: int = 5) -> DataFrame:
    return snapshot(materialize(dashboard_counters(orders, as_of)), k_sellers, k)


# Sections of the snapshot that are also shown as one map.
DISTRIBUTIONS = ("payment_distribution", "city_tier_distribution")


def snapshot_maps(sections: DataFrame, rows_per_second: float | None = None) -> DataFrame:
    """One row: totals, throughput if known, and each distribution as a map from name to percent of orders."""

    def of(section: str) -> F.Column:
        entries = F.collect_list(F.when(F.col("section") == section, F.struct("name", "share_pct")))
        return F.map_from_entries(F.array_sort(entries)).alias(section)

    total = lambda name: F.max(F.when((F.col("section") == "summary") & (F.col("name") == name), F.col("value"))).alias(name)
    row = sections.agg(total("total_orders"), total("total_revenue_inr"), *[of(d) for d in DISTRIBUTIONS])
    return row.withColumn("orders_per_second", F.lit(rows_per_second).cast("double"))


def dashboard_lines(sections: DataFrame) -> DataFrame:
    """One printable line per dashboard row, with a bar for shares."""
    bar = F.expr("repeat('█', cast(floor(share_pct / 3) as int))")
    share = F.concat(F.lit(" | "), F.format_string("%.1f", "share_pct"), F.lit("% "), bar)
    orders = F.concat(F.lit(" | "), F.col("orders").cast("string"), F.lit(" orders"))
    head = F.format_string("%s %d. %s: %.2f", "section", "place", "name", "value")
    line = F.concat(head, F.coalesce(orders, F.lit("")), F.when(F.col("share_pct").isNull(), "").otherwise(share))
    return sections.select("section", "place", line.alias("line"))
