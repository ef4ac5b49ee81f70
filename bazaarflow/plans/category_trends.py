"""Week-over-week category trends. All windows run over weekly aggregates."""

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.dates import week_start
from ..functions.numeric import col, money_sum, percent
from ..operators.windows import step_change


def trend(change: str | Column, fast: float = 10.0) -> Column:
    pct = col(change)
    return (
        F.when(pct > fast, "GROWING_FAST")
        .when(pct > 0, "GROWING")
        .when(pct.isNull(), "BASELINE")
        .when(pct > -fast, "DECLINING")
        .otherwise("DECLINING_FAST")
    )


def weekly_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy(week_start("order_date").alias("order_week"), "category").agg(
        money_sum("amount_inr").alias("weekly_revenue"),
        F.count("order_id").alias("weekly_orders"),
        F.count_distinct("customer_id").alias("weekly_customers"),
    )


def category_trends(orders: DataFrame, ordered: bool = True) -> DataFrame:
    weekly = weekly_totals(orders)
    lagged = step_change(weekly, "category", "order_week", "weekly_revenue", "prev_week_revenue")
    lagged = step_change(lagged, "category", "order_week", "weekly_orders", "prev_week_orders")
    previous = F.col("prev_week_revenue")
    change = F.when(previous > 0, percent(F.col("weekly_revenue") - previous, previous))
    best = W.partitionBy("order_week").orderBy(F.desc("weekly_revenue"))
    out = (
        lagged.withColumn("revenue_wow_pct", change)
        .withColumn("trend", trend("revenue_wow_pct"))
        .withColumn("revenue_rank_this_week", F.dense_rank().over(best))
    )
    return out.orderBy("order_week", "revenue_rank_this_week") if ordered else out
