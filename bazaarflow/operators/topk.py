"""Sorting, limits and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.numeric import col, money_sum


def top_by_sum(df: DataFrame, key: str, amount: str, k: int = 10) -> DataFrame:
    """The k keys with the largest total; equal totals in key order."""
    totals = df.groupBy(key).agg(money_sum(amount).alias("total"))
    return totals.orderBy(F.desc("total"), F.asc(key)).limit(k)


def top_by_count(df: DataFrame, value: str, k: int) -> DataFrame:
    """The k most frequent values; equal counts by value, largest first."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.desc(value)).limit(k)


def kth_largest(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k-th largest value, copies counted; the smallest when there are fewer than k."""
    best = df.select(column).filter(F.col(column).isNotNull()).orderBy(F.desc(column)).limit(k)
    return best.agg(F.min(column).alias("kth_largest"))


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int, name: str = "place") -> DataFrame:
    """The first k rows of each group. Each task keeps only k rows per group before the shuffle."""
    w = W.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def stock_alert(available: str | Column, critical: int = 2) -> Column:
    return F.when(col(available) <= critical, "CRITICAL").otherwise("WARNING")


def low_stock(df: DataFrame, available: str = "available_stock", threshold: int = 5) -> DataFrame:
    """Products almost sold out, the scarcest first."""
    low = df.filter((F.col(available) > 0) & (F.col(available) <= threshold))
    return low.withColumn("alert_level", stock_alert(available)).orderBy(available, "product_id")


def urgent_reviews(reviews: DataFrame, limit: int = 10, when: str = "review_date") -> DataFrame:
    """Open urgent reviews: critical before high, newest first."""
    c = F.col
    level = F.when(c("urgency_level") == "CRITICAL", 1).otherwise(2)
    open_ = reviews.filter(c("urgency_level").isin("HIGH", "CRITICAL") & c("requires_action"))
    best = open_.select(
        "review_id", "seller_id", "city", "urgency_level", "primary_category", "one_line_summary", "suggested_action", when
    ).orderBy(level, F.desc(when), "review_id")
    return best.limit(limit)
