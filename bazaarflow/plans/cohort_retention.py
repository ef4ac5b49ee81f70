"""Weekly cohort retention."""

from pyspark.sql import DataFrame, functions as F, Window as W

from ..functions.dates import week_start, weeks_between
from ..functions.numeric import percent


def customer_weeks(orders: DataFrame) -> DataFrame:
    """One row per customer and active week, with the customer's first week.

    The window runs over weeks, not orders: a customer has at most one row per week.
    """
    weekly = orders.groupBy("customer_id", week_start("order_date").alias("activity_week")).agg(
        F.sum("amount_inr").alias("revenue")
    )
    first = F.min("activity_week").over(W.partitionBy("customer_id"))
    return weekly.withColumn("cohort_week", first)


def cohort_retention(orders: DataFrame, ordered: bool = True) -> DataFrame:
    weeks = customer_weeks(orders).withColumn("weeks_since_signup", weeks_between("activity_week", "cohort_week"))
    # customer and week are unique here, so a row count is a distinct customer count.
    retained = weeks.groupBy("cohort_week", "weeks_since_signup").agg(
        F.count("*").alias("retained_users"),
        F.sum("revenue").cast("double").alias("cohort_revenue"),
    )
    # Cohort size is the week-0 row of the same cohort, at most one row per week to look at.
    at_zero = F.when(F.col("weeks_since_signup") == 0, F.col("retained_users"))
    size = F.max(at_zero).over(W.partitionBy("cohort_week"))
    out = retained.withColumn("cohort_size", size).withColumn(
        "retention_rate_pct", percent("retained_users", "cohort_size")
    )
    return out.orderBy("cohort_week", "weeks_since_signup") if ordered else out
