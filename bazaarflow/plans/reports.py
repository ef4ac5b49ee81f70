"""The views printed after a daily run."""

from pyspark.sql import DataFrame, functions as F


def latest_days(daily: DataFrame, limit: int = 6) -> DataFrame:
    return daily.orderBy(F.desc("order_date"), F.desc("total_revenue")).limit(limit)


def leaderboard(sellers: DataFrame, limit: int = 5) -> DataFrame:
    best = sellers.select("rank", "seller_id", "total_revenue", "total_orders", "seller_tier", "performance_score")
    return best.orderBy("rank", "seller_id").limit(limit)


def early_retention(cohorts: DataFrame, weeks: int = 3, limit: int = 12) -> DataFrame:
    early = cohorts.filter(F.col("weeks_since_signup") <= weeks)
    return early.orderBy("cohort_week", "weeks_since_signup").limit(limit)


def latest_trends(trends: DataFrame, limit: int = 6) -> DataFrame:
    return trends.orderBy(F.desc("order_week"), "revenue_rank_this_week", "category").limit(limit)


def high_risk_sellers(fraud: DataFrame, limit: int = 5) -> DataFrame:
    high = fraud.filter(F.col("fraud_risk_level") == "HIGH").select(
        "seller_id", "fraud_risk_level", "round_number_rate", "off_hours_rate", "fraud_signal_count"
    )
    return high.orderBy(F.desc("round_number_rate"), "seller_id").limit(limit)
