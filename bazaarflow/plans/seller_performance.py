"""Seller scoring and leaderboard."""

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import percent, ratio, round_half_up
from ..operators.aggregates import totals_with_distincts
from ..operators.ordered import DEFAULT, SkewPolicy
from ..operators.ranks import global_dense_rank, global_percent_rank
from ..session import materialize

# Percentile -> (metric it ranks, weight in the score).
WEIGHTS = {
    "revenue_percentile": ("total_revenue", 0.40),
    "volume_percentile": ("total_orders", 0.20),
    "reach_percentile": ("cities_reached", 0.15),
    "diversity_percentile": ("unique_customers", 0.15),
    "tier_reach_percentile": ("tier2_tier3_share", 0.10),
}

# Lowest score of each tier.
TIERS = {"PLATINUM": 0.8, "GOLD": 0.6, "SILVER": 0.4}


def seller_metrics(orders: DataFrame) -> DataFrame:
    def tier(name: str):
        return F.when(F.col("city_tier") == name, 1).otherwise(0)

    sums = {
        "total_revenue": F.col("amount_inr"),
        "total_orders": F.when(F.col("order_id").isNotNull(), 1).otherwise(0),
        "tier2_orders": tier("tier2"),
        "tier3_orders": tier("tier3"),
    }
    distinct = {"unique_customers": "customer_id", "cities_reached": "city", "categories_sold": "category", "active_days": "order_date"}
    base = totals_with_distincts(orders, ["seller_id"], sums, distinct).withColumn("total_revenue", F.col("total_revenue").cast("double"))
    outer = F.col("tier2_orders") + F.col("tier3_orders")
    return (
        base.withColumn("avg_order_value", ratio("total_revenue", "total_orders"))
        .withColumn("tier2_tier3_share", percent(outer, "total_orders"))
        .withColumn("revenue_per_active_day", round_half_up(ratio("total_revenue", "active_days"), 2))
    )


def seller_tier(score) -> F.Column:
    label = None
    for name, low in TIERS.items():
        label = F.when(score >= low, name) if label is None else label.when(score >= low, name)
    return label.otherwise("BRONZE")


def seller_performance(orders: DataFrame, policy: SkewPolicy = DEFAULT, ordered: bool = True) -> DataFrame:
    # One row per seller, used by both rank passes; computed once from the big table.
    sellers = materialize(seller_metrics(orders))
    ranks = global_percent_rank(sellers, "seller_id", {out: src for out, (src, _) in WEIGHTS.items()}, policy)
    total = None
    for out, (_, weight) in WEIGHTS.items():
        part = F.col(out) * F.lit(weight)
        total = part if total is None else total + part
    scored = materialize(sellers.join(ranks, "seller_id").withColumn("performance_score", round_half_up(total, 4)))
    tiered = scored.withColumn("seller_tier", seller_tier(F.col("performance_score")))
    out = global_dense_rank(tiered, "performance_score", "rank", descending=True, policy=policy)
    return out.orderBy("rank") if ordered else out
