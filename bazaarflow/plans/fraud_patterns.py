"""Historical fraud signals."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import micros, seconds_to_micros
from ..functions.numeric import col, money_sum, ratio, round_half_up
from ..operators.ordered import DEFAULT, SkewPolicy, running


def is_round(amount: str | Column, multiple: int = 100) -> Column:
    return (col(amount) % F.lit(multiple) == 0).cast("int")


def is_off_hours(hour: str | Column, first: int = 7, last: int = 23) -> Column:
    return F.when((col(hour) < first) | (col(hour) > last), 1).otherwise(0)


def risk_level(signals: str | Column) -> Column:
    return F.when(col(signals) >= 2, "HIGH").when(col(signals) == 1, "MEDIUM").otherwise("LOW")


def fraud_patterns(
    orders: DataFrame,
    amount: str = "amount_inr",
    multiple: int = 100,
    round_limit: float = 0.5,
    hours: tuple[int, int] = (7, 23),
    off_limit: float = 0.3,
    ordered: bool = True,
) -> DataFrame:
    """Round-number and off-hours rates per seller, both from one aggregation."""
    base = orders.groupBy("seller_id").agg(
        F.sum(is_round(amount, multiple)).alias("round_number_orders"),
        F.count("order_id").alias("total_orders"),
        F.sum(is_off_hours("order_hour", *hours)).alias("off_hours_orders"),
        F.array_sort(F.collect_set("order_hour")).alias("active_hours"),
    )
    out = (
        base.withColumn("round_number_rate", round_half_up(ratio("round_number_orders", "total_orders"), 4))
        .withColumn("off_hours_rate", round_half_up(ratio("off_hours_orders", "total_orders"), 4))
        .withColumn("round_number_signal", F.coalesce(F.col("round_number_rate") > round_limit, F.lit(False)))
        .withColumn("timing_signal", F.coalesce(F.col("off_hours_rate") > off_limit, F.lit(False)))
        .withColumn(
            "fraud_signal_count", F.col("round_number_signal").cast("int") + F.col("timing_signal").cast("int")
        )
        .withColumn("fraud_risk_level", risk_level("fraud_signal_count"))
    )
    return out.orderBy(F.desc("fraud_signal_count"), F.desc("round_number_rate")) if ordered else out


def collusion_pairs(orders: DataFrame, more_than: int = 10) -> DataFrame:
    """How often each customer buys from each seller."""
    pairs = orders.groupBy("seller_id", "customer_id").agg(
        F.count("order_id").alias("pair_order_count"),
        money_sum("amount_inr").alias("pair_revenue"),
        F.count_distinct("order_date").alias("pair_active_days"),
    )
    return pairs.withColumn("collusion_signal", F.col("pair_order_count") > more_than)


def geo_impossible(
    events: DataFrame, customer: str, city: str, ts: str, tie: str, minutes: float = 30, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Consecutive orders of one customer from two cities within some minutes."""
    slim = events.select(customer, city, F.col(ts), tie, micros(ts).alias("at_us"))
    seen = running(slim, [customer], ["at_us", tie], previous={"prev_city": city, "prev_at": "at_us"}, policy=policy)
    gap = F.col("at_us") - F.col("prev_at")
    hit = (F.col(city) != F.col("prev_city")) & (gap <= seconds_to_micros(minutes * 60))
    return seen.filter(hit).select(customer, tie, ts, "prev_city", city, (gap / 1_000_000).alias("seconds_apart"))
