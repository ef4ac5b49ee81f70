"""Daily revenue by category and city tier."""

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import money_sum, percent, ratio, round_half_up
from ..operators.aggregates import mark_first

KEYS = ["order_date", "category", "city_tier", "is_sale_day"]


def daily_revenue(orders: DataFrame, upi: str = "UPI", ordered: bool = True) -> DataFrame:
    """The customers and sellers of a group are counted by marks on their first rows.

    Two distinct counts in one aggregate would hold three entries of every row in a task's hash map, as hardly any pair of group and
    customer repeats there; marked rows pass through two sorts, which spill, and the orders are still computed once.
    """
    amount = F.col("amount_inr")
    upi_amount = F.when(F.col("payment_method") == upi, amount).otherwise(F.lit(0).cast("decimal(18,2)"))
    rows = orders.select(
        *KEYS,
        "customer_id",
        "seller_id",
        amount.alias("amount"),
        upi_amount.alias("upi_amount"),
        F.col("order_id").isNotNull().alias("counted"),
    )
    rows = mark_first(rows, [*KEYS, "customer_id"], "customer_id", "new_customer")
    rows = mark_first(rows, [*KEYS, "seller_id"], "seller_id", "new_seller")
    daily = rows.groupBy(*KEYS).agg(
        money_sum("amount").alias("total_revenue"),
        F.count_if("counted").alias("order_count"),
        F.count_if("new_customer").alias("unique_customers"),
        F.count_if("new_seller").alias("active_sellers"),
        money_sum("upi_amount").alias("upi_revenue"),
    )
    out = (
        daily.withColumn("avg_order_value", ratio("total_revenue", "order_count"))
        .withColumn("upi_share_pct", percent("upi_revenue", "total_revenue"))
        .withColumn("revenue_per_customer", round_half_up(ratio("total_revenue", "unique_customers"), 2))
    )
    return out.orderBy("order_date", F.desc("total_revenue")) if ordered else out
