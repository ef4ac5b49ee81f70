"""The daily run: validate, build the marts, save them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.ordered import DEFAULT, SkewPolicy
from ..session import scratch_path
from ..sources.warehouse import save_mart
from .category_trends import category_trends
from .cohort_retention import cohort_retention
from .daily_revenue import daily_revenue
from .fraud_patterns import fraud_patterns
from .health import outputs_exist
from .quality import all_passed, quality_report
from .seller_performance import seller_performance

# The columns that the checks and the five marts read.
NEEDED = [
    "order_id", "seller_id", "customer_id", "category", "amount_inr", "payment_method", "city", "city_tier",
    "order_date", "order_hour", "is_sale_day",
]


class ValidationFailed(Exception):
    """The input did not pass its checks; nothing was written."""


def run_daily(spark: SparkSession, orders: DataFrame, root: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Write the five marts under ``root``. Returns what exists afterwards, with row counts.

    The input is computed once; the columns needed go to the shared folder, where the checks and each mart read only
    their own. Marts are saved without a final sort: order belongs to the reader.
    """
    path = scratch_path(spark, "orders")
    orders.select(*NEEDED).write.parquet(path)
    kept = spark.read.schema(orders.select(*NEEDED).schema).parquet(path)
    report = quality_report(kept, "orders", ["order_id", "seller_id", "amount_inr"], ["order_id"])
    if not all_passed(report):
        raise ValidationFailed([r.message for r in report.filter("not passed").collect()])
    save_mart(daily_revenue(kept, ordered=False), "daily_revenue", root)
    save_mart(cohort_retention(kept, ordered=False), "cohort_retention", root)
    save_mart(seller_performance(kept, policy, ordered=False), "seller_performance", root)
    save_mart(fraud_patterns(kept, ordered=False), "fraud_patterns", root)
    save_mart(category_trends(kept, ordered=False), "category_trends", root)
    return outputs_exist(spark, root)
