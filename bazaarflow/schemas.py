"""Data contracts."""

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("seller_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("amount_inr", T.DecimalType(18, 2)),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("city_tier", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_hour", T.IntegerType()),
        T.StructField("is_sale_day", T.BooleanType()),
        T.StructField("device_type", T.StringType()),
    ]
)

# One wide nullable record for the three event kinds.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("seller_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("amount_inr", T.DecimalType(18, 2)),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("updated_stock", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("city_tier", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("orders_last_minute", T.IntegerType()),
        T.StructField("risk_signals", T.ArrayType(T.StringType())),
        T.StructField("ts", T.TimestampType()),
    ]
)

ENRICHMENT = T.StructType(
    [
        T.StructField("sentiment", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("primary_category", T.StringType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("urgency_level", T.StringType()),
        T.StructField("key_entities", T.ArrayType(T.StringType())),
        T.StructField("one_line_summary", T.StringType()),
        T.StructField("requires_action", T.BooleanType()),
        T.StructField("suggested_action", T.StringType()),
    ]
)

VERDICT = T.StructType(
    [
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("sentiment_correct", T.BooleanType()),
        T.StructField("category_correct", T.BooleanType()),
        T.StructField("summary_accurate", T.BooleanType()),
        T.StructField("overall_verdict", T.StringType()),
        T.StructField("reasoning", T.StringType()),
    ]
)

# Event kind -> lake zone.
ZONES = {
    "order_placed": "orders",
    "inventory_update": "inventory",
    "seller_activity": "fraud_signals",
}

# Mart -> warehouse table.
MART_TABLES = {
    "daily_revenue": "mart_daily_revenue",
    "cohort_retention": "mart_cohort_retention",
    "seller_performance": "mart_seller_performance",
    "fraud_patterns": "mart_fraud_patterns",
    "category_trends": "mart_category_trends",
}
