"""Canonical inputs derived from the star-schema and event tables.

Each function is lazy and prunes to what its consumer selects; joins carry no broadcast
hints, so the optimizer decides from table sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from .functions.dates import micros


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def orders_fact(spark: SparkSession, root: str) -> DataFrame:
    """The 16-column order contract.

    Places are joined to customers, those to orders, and only then come the lines, so the
    largest table is shuffled for two joins at most.
    """
    c = F.col
    customers = (
        table(spark, root, "customer")
        .join(table(spark, root, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(table(spark, root, "region"), c("n_regionkey") == c("r_regionkey"))
    )
    placed = table(spark, root, "orders").join(customers, c("o_custkey") == c("c_custkey"))
    joined = (
        table(spark, root, "lineitem")
        .join(placed, c("l_orderkey") == c("o_orderkey"))
        .join(table(spark, root, "part"), c("l_partkey") == c("p_partkey"))
    )
    # Order priority -> payment method.
    payments = {
        "1-URGENT": "UPI",
        "2-HIGH": "Credit Card",
        "3-MEDIUM": "Debit Card",
        "4-NOT SPECIFIED": "Net Banking",
    }
    payment: Column | None = None
    for priority, method in payments.items():
        hit = c("o_orderpriority") == priority
        payment = F.when(hit, method) if payment is None else payment.when(hit, method)
    cents = (c("l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("order_id"),
        c("l_suppkey").alias("seller_id"),
        c("o_custkey").alias("customer_id"),
        c("l_partkey").alias("product_id"),
        c("p_type").alias("category"),
        c("p_brand").alias("subcategory"),
        c("l_extendedprice").cast("decimal(18,2)").alias("amount_inr"),
        c("l_quantity").cast("int").alias("quantity"),
        payment.otherwise("Cash on Delivery").alias("payment_method"),
        c("n_name").alias("city"),
        c("r_name").alias("state"),
        F.concat(F.lit("tier"), (c("n_nationkey") % 3 + 1).cast("string")).alias("city_tier"),
        c("o_orderdate").cast("date").alias("order_date"),
        ((c("l_orderkey") * 7 + c("l_linenumber")) % 24).cast("int").alias("order_hour"),
        F.dayofmonth("o_orderdate").isin(7, 14, 21, 28).alias("is_sale_day"),
        c("c_mktsegment").alias("device_type"),
    )


def events_fact(spark: SparkSession, root: str) -> DataFrame:
    """Order, inventory and seller events in one table."""
    return shape_events(table(spark, root, "events"))


# Raw event type -> event kind; all others are orders.
KINDS = {"signup": "inventory_update", "error": "seller_activity"}


def shape_events(raw: DataFrame) -> DataFrame:
    c = F.col
    k = F.get_json_object("props", "$.k").cast("int")
    kind: Column | None = None
    for raw_type, name in KINDS.items():
        hit = c("event_type") == raw_type
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    kind = kind.otherwise("order_placed")
    return raw.select(
        "event_id",
        kind.alias("event_type"),
        F.concat(F.lit("ORD-"), c("event_id").cast("string")).alias("order_id"),
        c("user_id").alias("seller_id"),
        c("user_id").alias("product_id"),
        c("value").cast("decimal(18,2)").alias("amount_inr"),
        (k % 5 + 1).alias("quantity"),
        k.alias("updated_stock"),
        c("event_type").alias("category"),
        F.concat(F.lit("C"), (c("user_id") % 12).cast("string")).alias("city"),
        F.concat(F.lit("tier"), (c("user_id") % 3 + 1).cast("string")).alias("city_tier"),
        F.concat(F.lit("P"), (k % 5).cast("string")).alias("payment_method"),
        (k % 5).alias("orders_last_minute"),
        F.when(k % 4 == 0, F.array(F.lit("stock_multiple_of_four")))
        .otherwise(F.array().cast("array<string>"))
        .alias("risk_signals"),
        c("ts").cast("timestamp").alias("ts"),
    )


def orders_placed(spark: SparkSession, root: str) -> DataFrame:
    """Order events only; the filter is on the raw type, so it reaches the scan."""
    raw = F.col("event_type")
    orders = table(spark, root, "events").filter(raw.isNull() | ~raw.isin(*KINDS))
    return shape_events(orders)


def stock_seed(spark: SparkSession, root: str) -> DataFrame:
    """Initial stock of every product seen."""
    products = table(spark, root, "events").select(F.col("user_id").alias("product_id")).distinct()
    return products.withColumn("initial_stock", (50 + F.col("product_id") % 100).cast("int"))


def stock_events(spark: SparkSession, root: str) -> DataFrame:
    """Actions on stock: clicks and views order, purchases confirm, signups set the level."""
    c = F.col
    action = (
        F.when(c("event_type") == "inventory_update", "update")
        .when(c("category") == "purchase", "sold")
        .when(c("event_type") == "order_placed", "order")
    )
    qty = F.when(action == "update", c("updated_stock")).otherwise(c("quantity"))
    return (
        events_fact(spark, root)
        .select("product_id", "event_id", "order_id", micros("ts").alias("at_us"), action.alias("action"), qty.alias("qty"))
        .filter(c("action").isNotNull())
    )


def reviews_fact(spark: SparkSession, root: str) -> DataFrame:
    """Reviews with their enrichment, over whole texts."""
    c = F.col
    d = table(spark, root, "documents").select("doc_id", "text", "lang", "source")
    r = d.join(table(spark, root, "labels"), "doc_id", "left")
    rating = (
        F.when(c("toxic") == 1, 1 + c("doc_id") % 2)
        .when(c("quality") == 1, 4 + c("doc_id") % 2)
        .when(c("quality") == 0, 2)
        .otherwise(3)
    )
    sentiment = (
        F.when((c("toxic") == 1) | (c("quality") == 0), "NEGATIVE").when(c("quality") == 1, "POSITIVE").otherwise("NEUTRAL")
    )
    urgencies = F.array(*[F.lit(u) for u in ("LOW", "MEDIUM", "HIGH", "CRITICAL")])
    categories = F.array(
        *[
            F.lit(x)
            for x in (
                "PRODUCT_QUALITY",
                "DELIVERY",
                "PRICING",
                "FRAUD_SUSPICION",
                "CUSTOMER_SERVICE",
                "RETURN_REFUND",
                "GENERAL_FEEDBACK",
            )
        ]
    )
    return r.select(
        F.concat(F.lit("REV-"), c("doc_id").cast("string")).alias("review_id"),
        "doc_id",
        c("text").alias("review_text"),
        (c("doc_id") % 50).alias("seller_id"),
        c("source").alias("product_category"),
        c("lang").alias("city"),
        rating.cast("int").alias("rating"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 28).cast("int")).alias("review_date"),
        sentiment.alias("sentiment"),
        ((c("doc_id") * 37 % 101).cast("double") / 100.0).alias("sentiment_score"),
        F.element_at(urgencies, (c("doc_id") % 4 + 1).cast("int")).alias("urgency_level"),
        F.element_at(categories, (c("doc_id") % 7 + 1).cast("int")).alias("primary_category"),
        (c("doc_id") % 3 == 0).alias("requires_action"),
        F.concat(F.lit("summary "), c("doc_id").cast("string")).alias("one_line_summary"),
        F.concat(F.lit("action "), c("doc_id").cast("string")).alias("suggested_action"),
        (c("doc_id") % 10 != 0).alias("enrichment_success"),
    )


def model_responses(spark: SparkSession, root: str) -> DataFrame:
    """Raw model text per review: some truncated, fenced, or with invalid values."""
    c = F.col
    body = F.concat(
        F.lit('{"sentiment":"'),
        F.when(c("doc_id") % 13 == 0, "ANGRY").otherwise(F.lower("sentiment")),
        F.lit('","sentiment_score":'),
        F.when(c("doc_id") % 11 == 0, "7").otherwise("0"),
        F.lit('.5,"primary_category":"'),
        c("primary_category"),
        F.lit('","urgency_level":"'),
        c("urgency_level"),
        F.lit('","key_entities":["a","b"],"one_line_summary":"'),
        c("one_line_summary"),
        F.lit('","requires_action":'),
        c("requires_action").cast("string"),
        F.lit("}"),
    )
    raw = (
        F.when(c("doc_id") % 17 == 0, '{"sentiment": "POS')
        .when(c("doc_id") % 5 == 0, F.concat(F.lit("```json"), body, F.lit("```")))
        .otherwise(body)
    )
    return reviews_fact(spark, root).withColumn("raw_response", raw)


def judge_responses(spark: SparkSession, root: str) -> DataFrame:
    """Raw judge text per review; confidence spreads over [0, 1], some are broken."""
    c = F.col
    confidence = c("doc_id") * 37 % 101
    body = F.concat(
        F.lit('{"confidence_score":'),
        (confidence.cast("double") / 100.0).cast("string"),
        F.lit(',"sentiment_correct":true,"category_correct":'),
        (c("doc_id") % 3 != 0).cast("string"),
        F.lit(',"summary_accurate":true,"overall_verdict":"'),
        F.when((confidence >= 70) != (c("doc_id") % 19 == 0), "PASS").otherwise("FAIL"),
        F.lit('","reasoning":"r'),
        c("doc_id").cast("string"),
        F.lit('"}'),
    )
    raw = F.when(c("doc_id") % 23 == 0, F.lit("no verdict")).when(
        c("doc_id") % 5 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    ).otherwise(body)
    return reviews_fact(spark, root).withColumn("judge_response", raw)


def vectors(spark: SparkSession, root: str) -> DataFrame:
    c = F.col
    label = c("label") % 3
    return table(spark, root, "embeddings").select(
        F.concat(F.lit("REV-"), c("vec_id").cast("string")).alias("review_id"),
        "vec_id",
        "embedding",
        "label",
        F.when(label == 0, "POSITIVE").when(label == 1, "NEGATIVE").otherwise("NEUTRAL").alias("sentiment"),
    )


def search_queries(spark: SparkSession, root: str) -> DataFrame:
    """One query vector for each label: the first vector of the label."""
    return (
        table(spark, root, "embeddings")
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.min_by("embedding", "vec_id").alias("query_vector"))
    )


def edges(spark: SparkSession, root: str) -> DataFrame:
    """Task graph over all parts: each part waits for p/3 and p/2."""
    p = table(spark, root, "part").select(F.col("p_partkey").alias("dst")).filter("dst > 0")
    parents = F.array(F.floor(F.col("dst") / 3), F.floor(F.col("dst") / 2)).cast("array<bigint>")
    return p.select(F.explode(F.array_distinct(parents)).alias("src"), "dst")


def hourly_series(spark: SparkSession, root: str) -> DataFrame:
    """Events per hour and type with a dense position; the window sees hours, not events."""
    counts = (
        table(spark, root, "events")
        .groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("h"))
        .agg(F.count("*").alias("n"))
    )
    pos = F.row_number().over(W.partitionBy("series").orderBy("h")) - 1
    return counts.withColumn("pos", pos.cast("bigint"))
