"""Searches in series and capacity planning. All of them are mergeable aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def first_breach(df: DataFrame, key: str, pos: str, value: str, threshold: float) -> DataFrame:
    """First position of each series with value > threshold, -1 when there is none."""
    hit = F.min(F.when(F.col(value) > F.lit(threshold), F.col(pos)))
    return df.groupBy(key).agg(F.coalesce(hit, F.lit(-1)).alias("first_breach"))


def position_of(df: DataFrame, key: str, pos: str, value: str, target: float) -> DataFrame:
    """First position of each series with the target value, -1 when absent."""
    hit = F.min(F.when(F.col(value) == F.lit(target), F.col(pos)))
    return df.groupBy(key).agg(F.coalesce(hit, F.lit(-1)).alias("position"))


def store_sorted(df: DataFrame, key: str, pos: str, value: str, path: str, row_group_bytes: int = 8 << 20) -> None:
    """Series laid out by value: sorted files whose row groups cover narrow ranges, and beside them the list of series.

    A search for one value or for values above a bound then reads the few row groups that can hold it.
    """
    rows = df.select(key, pos, value)
    ranged = rows.repartitionByRange(value, pos).sortWithinPartitions(value, pos)
    ranged.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(f"{path}/rows")
    rows.select(key).distinct().write.mode("overwrite").parquet(f"{path}/series")


def _smallest(spark: SparkSession, path: str, hits: DataFrame, key: str, pos: str, name: str) -> DataFrame:
    found = hits.groupBy(F.col(key).alias("_key")).agg(F.min(pos).alias("_pos"))
    all_ = spark.read.parquet(f"{path}/series")
    joined = all_.join(found, all_[key].eqNullSafe(found["_key"]), "left")
    return joined.select(key, F.coalesce("_pos", F.lit(-1)).alias(name))


def position_in_sorted(spark: SparkSession, path: str, key: str, pos: str, value: str, target: float) -> DataFrame:
    """As ``position_of`` on stored series; the value goes to the scan."""
    hits = spark.read.parquet(f"{path}/rows").filter(F.col(value) == F.lit(target))
    return _smallest(spark, path, hits, key, pos, "position")


def breach_in_sorted(spark: SparkSession, path: str, key: str, pos: str, value: str, threshold: float) -> DataFrame:
    """As ``first_breach`` on stored series; the bound goes to the scan."""
    hits = spark.read.parquet(f"{path}/rows").filter(F.col(value) > F.lit(threshold))
    return _smallest(spark, path, hits, key, pos, "first_breach")


def min_batch_size(df: DataFrame, orders: str, limit: int, width: int = 1000) -> DataFrame:
    """Smallest batch size b with the sum of ceil(orders / b) at most ``limit``.

    The rows are reduced once to a histogram of distinct values. A pass tries up to
    ``width`` sizes at a time, so the answer takes log(max)/log(width) passes. The largest
    value when no size is enough; no row for an empty input.
    """
    histogram = df.groupBy(F.col(orders).cast("bigint").alias("o")).agg(F.count("*").alias("rows")).persist()
    try:
        low, high = 1, histogram.agg(F.max("o")).first()[0]
        if high is None:
            return df.sparkSession.createDataFrame([], "min_batch_size bigint")
        high = max(high, 1)
        while low < high:
            step = -(-(high - low) // width)
            sizes = F.sequence(*[F.lit(x).cast("bigint") for x in (low, high, step)])
            tried = histogram.select("o", "rows", F.explode(sizes).alias("b"))
            need = tried.groupBy("b").agg(F.sum(F.expr("(o + b - 1) div b * rows")).alias("batches"))
            best = need.filter(F.col("batches") <= limit).agg(F.min("b")).first()[0]
            if best is None:
                last_tried = low + (high - low) // step * step
                low = min(high, last_tried + 1)
            else:
                low, high = max(low, best - step + 1), best
        return df.sparkSession.createDataFrame([(int(high),)], "min_batch_size bigint")
    finally:
        histogram.unpersist()


def pair_sum(df: DataFrame, pos: str, amount: str, target: str) -> DataFrame:
    """The first row that completes a pair adding up to ``target``, with its latest partner.

    Gives (i, j, amount_i, amount_j) with the smallest j and then the largest i < j; empty
    when there is no pair. Values and complements meet in groups of one value pair, of
    which only the first positions are kept, so equal amounts never multiply.
    """
    goal = F.lit(target).cast("decimal(18,2)")
    base = df.select(F.col(pos).alias("pos"), F.col(amount).cast("decimal(18,2)").alias("a")).withColumn(
        "rest", (goal - F.col("a")).cast("decimal(18,2)")
    )
    a, rest = F.col("a"), F.col("rest")
    sides = (
        base.filter(a != rest)
        .groupBy(F.least(a, rest).alias("low"))
        .agg(F.min(F.when(a < rest, F.col("pos"))).alias("p_low"), F.min(F.when(a > rest, F.col("pos"))).alias("p_high"))
        .filter("p_low is not null and p_high is not null")
    )
    high = (goal - F.col("low")).cast("decimal(18,2)")
    different = sides.select(
        F.greatest("p_low", "p_high").alias("j"),
        F.when(F.col("p_low") > F.col("p_high"), F.col("low")).otherwise(high).alias("a_j"),
    )
    halves = base.filter(a == rest).select("pos", "a").orderBy("pos").limit(2)
    equal = halves.agg(F.count("*").alias("n"), F.max("pos").alias("j"), F.max("a").alias("a_j")).filter("n = 2")
    first = different.unionByName(equal.select("j", "a_j")).orderBy("j").limit(1)
    j, a_j = first.select("j").scalar(), first.select("a_j").scalar()
    partner = base.filter((F.col("pos") < j) & (F.col("rest") == a_j)).agg(F.max("pos").alias("i"))
    out = partner.filter(F.col("i").isNotNull()).select("i", j.alias("j"), a_j.alias("amount_j"))
    return out.select("i", "j", (goal - F.col("amount_j")).cast("decimal(18,2)").alias("amount_i"), "amount_j")
