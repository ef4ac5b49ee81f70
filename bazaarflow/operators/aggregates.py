"""Grouped and global aggregates. All of them combine on the map side first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from ..functions.numeric import floored_ratio, mean, money_sum, percent, round_half_up


def totals_by(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Sum, count and average of an amount per key."""
    return df.groupBy(*keys).agg(
        money_sum(amount).alias("total"), F.count(amount).alias("n"), mean(amount).alias("average")
    )


def totals_with_distincts(df: DataFrame, keys: list[str], sums: dict[str, Column], distinct: dict[str, str]) -> DataFrame:
    """Sums of row values, and numbers of distinct values of several columns, per key.

    ``distinct`` maps a name to its column. Several distinct counts in one aggregate would copy every row once for each of them;
    here the distinct pairs of key and value are found column by column, each from two columns of the input, and what is
    left of a pair is a one that adds up beside the sums. The last aggregate combines on the map side, so no key is one task.
    """
    valued = df.select(*keys, *[value.alias(name) for name, value in sums.items()])
    types = {f.name: f.dataType for f in valued.schema.fields if f.name in sums} | {name: T.LongType() for name in distinct}

    def filled(part: DataFrame, given: dict[str, Column]) -> DataFrame:
        return part.select(*keys, *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items()])

    rows = filled(valued if sums else valued.distinct(), {n: F.col(n) for n in sums})
    for name, column in distinct.items():
        value = F.col(column).alias("_value")
        pairs = df.filter(F.col(column).isNotNull()).select(*keys, value).distinct()
        rows = rows.unionAll(filled(pairs, {name: F.lit(1)}))
    counts = [F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in distinct]
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums], *counts)


def mark_first(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Add a flag that is true on one row of each combination of ``keys`` whose ``value`` is not null, and on no other row.

    The flags of a coarser key add up to its distinct values. Every row is sorted once, none is copied; the rows of one combination
    are one task, whose sort spills.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(0)))
    return df.withColumn(name, (place == 1) & F.col(value).isNotNull())


def distinct_counts(df: DataFrame, keys: list[str], columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values of several columns per key; exact unless asked otherwise."""
    if approximate:
        return df.groupBy(*keys).agg(*[F.approx_count_distinct(c).alias(f"distinct_{c}") for c in columns])
    return totals_with_distincts(df, keys, {}, {f"distinct_{c}": c for c in columns})


# Buckets of a sketch as a power of two; the relative error of an estimate is about 1.04 / sqrt(buckets).
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, keys: list[str], columns: list[str], bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable sketches of the distinct values per key, say per day; a few kilobytes each, to be stored."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"sketch_{c}") for c in columns])


def sketched_counts(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Estimates of the distinct values over merged sketches, for any coarser keys, without the rows themselves."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"distinct_{c}") for c in columns]
    return sketches.groupBy(*keys).agg(*merged)


def conditional_sums(df: DataFrame, keys: list[str], amount: str, conditions: dict[str, Column]) -> DataFrame:
    """Amount and row count per key under each named condition."""
    zero = F.lit(0).cast("decimal(18,2)")
    aggs = []
    for name, cond in conditions.items():
        aggs.append(money_sum(F.when(cond, F.col(amount)).otherwise(zero)).alias(f"{name}_amount"))
        aggs.append(F.count_if(cond).alias(f"{name}_orders"))
    return df.groupBy(*keys).agg(*aggs)


def value_sets(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Sorted set of a column per key; meant for columns with few values, like an hour."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(column)).alias(name))


def overall_totals(df: DataFrame, amount: str = "amount_inr") -> DataFrame:
    """One row: orders, revenue, average order value; zeros for an empty input."""
    base = df.agg(F.count("*").alias("total_orders"), F.coalesce(money_sum(amount), F.lit(0.0)).alias("revenue"))
    return base.select(
        "total_orders",
        round_half_up("revenue", 2).alias("total_revenue_inr"),
        round_half_up(floored_ratio("revenue", "total_orders"), 2).alias("avg_order_value"),
    )


def counters(df: DataFrame, dimensions: list[str], amount: str = "amount_inr") -> DataFrame:
    """Orders and revenue per value of each dimension, all dimensions in one pass."""
    width = len(dimensions)
    # grouping_id has a 0 bit, from the left, for the one dimension kept.
    names = {((1 << width) - 1) ^ (1 << (width - 1 - i)): d for i, d in enumerate(dimensions)}
    sets = df.groupingSets([[F.col(d)] for d in dimensions], *[F.col(d) for d in dimensions]).agg(
        F.grouping_id().alias("_g"), F.count("*").alias("orders"), money_sum(amount).alias("revenue")
    )
    dimension, value = None, None
    for gid, d in names.items():
        hit = F.col("_g") == gid
        dimension = F.when(hit, d) if dimension is None else dimension.when(hit, d)
        v = F.col(d).cast("string")
        value = F.when(hit, v) if value is None else value.when(hit, v)
    return sets.select(dimension.alias("dimension"), value.alias("value"), "orders", "revenue")


def distributions(counted: DataFrame) -> DataFrame:
    """One map from value to orders per dimension of ``counters``, the values in order; a null value is left out.

    Meant for dimensions of few values, as a dashboard shows them; the warehouse stores a map as JSON.
    """
    entries = F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("value", "orders"))))
    return counted.groupBy("dimension").agg(F.map_from_entries(entries).alias("orders_by_value"))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Count per key and its percent of the total, one decimal."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.greatest(F.count("*"), F.lit(1)).alias("total")).scalar()
    return counts.withColumn("share_pct", percent("n", total, 1))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``; copies are dropped before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def with_group_minimum(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Add the minimum of a column per key to every row.

    An aggregate joined back, not a window: a heavy key is combined on the map side and
    its rows are split by the skew join, so no task holds all of them.
    """
    least = df.groupBy(F.col(key).alias("_k")).agg(F.min(column).alias(name))
    return df.join(least, F.col(key).eqNullSafe(F.col("_k"))).drop("_k")


def signal_join(base: DataFrame, signals: list[DataFrame], key: str) -> DataFrame:
    """Left-join per-key signal tables onto a base table; each holds one row per key."""
    out = base
    for s in signals:
        out = out.join(s, key, "left")
    return out
