"""Ranks over a whole table without sorting its rows in one task.

Rows are first counted per distinct value, so ties cost nothing; the distinct values are
cut into chunks and ranked with running sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .ordered import DEFAULT, SkewPolicy, running


def global_percent_rank(
    df: DataFrame, key: str, metrics: dict[str, str], policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """percent_rank of several metrics at once; ``metrics`` maps output name to column.

    ``key`` identifies a row. Nulls rank first. Read ``df`` is used more than once, so
    pass something cheap to recompute or materialized.
    """
    kinds = [df.schema[src].dataType for src in metrics.values()]
    exact = all(isinstance(k, (T.IntegralType, T.DecimalType)) for k in kinds)
    one_type = "decimal(38,10)" if exact else "double"
    pairs = [F.struct(F.lit(out).alias("metric"), F.col(src).cast(one_type).alias("value")) for out, src in metrics.items()]
    tall = df.select(key, F.explode(F.array(*pairs)).alias("p")).select(key, "p.metric", "p.value")
    distinct = tall.groupBy("metric", "value").agg(F.count("*").alias("rows"))
    upto = running(distinct, ["metric"], ["value"], sums={"upto": F.col("rows")}, policy=policy, cut_all=True)
    size = distinct.groupBy("metric").agg(F.sum("rows").alias("size"))
    ranked = upto.join(size, "metric").select(
        F.col("metric").alias("_metric"),
        F.col("value").alias("_value"),
        F.when(F.col("size") <= 1, F.lit(0.0))
        .otherwise((F.col("upto") - F.col("rows")).cast("double") / (F.col("size") - 1).cast("double"))
        .alias("rank"),
    )
    hit = (F.col("metric") == F.col("_metric")) & F.col("value").eqNullSafe(F.col("_value"))
    wide = tall.join(ranked, hit).groupBy(key)
    return wide.agg(*[F.max(F.when(F.col("metric") == out, F.col("rank"))).alias(out) for out in metrics])


def global_dense_rank(
    df: DataFrame, column: str, name: str, descending: bool = False, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Add dense_rank of ``column`` over the whole table, in the order of the column's own type.

    Nulls come first, with ``descending`` last.
    """
    distinct = df.select(F.col(column).alias("_v")).distinct()
    ranked = running(distinct, [], ["_v"], sums={name: F.lit(1)}, policy=policy, cut_all=True).select("_v", name)
    if descending:
        # Counted from the other end.
        total = distinct.agg(F.count("*").alias("n")).scalar()
        ranked = ranked.withColumn(name, total + 1 - F.col(name))
    return df.join(ranked, F.col(column).eqNullSafe(F.col("_v"))).drop("_v")
