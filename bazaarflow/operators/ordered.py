"""Running values along an order, without holding a heavy key in one task.

A plain window puts all rows of a key into one task. Here every key above a number of rows is cut into chunks along the
order; each chunk runs its own window and receives what came before it from a table of chunk totals. Light keys keep the
plain window, so they pay nothing.

Heavy keys are found by a join, whatever their number. Their rows are range-partitioned and sorted by key and order, and a
chunk is a fixed number of neighbouring rows of a partition, so its size follows neither the data nor the cluster. Any cut
gives the same result; it only balances work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import materialize

CHUNK = "_chunk"
# Rows for which another task pays, and rows that one task sorts at most.
TASK_ROWS, SORTED_ROWS = 50_000, 10_000_000


@dataclass(frozen=True)
class SkewPolicy:
    """When and how finely to cut a key.

    Every key above ``max_group_rows`` is cut, and a chunk holds at most a quarter of that. Up to ``max_chunks`` tasks sort
    the rows of cut keys; beyond ``SORTED_ROWS`` rows a task there are more.
    """

    max_group_rows: int = 1_000_000
    max_chunks: int = 4096


DEFAULT = SkewPolicy()


def same(left: list[str], right: list[str]) -> Column:
    """Equality of keys in which null equals null."""
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def hot_keys(df: DataFrame, keys: list[str], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """The keys with too many rows for one task, with their count; a stored table."""
    return materialize(df.groupBy(*keys).count().filter(F.col("count") > policy.max_group_rows))


def _cut(df: DataFrame, keys: list[str], order: list[str], rows: int, policy: SkewPolicy) -> DataFrame:
    """Add the chunk number, non-decreasing along keys and order."""
    tasks = max(2, min(policy.max_chunks, -(-rows // TASK_ROWS)), -(-rows // SORTED_ROWS))
    ranged = df.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order)
    # The id counts the rows of a partition; numbers of different partitions are far apart.
    number = F.floor(F.monotonically_increasing_id() / F.lit(max(1, policy.max_group_rows // 4)))
    # Stored, as bounds of ranges are drawn anew when a lost task runs again.
    return materialize(ranged.withColumn(CHUNK, number))


def with_chunks(
    df: DataFrame, keys: list[str], order: list[str], policy: SkewPolicy = DEFAULT, cut_all: bool = False
) -> tuple[DataFrame, bool]:
    """Add the chunk column: -1 for light keys. Also tells whether anything was cut."""
    if cut_all:
        return _cut(df, keys, order, df.count(), policy), True
    light = F.lit(-1).cast("bigint")
    hot = hot_keys(df, keys, policy)
    rows = hot.agg(F.sum("count")).first()[0]
    if not rows:
        return df.withColumn(CHUNK, light), False
    marks = [f"_hot_{k}" for k in keys]
    marked = hot.select(*[F.col(k).alias(m) for k, m in zip(keys, marks)])
    heavy = _cut(df.join(marked, same(keys, marks), "left_semi"), keys, order, rows, policy)
    return df.join(marked, same(keys, marks), "left_anti").withColumn(CHUNK, light).unionByName(heavy), True


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    previous: dict[str, str] | None = None,
    latest: dict[str, Column] | None = None,
    policy: SkewPolicy = DEFAULT,
    cut_all: bool = False,
) -> DataFrame:
    """Add values that depend on the rows before, per key.

    ``sums``: running sum, current row included. ``previous``: a column's value in the row
    before. ``latest``: the newest non-null value so far, current row included.
    ``order`` must be a total order within a key.
    """
    chunked, cut = with_chunks(df, keys, order, policy, cut_all)
    return running_in_chunks(chunked, cut, keys, order, sums, previous, latest).drop(CHUNK)


def running_in_chunks(
    chunked: DataFrame,
    cut: bool,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    previous: dict[str, str] | None = None,
    latest: dict[str, Column] | None = None,
) -> DataFrame:
    """As ``running``, on rows that already have their chunk; keeps the chunk column."""
    sums, previous, latest = sums or {}, previous or {}, latest or {}
    ordered = W.partitionBy(*keys, CHUNK).orderBy(*order)
    upto = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = chunked.select(
        "*",
        *[F.sum(expr).over(upto).alias(name) for name, expr in sums.items()],
        *[F.lag(F.struct(source)).over(ordered).alias(name) for name, source in previous.items()],
        *[F.last(expr, ignorenulls=True).over(upto).alias(name) for name, expr in latest.items()],
    )
    if cut:
        out = _carry(out, chunked, keys, order, sums, previous, latest)
    if previous:
        out = out.withColumns({name: F.col(name)[source] for name, source in previous.items()})
    return out


def _carry(
    out: DataFrame,
    chunked: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    previous: dict[str, str],
    latest: dict[str, Column],
) -> DataFrame:
    """Add what earlier chunks of the same key contribute.

    The table of totals has one row per cut key and chunk.
    """
    place = F.struct(*order)
    totals = (
        chunked.filter(F.col(CHUNK) >= 0)
        .groupBy(*keys, CHUNK)
        .agg(
            F.count("*").alias("_rows"),
            *[F.sum(expr).alias(f"_t_{name}") for name, expr in sums.items()],
            *[F.max_by(F.struct(source), place).alias(f"_t_{name}") for name, source in previous.items()],
            *[
                F.max_by(expr, F.when(expr.isNotNull(), place)).alias(f"_t_{name}")
                for name, expr in latest.items()
            ],
        )
    )
    by_chunk = W.partitionBy(*keys).orderBy(CHUNK)
    before = by_chunk.rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, CHUNK]],
        *[F.sum(f"_t_{name}").over(before).alias(f"_c_{name}") for name in sums],
        *[F.lag(f"_t_{name}").over(by_chunk).alias(f"_c_{name}") for name in previous],
        *[F.last(f"_t_{name}", ignorenulls=True).over(before).alias(f"_c_{name}") for name in latest],
    )
    cond = same([*keys, CHUNK], [f"_k_{k}" for k in [*keys, CHUNK]])
    added = {name: F.col(name) + F.coalesce(F.col(f"_c_{name}"), F.lit(0)) for name in sums}
    added |= {name: F.coalesce(F.col(name), F.col(f"_c_{name}")) for name in [*previous, *latest]}
    joined = out.join(carry, cond, "left").withColumns(added)
    return joined.drop(*[c for c in carry.columns])


def position(
    df: DataFrame, keys: list[str], order: list[str], name: str = "pos", policy: SkewPolicy = DEFAULT, cut_all: bool = False
) -> DataFrame:
    """Add the 0-based position of each row within its key."""
    numbered = running(df, keys, order, sums={name: F.lit(1)}, policy=policy, cut_all=cut_all)
    return numbered.withColumn(name, F.col(name) - F.lit(1))
