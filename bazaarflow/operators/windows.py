"""Trailing time windows, series windows and streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T, Window as W

from ..functions.numeric import round_half_up
from .ordered import DEFAULT, SkewPolicy, running, running_in_chunks, with_chunks


def trailing_window(
    df: DataFrame,
    keys: list[str],
    at: str,
    tie: str,
    windows: dict[str, int],
    value: str | None = None,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Count (and sum) of each key's events in the closed interval [at - w, at].

    ``windows`` maps a name to a width in microseconds and adds ``n_<name>`` and, with a
    value, ``sum_<name>``. Every event enters once and leaves once per window, so the work
    is one running sum, whatever the number of events inside a window. Events of equal
    time count in the order of ``tie``, as an arrival queue would.
    """
    payload = [c for c in df.columns if c not in {*keys, tie}]
    inexact = value is not None and isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))

    def step(shift: int, kind: int, deltas: dict[str, int]):
        return F.struct(
            (F.col(at) + F.lit(shift)).alias("_t"),
            F.lit(kind).alias("_kind"),
            *[F.lit(deltas.get(name, 0)).alias(f"_d_{name}") for name in windows],
        )

    steps = [step(0, 0, {name: 1 for name in windows})]
    steps += [step(width, 1, {name: -1}) for name, width in windows.items()]
    moves = df.select("*", F.explode(F.array(*steps)).alias("_s")).select(
        *keys,
        tie,
        *[F.when(F.col("_s._kind") == 0, F.col(c)).alias(c) for c in payload],
        *([F.col(value).alias("_value")] if value else []),
        "_s.*",
    )
    sums = {f"n_{name}": F.col(f"_d_{name}") for name in windows}
    if value:
        # What enters and leaves must cancel, which doubles do not; they are summed to ten decimals.
        amount = F.col("_value").cast("decimal(38,10)") if inexact else F.col("_value")
        sums |= {f"sum_{name}": F.when(F.col(f"_d_{name}") < 0, -amount).when(F.col(f"_d_{name}") > 0, amount) for name in windows}
    out = running(moves, keys, ["_t", "_kind", tie], sums=sums, policy=policy)
    if inexact:
        out = out.withColumns({f"sum_{name}": F.col(f"sum_{name}").cast("double") for name in windows})
    return out.filter(F.col("_kind") == 0).select(*df.columns, *sums)


def active_keys(df: DataFrame, key: str, ts: str, now: str, width_seconds: int = 60) -> DataFrame:
    """Keys with an event in [now - width, now]; events after now are not yet known."""
    as_of = F.to_timestamp(F.lit(now))
    since = as_of - F.make_dt_interval(secs=F.lit(width_seconds))
    seen = df.filter(F.col(ts).between(since, as_of))
    return seen.groupBy(key).agg(F.max(ts).alias("last_seen"))


def by_position(df: DataFrame, key: str, pos: str, context: int, block: int) -> DataFrame:
    """Cut series with dense positions into blocks, each with ``context`` rows on both sides.

    Adds ``_block`` and ``_own``; rows that are only context have ``_own`` false.
    """
    home = F.floor(F.col(pos) / F.lit(block))
    first = F.floor((F.col(pos) - F.lit(context)) / F.lit(block))
    last = F.floor((F.col(pos) + F.lit(context)) / F.lit(block))
    spread = df.withColumn("_block", F.explode(F.sequence(first, last)))
    return spread.withColumn("_own", F.col("_block") == home)


def rolling_average(
    df: DataFrame, key: str, pos: str, value: str, size: int, block: int = 1_000_000, name: str = "rolling_avg"
) -> DataFrame:
    """Average of the last ``size`` rows of a series, shorter at its head, rounded to 2."""
    spread = by_position(df, key, pos, context=size - 1, block=max(block, size))
    frame = W.partitionBy(key, "_block").orderBy(pos).rowsBetween(1 - size, 0)
    exact = F.sum(F.col(value).cast("decimal(18,2)")).over(frame).cast("double")
    n = F.count(F.lit(1)).over(frame).cast("double")
    out = spread.withColumn(name, round_half_up(exact / n, 2))
    return out.filter("_own").drop("_block", "_own")


def longest_streak(
    df: DataFrame, key: str, pos: str, value: str, threshold: float, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Longest run of consecutive positions with value >= threshold, 0 when there is none."""
    hit = F.when(F.col(value) >= F.lit(threshold), 1).otherwise(0)
    slim = df.select(key, pos, hit.alias("_hit"))
    counted = running(slim, [key], [pos], sums={"_hits": F.col("_hit")}, policy=policy)
    # Hits minus position stays constant inside a run, so it names the run.
    run = counted.groupBy(key, (F.col(pos) - F.col("_hits")).alias("_run")).agg(F.sum("_hit").alias("_len"))
    return run.groupBy(key).agg(F.max("_len").alias("longest_streak"))


def local_peaks(df: DataFrame, key: str, pos: str, value: str, block: int = 1_000_000) -> DataFrame:
    """Rows not below the row before and strictly above the row after; ends count as open."""
    spread = by_position(df, key, pos, context=1, block=block)
    w = W.partitionBy(key, "_block").orderBy(pos)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    peak = (before.isNull() | (before <= F.col(value))) & (after.isNull() | (after < F.col(value)))
    return spread.withColumn("_peak", peak).filter("_own and _peak").select(key, pos, value)


def step_change(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Previous value of an aggregated series; the series must hold one row per period."""
    return df.withColumn(name, F.lag(value, 1).over(W.partitionBy(key).orderBy(order)))


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str], amount: str, slide: str | None = None) -> DataFrame:
    """Count and sum per event-time window; ``slide`` makes the windows overlap.

    Works on a batch and, behind a watermark, on a stream.
    """
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    agg = df.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(amount).cast("double").alias("total"))
    return agg.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(
    df: DataFrame, key: str, at: str, tie: str, amount: str, gap_micros: int, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Sessions of a key: a new one starts when nothing happened for ``gap_micros``.

    Marks session starts from the row before and numbers them with a running sum, so a
    busy key is cut like in every other running operator.
    """
    slim = df.select(key, at, tie, amount)
    chunked, cut = with_chunks(slim, [key], [at, tie], policy)
    seen = running_in_chunks(chunked, cut, [key], [at, tie], previous={"_before": at})
    begins = F.when(F.col("_before").isNull() | (F.col(at) - F.col("_before") >= gap_micros), 1).otherwise(0)
    starts = seen.withColumn("_begin", begins)
    marked = running_in_chunks(starts, cut, [key], [at, tie], sums={"session": F.col("_begin")})
    return marked.groupBy(key, "session").agg(
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.count("*").alias("n"),
        F.sum(amount).cast("double").alias("total"),
    )
