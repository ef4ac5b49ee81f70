"""Fraud rules over order events: velocity per seller and unusual amounts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import from_micros, micros, seconds_to_micros
from ..functions.numeric import round_half_up
from ..session import materialize
from .ordered import DEFAULT, SkewPolicy, position
from .windows import trailing_window


@dataclass(frozen=True)
class VelocityRule:
    name: str
    window_seconds: int
    threshold: int
    severity: str
    action: str
    label: str


# The rule table.
VELOCITY_RULES = (
    VelocityRule("VELOCITY_1MIN", 60, 30, "HIGH", "FLAG_FOR_REVIEW", "60 seconds"),
    VelocityRule("VELOCITY_5MIN", 300, 100, "CRITICAL", "FREEZE_SELLER_ACCOUNT", "5 minutes"),
)


@dataclass(frozen=True)
class AmountRule:
    name: str = "AMOUNT_ANOMALY"
    window_seconds: int = 300
    min_orders: int = 5
    factor: float = 10.0
    keep: float = 0.9
    gain: float = 0.1
    severity: str = "MEDIUM"
    action: str = "MANUAL_REVIEW"

    def __post_init__(self) -> None:
        if not 0 < self.keep < 1:
            raise ValueError("keep must lie between 0 and 1")


# Orders of a seller that are folded in one go.
BLOCK = 65_536

AMOUNT_RULE = AmountRule()


def alert_id(seller: str, event: str, rule: Column) -> Column:
    """The same alert always gets the same id."""
    text = F.concat_ws("|", F.col(seller).cast("string"), F.col(event).cast("string"), rule)
    return F.concat(F.lit("ALERT-"), F.upper(F.substring(F.md5(text.cast("binary")), 1, 16)))


def timed(orders: DataFrame) -> DataFrame:
    """What the rules need of an order; a missing amount counts as zero."""
    amount = F.coalesce(F.col("amount_inr"), F.lit(0).cast("decimal(18,2)"))
    return orders.select("seller_id", "event_id", micros("ts").alias("at_us"), amount.alias("amount_inr"))


def trailing_counts(orders: DataFrame, rules: tuple[VelocityRule, ...], policy: SkewPolicy = DEFAULT) -> DataFrame:
    windows = {r.name: seconds_to_micros(r.window_seconds) for r in rules}
    return trailing_window(timed(orders).drop("amount_inr"), ["seller_id"], "at_us", "event_id", windows, policy=policy)


def velocity_alerts(
    orders: DataFrame, rules: tuple[VelocityRule, ...] = VELOCITY_RULES, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """One alert per order and rule when the seller's trailing count is above the threshold."""
    return alerts_of_counts(trailing_counts(orders, rules, policy), rules)


def alerts_of_counts(counted: DataFrame, rules: tuple[VelocityRule, ...] = VELOCITY_RULES) -> DataFrame:
    """Alerts from orders that already carry their trailing counts."""
    candidates = [
        F.struct(
            F.lit(r.name).alias("alert_type"),
            F.lit(r.severity).alias("severity"),
            F.format_string(f"Seller placed %d orders in {r.label}", F.col(f"n_{r.name}")).alias("description"),
            F.struct(
                F.col(f"n_{r.name}").cast("bigint").alias("orders_in_window"),
                F.lit(r.threshold).cast("bigint").alias("threshold"),
                F.lit(r.window_seconds).cast("bigint").alias("window_seconds"),
            ).alias("evidence"),
            F.lit(r.action).alias("action_recommended"),
        )
        for r in rules
    ]
    fired = F.filter(F.array(*candidates), lambda a: a["evidence"]["orders_in_window"] > a["evidence"]["threshold"])
    found = counted.select("seller_id", "event_id", "at_us", F.explode(fired).alias("a"))
    return found.select(
        alert_id("seller_id", "event_id", F.col("a.alert_type")).alias("alert_id"),
        "seller_id",
        "event_id",
        "a.alert_type",
        "a.severity",
        "a.description",
        "a.evidence",
        from_micros("at_us").alias("ts"),
        "a.action_recommended",
    )


def _warm_up(rule: AmountRule) -> int:
    """Rows after which a starting value no longer shows in a double."""
    return 2 * math.ceil(80 * math.log(2) / -math.log(rule.keep))


def _blocks(judged: DataFrame, rule: AmountRule, policy: SkewPolicy) -> DataFrame:
    """Add the block of each order and whether the block owns it or only starts with it.

    Blocks lie at fixed positions of a seller, whatever the policy, so that the policy never shows in a result.
    """
    numbered = position(materialize(judged), ["seller_id"], ["at_us", "event_id"], "_pos", policy)
    lead = _warm_up(rule)
    block = max(BLOCK, 4 * lead)
    first, last = F.floor(F.col("_pos") / block), F.floor((F.col("_pos") + lead) / block)
    spread = numbered.withColumn("_block", F.explode(F.sequence(first, last)))
    return spread.withColumn("_own", F.col("_block") == first).drop("_pos")


def amount_baselines(
    orders: DataFrame, rule: AmountRule = AMOUNT_RULE, start: DataFrame | None = None, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Baseline before and after each order that has enough recent orders to judge by.

    The first baseline of a seller is the average in the window, or the one given in
    ``start`` (seller_id, baseline). Later ones are a moving average, which forgets where
    it started; every ``BLOCK`` orders of a seller it is therefore started anew, led in by the
    orders just before.
    """
    windows = {"recent": seconds_to_micros(rule.window_seconds)}
    counted = trailing_window(timed(orders), ["seller_id"], "at_us", "event_id", windows, "amount_inr", policy)
    return baselines_of_counted(counted, rule, start, policy)


def baselines_of_counted(
    counted: DataFrame, rule: AmountRule = AMOUNT_RULE, start: DataFrame | None = None, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    judged = counted.filter(F.col("n_recent") >= rule.min_orders).select(
        "seller_id",
        "event_id",
        "at_us",
        F.col("amount_inr").cast("double").alias("amount"),
        (F.col("sum_recent").cast("double") / F.col("n_recent").cast("double")).alias("average"),
    )
    spread = _blocks(judged, rule, policy)
    if start is not None:
        known = start.select(F.col("seller_id"), F.col("baseline").alias("_start"))
        spread = spread.join(known, "seller_id", "left")
    else:
        spread = spread.withColumn("_start", F.lit(None).cast("double"))
    begin = F.when(F.col("_block") == 0, F.col("_start"))
    rows = spread.withColumn("_start", F.coalesce(begin, F.col("average"))).drop("average")
    placed = rows.repartition("seller_id", "_block").sortWithinPartitions("seller_id", "_block", "at_us", "event_id")
    keep, gain = rule.keep, rule.gain
    names = ["seller_id", "event_id", "at_us", "amount"]
    schema = T.StructType([*[placed.schema[n] for n in names], T.StructField("baseline", T.DoubleType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, level = None, 0.0
        for batch in batches:
            before = []
            columns = ("seller_id", "_block", "amount", "_start")
            for seller, block, x, start_at in zip(*[batch.column(c).to_pylist() for c in columns]):
                if (seller, block) != run:
                    run, level = (seller, block), start_at
                before.append(level)
                level = keep * level + gain * x
            out = pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(before, pa.float64())], names=[*names, "baseline"]
            )
            yield out.filter(batch.column("_own"))

    after = F.lit(keep) * F.col("baseline") + F.lit(gain) * F.col("amount")
    return placed.mapInArrow(fold, schema).withColumn("baseline_after", after)


def amount_alerts(
    orders: DataFrame, rule: AmountRule = AMOUNT_RULE, start: DataFrame | None = None, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    return alerts_of_baselines(amount_baselines(orders, rule, start, policy), rule)


def alerts_of_baselines(baselines: DataFrame, rule: AmountRule = AMOUNT_RULE) -> DataFrame:
    """Alerts for amounts far above the baseline of their seller."""
    amount, baseline = F.col("amount"), F.col("baseline")
    text = F.format_string(
        f"Order %d is {rule.factor:g}x above avg %d",
        round_half_up(amount, 0).cast("bigint"),
        round_half_up(baseline, 0).cast("bigint"),
    )
    evidence = F.struct(
        amount.alias("order_amount"),
        round_half_up(baseline, 2).alias("seller_avg"),
        round_half_up(amount / F.greatest(F.lit(1.0), baseline), 1).alias("ratio"),
    )
    return baselines.filter(amount > baseline * F.lit(rule.factor)).select(
        alert_id("seller_id", "event_id", F.lit(rule.name)).alias("alert_id"),
        "seller_id",
        "event_id",
        F.lit(rule.name).alias("alert_type"),
        F.lit(rule.severity).alias("severity"),
        text.alias("description"),
        evidence.alias("evidence"),
        from_micros("at_us").alias("ts"),
        F.lit(rule.action).alias("action_recommended"),
    )


def seller_signals(events: DataFrame) -> DataFrame:
    """Seller activity that carries risk signals."""
    hit = (F.col("event_type") == "seller_activity") & (F.size("risk_signals") > 0)
    return events.filter(hit).select("event_id", "seller_id", "risk_signals")


def fraud_counters(orders: DataFrame, alerts: DataFrame) -> DataFrame:
    """Totals, alerts per type and alerts per flagged seller as (kind, name, n).

    ``alerts`` needs alert_type and seller_id.
    """
    names = [F.col("alert_type"), F.col("seller_id")]
    sets = alerts.groupingSets([[names[0]], [names[1]], []], *names).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    kind = F.when(F.col("g") == 1, "alert_type").when(F.col("g") == 2, "seller").otherwise("total_alerts")
    name = F.coalesce(F.col("alert_type"), F.col("seller_id").cast("string"), F.lit("*"))
    total = orders.agg(F.lit("total_orders").alias("kind"), F.lit("*").alias("name"), F.count("*").alias("n"))
    return sets.select(kind.alias("kind"), name.alias("name"), "n").unionByName(total)
