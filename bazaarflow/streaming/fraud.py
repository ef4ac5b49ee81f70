"""Fraud rules over a stream of orders, on Spark's keyed state."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import seconds_to_micros
from ..operators.alerts import AMOUNT_RULE, VELOCITY_RULES, AmountRule, VelocityRule, alerts_of_baselines, alerts_of_counts
from .keyed import Columns, Fold, in_event_order, known, unknown, watermarked
from .runner import read_output, run_bounded, write_output


def _recent(carry: Columns | None, rows: Columns, width: int) -> tuple[Columns, Columns]:
    """Number and sum of one seller's orders in the window of each row; the carry is what later windows still see."""
    joined, first = {n: rows[n] for n in ("at_us", "cents")}, 0
    if carry is not None:
        joined, first = {n: np.concatenate([carry[n], v]) for n, v in joined.items()}, len(carry["at_us"])
    at = joined["at_us"]
    # Whole numbers of any size, so that sums are exact.
    total = np.concatenate([[0], np.cumsum(joined["cents"].astype(object))])
    place = np.arange(first, len(at))
    low = np.searchsorted(at, at[place] - width, "left")
    recent = at >= at[-1] - width
    return {n: v[recent] for n, v in joined.items()}, {"n": place + 1 - low, "sum": total[place + 1] - total[low]}


def _velocity(key: tuple, carry: Columns | None, rows: Columns, widths: dict[str, int]) -> tuple[Columns, Columns]:
    """Trailing counts of many sellers at once; the carry is what later windows still see."""
    names, first = ("seller_id", "at_us"), 0
    joined = {n: rows[n] for n in names}
    if carry is not None:
        joined, first = {n: np.concatenate([carry[n], rows[n]]) for n in names}, len(carry["at_us"])
    at, widest = joined["at_us"], max(widths.values())
    seller = pd.factorize(joined["seller_id"], use_na_sentinel=False)[0].astype(np.int64)
    # One axis for all sellers, each with its own stretch that no window leaves.
    axis = seller * (at[-1] - at[0] + widest + 1) + (at - at[0])
    order = np.argsort(axis, kind="stable")
    sorted_, own = axis[order], np.empty(len(at), dtype=np.int64)
    own[order] = np.arange(len(at))
    mine = np.flatnonzero(rows["slice"] == key[1])
    place = own[first + mine]
    made = {n: rows[n][mine] for n in ("seller_id", "event_id", "at_us", "slice")}
    made |= {f"n_{n}": place + 1 - np.searchsorted(sorted_, sorted_[place] - width, "left") for n, width in widths.items()}
    recent = at >= at[-1] - widest
    return {n: v[recent] for n, v in joined.items()}, made


def _amounts(key: tuple, carry: tuple | None, rows: Columns, rule: AmountRule) -> tuple[tuple, Columns]:
    """Baselines before each order that has enough recent ones; the carry is the window and the baseline."""
    window, level = carry if carry is not None else (None, None)
    window, made = _recent(window, rows, seconds_to_micros(rule.window_seconds))
    judged = made["n"] >= rule.min_orders
    out, picked = [], {n: rows[n][judged] for n in ("event_id", "at_us")}
    amounts = [int(c) / 100 for c in rows["cents"][judged]]
    for x, total, n in zip(amounts, made["sum"][judged], made["n"][judged]):
        if level is None:
            level = int(total) / 100 / int(n)
        out.append(level)
        level = rule.keep * level + rule.gain * x
    return (window, level), picked | {"amount": np.array(amounts), "baseline": np.array(out)}


class FraudStream:
    """Velocity and amount alerts; the same rules and results as the batch operators.

    The velocity rules are keyed by a bucket of sellers and a time slice. An order goes to its own slice and, if a window reaches that
    far, to the next one; so a busy seller spreads over tasks, and a slice's state ends with the slice. ``buckets`` only sets how many
    sellers share an entry of state, which costs more to open than to search. A moving baseline depends on all
    orders of a seller: the amount rule is keyed by seller, and its state holds one window and one number.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        delay_seconds: float = 60,
        rules: tuple[VelocityRule, ...] = VELOCITY_RULES,
        amount_rule: AmountRule = AMOUNT_RULE,
        slice_seconds: float | None = None,
        buckets: int = 64,
    ):
        self.spark, self.root, self.delay = spark, root.rstrip("/"), delay_seconds
        self.rules, self.amount_rule, self.buckets = rules, amount_rule, buckets
        self.widths = {r.name: seconds_to_micros(r.window_seconds) for r in rules}
        widest = max(self.widths.values())
        self.slice_us = 8 * widest if slice_seconds is None else seconds_to_micros(slice_seconds)
        if self.slice_us < widest:
            raise ValueError("a slice must be as long as the longest window")

    def _orders(self, events: DataFrame) -> DataFrame:
        cents = (F.coalesce(F.col("amount_inr"), F.lit(0)).cast("decimal(18,2)") * 100).cast("bigint")
        slim = events.select("seller_id", known(F.col("event_id")).alias("event_id"), "ts", cents.alias("cents"), "event_type")
        return watermarked(slim, "ts", self.delay, F.col("event_type") == "order_placed")

    def run_velocity(self, events: DataFrame, timeout: int | None = None) -> DataFrame:
        """Count all orders there are, then stop; goes on from the run before."""
        slice_ = F.floor(F.col("at_us") / self.slice_us)
        reaches = F.floor((F.col("at_us") + max(self.widths.values())) / self.slice_us)
        # Orders without a time have no slice; they are late at once, in many groups.
        slices = F.when(unknown(F.col("at_us")).isNull(), F.array(-1 - F.pmod("event_id", F.lit(64)))).otherwise(F.sequence(slice_, reaches))
        bucket = F.pmod(F.xxhash64("seller_id"), F.lit(self.buckets)).alias("bucket")
        copies = self._orders(events).select("ts", "seller_id", "event_id", "at_us", bucket, slice_.alias("slice"), F.explode(slices).alias("part"))
        counts = ", ".join(f"n_{r.name} bigint" for r in self.rules)
        seller = copies.schema["seller_id"].dataType.simpleString()
        slice_us = self.slice_us
        fold = Fold(partial(_velocity, widths=self.widths), lambda key: (key[1] + 1) * slice_us)
        out = f"seller_id {seller}, event_id bigint, at_us bigint, {counts}, slice bigint, part bigint"
        found = in_event_order(copies, "ts", ["bucket", "part"], ["seller_id", "event_id", "at_us", "slice"], fold, out)
        return run_bounded(found, self._keep("counts"), f"{self.root}/velocity-checkpoint", timeout=timeout)

    def run_amounts(self, events: DataFrame, timeout: int | None = None) -> DataFrame:
        fold = Fold(partial(_amounts, rule=self.amount_rule))
        out = "seller_id bigint, event_id bigint, at_us bigint, amount double, baseline double"
        found = in_event_order(self._orders(events), "ts", ["seller_id"], ["event_id", "at_us", "cents"], fold, out)
        return run_bounded(found, self._keep("baselines"), f"{self.root}/amounts-checkpoint", timeout=timeout)

    def _keep(self, name: str):
        def handle(batch: DataFrame, batch_id: int) -> None:
            write_output(batch, f"{self.root}/{name}", batch_id)

        return handle

    def _read(self, name: str, late: Column) -> DataFrame:
        return read_output(self.spark, f"{self.root}/{name}").filter(late)

    def velocity(self) -> DataFrame:
        return alerts_of_counts(self._read("counts", ~F.col("late")), self.rules)

    def amounts(self) -> DataFrame:
        after = F.lit(self.amount_rule.keep) * F.col("baseline") + F.lit(self.amount_rule.gain) * F.col("amount")
        return alerts_of_baselines(self._read("baselines", ~F.col("late")).withColumn("baseline_after", after), self.amount_rule)

    def late(self, name: str = "counts") -> DataFrame:
        """Late orders and those without a time."""
        rows = self._read(name, F.col("late"))
        if name == "counts":
            # Of the copies of an order its own slice's.
            rows = rows.filter((F.col("part") == F.col("slice")) | unknown(F.col("at_us")).isNull())
        return rows.select("seller_id", unknown(F.col("event_id")).alias("event_id"), unknown(F.col("at_us")).alias("at_us"))
