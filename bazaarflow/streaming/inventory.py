"""Stock allocation over a stream of stock events, on Spark's keyed state."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.stock import after_event, judged, quantity
from ..session import scratch_path
from .keyed import Columns, Fold, in_event_order, known, unknown, watermarked
from .runner import read_output, run_bounded, write_output

STATES = ("stock_before", "reserved_before", "stock_after", "reserved_after")


def _decide(key: tuple, carry: tuple[int, int] | None, rows: Columns) -> tuple[tuple[int, int], Columns]:
    """Two numbers of state per product; its seed comes with its events."""
    stock, reserved = carry if carry is not None else (int(rows["seed"][0]), 0)
    trail = np.empty((4, len(rows["at_us"])), dtype=np.int64)
    for i, (action, qty) in enumerate(zip(rows["action"].tolist(), rows["qty"].tolist())):
        now = stock, reserved
        stock, reserved = after_event(action, qty, stock, reserved)
        trail[:, i] = *now, stock, reserved
    return (stock, reserved), {n: rows[n] for n in rows if n != "seed"} | dict(zip(STATES, trail))


class InventoryStream:
    """First come, first served in event time; the state of a product is two numbers and the events that still wait.

    A decision depends on all decisions before it, so a product's events of one micro-batch are folded in one task; their number is
    bounded by what a micro-batch takes from the source.
    """

    def __init__(self, spark: SparkSession, root: str, seed: DataFrame, delay_seconds: float = 60):
        self.spark, self.root, self.delay = spark, root.rstrip("/"), delay_seconds
        path = scratch_path(spark, "stock-seed")
        seed.groupBy("product_id").agg(F.max(F.col("initial_stock").cast("bigint")).alias("seed")).write.parquet(path)
        self.seed = spark.read.schema(f"product_id {seed.schema['product_id'].dataType.simpleString()}, seed bigint").parquet(path)

    def run(self, events: DataFrame, timeout: int | None = None) -> DataFrame:
        """``events`` holds product_id, event_id, order_id, ts, action, qty."""
        slim = events.select("product_id", known(F.col("event_id")).alias("event_id"), "order_id", "ts", "action", quantity().alias("qty"))
        rows = watermarked(slim, "ts", self.delay, F.col("action").isin("order", "sold", "update"))
        seeded = rows.join(self.seed, "product_id", "left").withColumn("seed", F.coalesce("seed", F.lit(0)))
        inputs = ["event_id", "order_id", "at_us", "action", "qty", "seed"]
        states = ", ".join(f"{s} bigint" for s in STATES)
        out = f"product_id bigint, event_id bigint, order_id string, at_us bigint, action string, qty bigint, {states}"
        found = in_event_order(seeded, "ts", ["product_id"], inputs, Fold(_decide), out)

        def handle(batch: DataFrame, batch_id: int) -> None:
            write_output(batch, f"{self.root}/decisions", batch_id)

        return run_bounded(found, handle, f"{self.root}/checkpoint", timeout=timeout)

    def _read(self, late: Column) -> DataFrame:
        return read_output(self.spark, f"{self.root}/decisions").filter(late).drop("late")

    def decisions(self) -> DataFrame:
        return judged(self._read(~F.col("late")))

    def late(self) -> DataFrame:
        """Late events and those without a time."""
        rows = self._read(F.col("late")).drop(*STATES)
        return rows.withColumns({c: unknown(F.col(c)) for c in ("event_id", "at_us")})
