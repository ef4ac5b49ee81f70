"""Live dashboard over a stream of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.dashboard import DIMENSIONS, add_recent, snapshot, with_defaults
from .runner import LatestRows, run_bounded

MONEY = "decimal(28,2)"
BUCKET_SECONDS = 300


class LiveMetrics:
    """Running counters per dimension value, and the orders of the last five minutes.

    The counters are a streaming aggregation in update mode: Spark's state holds them, and a micro-batch gives out the
    values that it changed. Recent orders go to files by five-minute bucket, of which a snapshot reads the last two.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        schema = f"dimension string, name string, orders bigint, revenue {MONEY}"
        self.counters = LatestRows(spark, f"{self.root}/counters", ["dimension", "name"], schema)

    @staticmethod
    def _values() -> Column:
        """Every dimension value an order counts under, and the total."""
        of = lambda d, name: F.struct(F.lit(d).alias("dimension"), name.alias("name"))
        return F.explode(F.array(of("all", F.lit("*")), *[of(d, F.col(d)) for d in DIMENSIONS]))

    def run(self, events: DataFrame, timeout: int | None = None) -> DataFrame:
        """Count all orders there are, then stop; goes on from the run before. Returns the progress of the counters."""
        orders = with_defaults(events.filter("event_type = 'order_placed'"))
        spread = orders.select(self._values().alias("v"), "amount_inr").select("v.*", "amount_inr")
        counted = spread.groupBy("dimension", "name").agg(F.count("*").alias("orders"), F.sum("amount_inr").cast(MONEY).alias("revenue"))
        progress = run_bounded(counted, self.counters.write, f"{self.root}/counters-checkpoint", "update", timeout)
        run_bounded(orders.select("ts", "amount_inr"), self._keep_recent, f"{self.root}/recent-checkpoint", timeout=timeout)
        return progress

    def _keep_recent(self, batch: DataFrame, batch_id: int) -> None:
        """This batch's orders by bucket; a repeated batch replaces its own files."""
        bucket = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / BUCKET_SECONDS)
        rows = batch.filter("ts is not null").withColumns({"bucket": bucket, "batch": F.lit(batch_id)})
        # Only the last bucket of a batch and the one before it can still be recent.
        newest = rows.agg(F.max("bucket").alias("b")).scalar()
        rows = rows.filter(F.col("bucket") >= newest - 1)
        path = f"{self.root}/recent"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)

    def _recent(self) -> DataFrame:
        schema = "ts timestamp, amount_inr decimal(18,2), bucket bigint, batch bigint"
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/recent")
        newest = rows.select("bucket").agg(F.max("bucket")).first()[0]
        return rows.filter(F.col("bucket") >= (newest or 0) - 1).select("ts", "amount_inr")

    @staticmethod
    def throughput(progress: DataFrame) -> float | None:
        """Rows per second over the batches of a run that had rows."""
        taken = progress.filter("input_rows > 0 and rows_per_second > 0")
        return taken.agg(F.try_divide(F.sum("input_rows"), F.sum(F.col("input_rows") / F.col("rows_per_second")))).first()[0]

    def dashboard(self) -> DataFrame:
        """Snapshot as of the newest order seen."""
        return snapshot(add_recent(self.counters.read(), self._recent()))
