"""Bounded runs of a stream and the tables carried between its micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

Handler = Callable[[DataFrame, int], None]


def run_bounded(
    stream: DataFrame, handle: Handler, checkpoint: str, mode: str = "append", timeout: int | None = None
) -> DataFrame:
    """Process all input there is, then stop. Returns (batch_id, input_rows, rows_per_second, drained) of the run.

    ``drained`` tells whether all input was processed; a run that was stopped by its timeout has false in every row.

    Offsets are committed after ``handle`` returns, and a repeated batch has the same
    number, so a handler that replaces its own output makes the run exactly-once. How much
    one batch takes is set on the source.
    """
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return _drain(stream.sparkSession, writer, timeout)


def run_counted(
    stream: DataFrame, numbers: list[Column], path: str, checkpoint: str, timeout: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """As ``run_to_files``, and the sums of the aggregates ``numbers`` over the batches of this run, out of the writes themselves."""
    reports: list[dict] = []
    writer = stream.observe("counters", *numbers).writeStream.format("parquet").outputMode("append").option("path", path)
    progress = _drain(stream.sparkSession, writer.option("checkpointLocation", checkpoint), timeout, reports)
    seen = [r["counters"].asDict() for r in reports if "counters" in r]
    return progress, {name: sum(r[name] or 0 for r in seen) for name in (seen[0] if seen else {})}


def run_to_files(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> DataFrame:
    """Append a stream to parquet files until the input is drained."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return _drain(stream.sparkSession, writer, timeout)


def to_console(stream: DataFrame, checkpoint: str, timeout: int | None = None) -> DataFrame:
    """Print a stream until the input is drained."""
    writer = stream.writeStream.format("console").option("truncate", False).option("checkpointLocation", checkpoint)
    return _drain(stream.sparkSession, writer, timeout)


# Spark keeps the reports of the last batches only; a run needs those of all of them.
KEPT_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"


def _drain(spark: SparkSession, writer: DataStreamWriter, timeout: int | None, observed: list[dict] | None = None) -> DataFrame:
    """A bounded run with the report of every batch; the session's own setting is put back after it.

    ``observed`` gets the observed aggregates of the batches.
    """
    before = spark.conf.get(KEPT_REPORTS)
    spark.conf.set(KEPT_REPORTS, str(2**31 - 1))
    try:
        return _finish(spark, writer.trigger(availableNow=True).start(), timeout, observed)
    finally:
        spark.conf.set(KEPT_REPORTS, before)


def _finish(spark: SparkSession, query: StreamingQuery, timeout: int | None, observed: list[dict] | None = None) -> DataFrame:
    """Wait for a run; one that outlives its timeout is stopped and goes on from its checkpoint next time."""
    drained = True
    try:
        ended = query.awaitTermination(timeout)
        drained = timeout is None or bool(ended)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    if observed is not None:
        observed.extend(p["observedMetrics"] for p in query.recentProgress)
    progress = [
        (int(p["batchId"]), int(p["numInputRows"]), float(p.get("processedRowsPerSecond") or 0.0), drained)
        for p in query.recentProgress
    ]
    return spark.createDataFrame(progress, "batch_id bigint, input_rows bigint, rows_per_second double, drained boolean")


def drop_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


class LatestRows:
    """A keyed sink for update mode: every micro-batch adds the rows that it changed, a reader sees the newest of each key.

    A batch is written once under its number, so its cost follows its own rows and a repeated batch replaces itself. Every
    ``merge_every`` batches the newest rows are merged into one table, which bounds what a reader has to look through.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema: str, merge_every: int = 100):
        self.spark, self.root, self.keys, self.merge_every = spark, root.rstrip("/"), keys, merge_every
        self.schema = T.StructType.fromDDL(schema)

    def _batch(self, batch_id: int) -> str:
        return f"{self.root}/part={batch_id // self.merge_every}/batch={batch_id}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        part = batch_id // self.merge_every
        before = [p for p in self._parts() if p < part]
        if before and "_SUCCESS" not in _folders(self.spark, f"{self.root}/merged={part}"):
            # What the parts before hold, as of their last batch; the same however often it is written.
            self._newest(max(before)).write.mode("overwrite").parquet(f"{self.root}/merged={part}")
        batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.mode("overwrite").parquet(self._batch(batch_id))

    def _parts(self) -> list[int]:
        return [int(name.split("=")[1]) for name in _folders(self.spark, self.root) if name.startswith("part=")]

    def _newest(self, part: int) -> DataFrame:
        """Newest rows of a part and of the merged table before it."""
        full = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/part={part}").parquet(f"{self.root}/part={part}")
        if f"merged={part}" in _folders(self.spark, self.root):
            before = self.spark.read.schema(self.schema).parquet(f"{self.root}/merged={part}")
            rows = rows.unionByName(before.withColumn("batch", F.lit(-1).cast("bigint")))
        values = [f.name for f in self.schema if f.name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
        return newest.select(*[F.col(k) if k in self.keys else F.col(f"v.{k}") for k in self.schema.names])

    def read(self) -> DataFrame:
        parts = self._parts()
        return self._newest(max(parts)) if parts else self.spark.createDataFrame([], self.schema)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder of the shared store."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(context._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def write_output(df: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Replace one batch's part of an output table; returns that part, read back."""
    path = f"{root}/batch={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_output(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(root).drop("batch")
