"""The bronze lake: routing, partitioned archive, inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import ZONES

PARTITIONS = ["zone", "year", "month", "day"]


def zone_column(kind: str = "event_type") -> Column:
    out = None
    for k, zone in ZONES.items():
        hit = F.col(kind) == k
        out = F.when(hit, zone) if out is None else out.when(hit, zone)
    return out


def route_by_type(events: DataFrame) -> DataFrame:
    """Add the zone of each event and drop other kinds; one pass for all zones."""
    return events.filter(F.col("event_type").isin(*ZONES)).withColumn("zone", zone_column())


def with_partitions(routed: DataFrame, ts: str = "ts") -> DataFrame:
    """Add zero-padded date partitions of the event time."""
    return routed.withColumns(
        {
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
        }
    )


def archive_batch(events: DataFrame, batch_id: int, path: str, max_records: int = 1_000_000) -> None:
    """Write one micro-batch to the lake.

    The batch number is the innermost partition and only this batch's partitions are
    overwritten, so a repeated batch replaces its own files. The rebalance hint lets the
    optimizer merge small and split large partitions by size, so a busy day or zone does
    not end up in one task.
    """
    routed = with_partitions(route_by_type(events)).persist()
    try:
        sizes = routed.groupBy(F.col("zone").alias("_z")).agg(F.count("*").alias("_batch_size"))
        # One row per zone.
        stamped = routed.join(F.broadcast(sizes), F.col("zone") == F.col("_z")).drop("_z")
        out = stamped.withColumns({"_archived_at": F.current_timestamp(), "batch": F.lit(batch_id)})
        (
            out.hint("rebalance", *[F.col(c) for c in PARTITIONS])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .option("maxRecordsPerFile", max_records)
            .partitionBy(*PARTITIONS, "batch")
            .parquet(path)
        )
    finally:
        routed.unpersist()


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Archived events; the padded date partitions stay text."""
    return spark.read.schema(_lake_schema(spark, path)).parquet(path)


def _lake_schema(spark: SparkSession, path: str) -> T.StructType:
    fields = spark.read.parquet(path).schema.fields
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in PARTITIONS else f for f in fields])


def lake_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every archived file with its zone, size and row count."""
    files = spark.read.parquet(path).select("zone", F.col("_metadata.file_path"), F.col("_metadata.file_size"))
    return files.groupBy("zone", "file_path", "file_size").agg(F.count("*").alias("events"))


def archive_counters(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("zone").agg(
        F.count("*").alias("files_written"), F.sum("events").alias("events_archived"), F.sum("file_size").alias("bytes")
    )
