"""Checks around a daily run: topics, freshness, outputs, escalation, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..schemas import MART_TABLES, ZONES


def _zone_of(kind: str = "event_type") -> F.Column:
    out = None
    for k, zone in ZONES.items():
        hit = F.col(kind) == k
        out = F.when(hit, zone) if out is None else out.when(hit, zone)
    return out


def _with_all_zones(found: DataFrame) -> DataFrame:
    """One row per expected zone, also for zones without any event."""
    spark = found.sparkSession
    expected = spark.createDataFrame([(z,) for z in ZONES.values()], "zone string")
    return expected.join(found, "zone", "left")


def topic_health(events: DataFrame, since: str) -> DataFrame:
    """Events per topic after the last run; a silent topic is unhealthy."""
    recent = events.filter(F.col("ts") > F.to_timestamp(F.lit(since)))
    seen = recent.groupBy(_zone_of().alias("zone")).agg(F.count("*").alias("events"), F.max("ts").alias("last_ts"))
    out = _with_all_zones(seen).withColumn("events", F.coalesce("events", F.lit(0)))
    return out.withColumn("status", F.when(F.col("events") > 0, "healthy").otherwise("silent"))


def freshness(events: DataFrame, as_of: str, max_age_hours: float = 24) -> DataFrame:
    """Age of the newest event per zone; stale when too old or absent."""
    seen = events.groupBy(_zone_of().alias("zone")).agg(F.max("ts").alias("last_ts"))
    age = F.unix_micros(F.to_timestamp(F.lit(as_of))) - F.unix_micros(F.col("last_ts").cast("timestamp"))
    hours = age / F.lit(3_600_000_000.0)
    out = _with_all_zones(seen).withColumn("age_hours", hours)
    return out.withColumn("fresh", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)))


def file_freshness(spark: SparkSession, paths: dict[str, str], as_of: str, max_age_hours: float = 24) -> DataFrame:
    """Files, bytes and age of the newest file per named path; stale when too old, absent or empty.

    Only the file listing is read, no content. An absent path has no files.
    """
    schema = "name string, files bigint, bytes bigint, newest timestamp"
    out = None
    for name, path in paths.items():
        try:
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            seen = listed.select("length", "modificationTime").agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modificationTime").alias("newest"))
            part = seen.select(F.lit(name).alias("name"), "files", "bytes", "newest")
        except AnalysisException as absent:
            if absent.getCondition() != "PATH_NOT_FOUND":
                raise
            part = spark.createDataFrame([(name, 0, 0, None)], schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    age = (F.unix_micros(F.to_timestamp(F.lit(as_of))) - F.unix_micros("newest")) / F.lit(3_600_000_000.0)
    return out.withColumn("age_hours", age).withColumn("fresh", F.coalesce(age <= max_age_hours, F.lit(False)) & (F.col("bytes") > 0))


def escalation(fraud: DataFrame, threshold: int = 10) -> DataFrame:
    """Whether enough high-risk sellers were found to call somebody."""
    n = fraud.agg(F.count_if(F.col("fraud_risk_level") == "HIGH").alias("high_risk_count"))
    return n.withColumn("escalation_required", F.col("high_risk_count") >= threshold)


def outputs_exist(spark: SparkSession, root: str) -> DataFrame:
    """Existence and row count of every expected mart."""
    rows = []
    for name in MART_TABLES:
        try:
            n = spark.read.parquet(f"{root}/{name}").count()
        except AnalysisException:
            n = None
        rows.append((name, n is not None, n or 0, bool(n)))
    return spark.createDataFrame(rows, "mart string, present boolean, row_count bigint, passed boolean")


def run_summary(health: DataFrame, fresh: DataFrame, alert: DataFrame, run_date: str) -> DataFrame:
    """One row and one text for the whole run."""
    silent = health.agg(F.count_if(F.col("status") != "healthy").alias("n")).scalar()
    stale = fresh.agg(F.count_if(~F.col("fresh")).alias("n")).scalar()
    out = alert.select("high_risk_count", "escalation_required", silent.alias("silent_topics"), stale.alias("stale_zones"))
    good = (F.col("silent_topics") == 0) & (F.col("stale_zones") == 0)
    out = out.withColumn("status", F.when(good, "SUCCESS").otherwise("FAILED"))
    text = F.format_string(
        f"run {run_date}: %s; silent topics %d; stale zones %d; high-risk sellers %d; tables {len(MART_TABLES)}",
        "status",
        "silent_topics",
        "stale_zones",
        "high_risk_count",
    )
    return out.withColumn("summary", text)
