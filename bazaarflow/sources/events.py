"""JSON events from topics or files, and back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import EVENTS

BROKEN = "_broken"

# An event of this time ends a stream and is no event itself.
END_TIME = "2200-01-01"

# Event times keep their microseconds on the way through JSON.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


@dataclass(frozen=True)
class Topics:
    """Kafka topics. Each job keeps its own offsets in its own checkpoint."""

    servers: str
    names: tuple[str, ...]
    starting: str = "latest"
    max_per_trigger: int | None = None
    options: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class JsonFiles:
    """A folder of text files with one JSON event per line."""

    path: str
    max_files_per_trigger: int | None = None


def _raw_stream(spark: SparkSession, source: Topics | JsonFiles) -> DataFrame:
    if isinstance(source, Topics):
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source.servers)
            .option("subscribe", ",".join(source.names))
            .option("startingOffsets", source.starting)
            .options(**dict(source.options))
        )
        if source.max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", source.max_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if source.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", source.max_files_per_trigger)
    return reader.load(source.path)


def parse_events(raw: DataFrame, schema: T.StructType = EVENTS) -> DataFrame:
    """Typed events from a JSON ``value`` column; broken lines keep their text in ``_broken``."""
    full = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    parsed = F.from_json("value", full, {"columnNameOfCorruptRecord": BROKEN})
    return raw.select(parsed.alias("e")).select("e.*")


def read_events(spark: SparkSession, source: Topics | JsonFiles, schema: T.StructType = EVENTS) -> DataFrame:
    """Streaming events of a source."""
    return parse_events(_raw_stream(spark, source), schema)


def read_event_files(spark: SparkSession, path: str, schema: T.StructType = EVENTS) -> DataFrame:
    """The same events as a batch."""
    return parse_events(spark.read.text(path), schema)


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as (key, value) messages with JSON values; nulls are left out of the JSON."""
    value = F.to_json(F.struct(*df.columns), {"timestampFormat": TIME_FORMAT}).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def write_events(df: DataFrame, sink: Topics | JsonFiles, key: str | None = None, topic: str | None = None) -> None:
    """Publish rows as JSON messages to a topic, or as lines to files."""
    if isinstance(sink, Topics):
        out = to_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", sink.servers)
        out.option("topic", topic or sink.names[0]).save()
    else:
        to_messages(df).write.mode("append").text(sink.path)


def end_stream(spark: SparkSession, sink: Topics | JsonFiles, ts: str = "ts") -> None:
    """Publish one event that only ends a stream: its time moves every watermark past all other events."""
    write_events(spark.sql(f"select to_timestamp('{END_TIME}') as {ts}"), sink)


# Rows of a file that a stream reads, and files of one micro-batch.
STREAM_ROWS, STREAM_FILES = 20_000, 64


def write_for_stream(df: DataFrame, path: str, rows_per_file: int = STREAM_ROWS, least: int = 4) -> int:
    """Parquet files for a stream: ``least`` of them, more if the rows are more than those can hold.

    Every file is written by one task, so what that reads stays the same however many rows there are. Returns the number of
    files for one micro-batch: half of them, 64 at most.
    """
    files = max(least, -(-df.count() // rows_per_file))
    df.repartition(files).write.parquet(path)
    return max(1, min(STREAM_FILES, files // 2))


def order_lines(orders: DataFrame) -> DataFrame:
    """One printable line per order, for a console sink."""
    line = F.format_string(
        "Order ID: %s | City: %s | Amount: ₹%s", "order_id", "city", F.col("amount_inr").cast("string")
    )
    return orders.select("order_id", line.alias("line"))


# Rows of a compressed JSON file: such a file is read by one task, so its size must not follow that of the writing task.
ROWS_PER_FILE = 500_000


def write_rows(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """JSON rows for ``read_rows``, compressed: names and quotes repeat in every row and are most of the text."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).json(path)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed table from JSON rows, dates included."""
    return spark.read.schema(schema).option("dateFormat", "yyyy-MM-dd").json(path)
