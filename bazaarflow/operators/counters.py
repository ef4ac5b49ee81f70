"""Run counters that come out of the write itself, without a second evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def write_counted(df: DataFrame, path: str, numbers: list[Column], mode: str = "overwrite") -> tuple[DataFrame, dict]:
    """``df`` written and read back, and the aggregates ``numbers`` of exactly the rows that were written."""
    seen = Observation()
    df.observe(seen, *numbers).write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get)


def as_row(spark: SparkSession, counters: dict, schema: str) -> DataFrame:
    """Counters as a table of one row."""
    return spark.createDataFrame([tuple(counters[part.split()[0]] for part in schema.split(", "))], schema)
