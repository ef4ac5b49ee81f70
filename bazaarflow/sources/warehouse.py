"""Marts on disk and their load into warehouse tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import clean_name
from ..schemas import MART_TABLES


class MartNotFound(Exception):
    """There is no data under a mart's path."""


def save_mart(df: DataFrame, name: str, root: str) -> str:
    """Overwrite a mart; every task writes its own part."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


# The error conditions for a path without files of a kind.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _files(spark: SparkSession, kind: str):
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}")


def _csv_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    """One table for each different header; the first line of every file is its header."""
    lines = _files(spark, "csv").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nr"),
        "value",
    )
    heads = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "nr").alias("head"))
    grouped = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    reader = spark.read.option("header", True).option("inferSchema", True)
    return [reader.csv(list(r["files"])) for r in grouped]


def _parts(spark: SparkSession, path: str, kind: str) -> list[DataFrame]:
    try:
        if kind == "csv":
            return _csv_parts(spark, path)
        return [_files(spark, kind).option("mergeSchema", True).parquet(path)]
    except AnalysisException as e:
        if e.getCondition() not in ABSENT:
            raise
        return []


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """All parquet and csv files under a mart, united by column name; a column that a file lacks is null there."""
    parts = [df for kind in ("parquet", "csv") for df in _parts(spark, path, kind) if df.columns]
    if not parts:
        raise MartNotFound(path)
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Warehouse-safe column names; two columns that become one are an error."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after cleaning: {clashes}")
    return df.toDF(*names)


def stringify_nested(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    return df.withColumns({n: F.to_json(F.col(f"`{n}`")) for n in nested}) if nested else df


def _write_table(df: DataFrame, table: str, root: str | None, mode: str) -> None:
    if root is None:
        df.write.mode(mode).saveAsTable(table)
    else:
        df.write.mode(mode).parquet(f"{root}/{table}")


def load_warehouse(
    spark: SparkSession,
    marts: str,
    root: str | None = None,
    tables: dict[str, str] | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Load every mart into its table; one failure does not stop the others.

    With ``root`` the tables are parquet folders, otherwise catalog tables. ``mode`` is the
    write disposition. Returns (table, status), status SUCCESS, SKIPPED, FAILED or ERROR.
    """
    status = []
    for mart, table in (tables or MART_TABLES).items():
        try:
            df = stringify_nested(normalize_columns(read_mart(spark, f"{marts}/{mart}")))
        except MartNotFound:
            status.append((table, "SKIPPED"))
            continue
        except Exception as e:  # whatever is wrong with one mart, the others are loaded
            status.append((table, f"ERROR: {str(e)[:50]}"))
            continue
        try:
            _write_table(df, table, root, mode)
            status.append((table, "SUCCESS"))
        except Exception:
            status.append((table, "FAILED"))
    return spark.createDataFrame(status, "table string, status string")


@contextmanager
def cached_input(df: DataFrame) -> Iterator[DataFrame]:
    """Keep an input used by several marts in memory and on disk while they run."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
