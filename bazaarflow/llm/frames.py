"""Column helpers shared by the corpus operators.

All operators read only the columns named by their parameters, under internal names, so extra columns
of the input never clash with theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarflow.session import scratch_path

# Space and the control characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and a 128-bit row key (k1, k2) of both.

    Rows that agree in id and text have one key and so one result; null ids and null texts have keys too.
    """
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    return docs.select(i.alias("doc_id"), t.alias("text"), *row_key(id_col, text_col))


def row_key(id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("k1", "k2")) -> list[Column]:
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    # The salt comes first: it seeds the hash of what follows.
    null = F.concat(i.isNull().cast("string"), t.isNull().cast("string"))
    return [F.xxhash64(F.lit(1), null, i, t).alias(names[0]), F.xxhash64(F.lit(2), null, i, t).alias(names[1])]


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; survives lost executors and cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)




def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """Texts of a batch one at a time, without a Python list of all of them."""
    column = batch.column(batch.schema.get_field_index(name))
    for x in column:
        yield x.as_py()
