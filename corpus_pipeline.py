"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarflow.llm import decontamination, jaccard_join, line_dedup, mixing, toxicity
from bazaarflow.llm.frames import stored, table
from bazaarflow.llm.queries import TOXIC_FROM, prepared

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit; the model learns from the labels of the documents at hand."""
    model = toxicity.fit(docs, table(prepared(spark), sf_dir, "labels"))
    return toxicity.kept(docs.select(*COLUMNS), model, TOXIC_FROM)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten documents share; n_chars follows the text."""
    found = line_dedup.deduplicated(docs.select(*COLUMNS), min_docs=10)
    found = found.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))
    return found.select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    prepared(spark)
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean(docs.select(*COLUMNS), table(prepared(spark), sf_dir, "benchmark"))


def mix_of_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of copies that it takes."""
    found = mixing.mixed(docs.select(*COLUMNS))
    return found.filter("copies > 0").select(*COLUMNS, F.col("copies").cast("bigint").alias("copies"))


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("line_dedup", without_common_lines),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mix_of_sources),
]

# The model of the first stage and the similarity join are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
