"""Keyed upserts: replaced rows leave the base, the newest delta rows enter; in memory, or into a stored table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from ..session import materialize


def latest_per_key(delta: DataFrame, keys: list[str], order: str, ties: bool = True) -> DataFrame:
    """The last version of each key; copies combine before the shuffle.

    A null version is older than any other. Of equal versions the one with the largest JSON text counts, so the choice does
    not depend on the order of the rows. Without ``ties`` no key has its last version twice, and no JSON is made.
    """
    rest = [c for c in delta.columns if c not in keys]
    place = F.struct(F.col(order).isNotNull(), F.col(order), *([F.to_json(F.struct(*rest))] if ties else []))
    last = delta.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_row"))
    return last.select(*keys, "_row.*").select(*delta.columns)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Insert or replace ``delta`` into ``base``; ``order`` (a column of the delta) ranks its versions.

    Only the delta is grouped; of the base just the keys take part in the comparison.
    """
    fresh = latest_per_key(delta, keys, order)
    kept = base.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


# The partition column names the number of buckets, which a table keeps for good.
BUCKET = "_bucket_of_"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table stored by ``upsert_into``."""
    rows = spark.read.parquet(path)
    return rows.drop(*[c for c in rows.columns if c.startswith(BUCKET)])


def upsert_into(path: str, delta: DataFrame, keys: list[str], order: str, buckets: int = 256) -> int:
    """Insert or replace ``delta`` into the table stored at ``path``, which is made if it is absent; returns the buckets written.

    Rows lie in partitions by a hash of their key. Only the partitions that the delta touches are read and replaced, the files of
    the others stay as they are. What replaces them is complete in a staging folder before the first file is moved; until
    that commit readers see the old rows. The number of buckets is fixed with the first delta.

    The delta is computed once; whole rows are shuffled once more, and before it only those of a delta that repeats keys.
    """
    spark, name = delta.sparkSession, f"{BUCKET}{buckets}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = _one_per_key(materialize(delta), keys, order).withColumn(name, bucket)
    # At most ``buckets`` numbers.
    touched = [r[0] for r in fresh.select(name).distinct().collect()]
    if _is_stored(spark, path):
        if name not in spark.read.parquet(path).columns:
            raise ValueError(f"{path} was stored with another number of buckets")
        stored = spark.read.schema(fresh.schema).parquet(path).filter(F.col(name).isin(touched))
        rows = _replaced(stored, fresh, keys, name)
    else:
        rows = fresh.hint("rebalance", F.col(name))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)
    return len(touched)


def _one_per_key(delta: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``latest_per_key`` of a stored delta, whose whole rows are shuffled only if a key repeats."""
    versions = delta.groupBy(*keys, F.col(order).alias("_version")).agg(F.count("*").alias("_n"))
    per_key = versions.groupBy(*keys).agg(
        F.sum("_n").alias("_rows"),
        F.max_by("_n", F.struct(F.col("_version").isNotNull(), "_version")).alias("_last"),
    )
    copies, ties = per_key.agg(F.max("_rows"), F.max("_last")).first()
    if (copies or 0) <= 1:
        return delta
    return materialize(latest_per_key(delta, keys, order, ties=ties > 1))


# Parts of a bucket that tasks take whole.
CELLS = 16


def _replaced(stored: DataFrame, fresh: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Fresh rows, and the stored rows of other keys; a key that holds a null equals no other.

    Both are dealt once, by parts of buckets: the rows of a key meet there, and what is written lies together already.
    """
    cell = F.pmod(F.shiftright(F.xxhash64(*keys), 32), F.lit(CELLS))
    both = stored.withColumn("_fresh", F.lit(0)).unionByName(fresh.withColumn("_fresh", F.lit(1)))
    dealt = both.withColumn("_cell", cell).repartition(F.col(name), F.col("_cell"))
    hit = F.max("_fresh").over(W.partitionBy(name, "_cell", *keys))
    no_match = reduce(or_, [F.col(k).isNull() for k in keys])
    kept = dealt.withColumn("_hit", hit).filter((F.col("_fresh") == 1) | (F.col("_hit") == 0) | no_match)
    return kept.drop("_fresh", "_cell", "_hit")


def _is_stored(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def vector_points(enriched: DataFrame, text_limit: int = 500) -> DataFrame:
    """Vector-store rows: key, vector, and the payload with its text cut for display."""
    payload = [
        "seller_id",
        "sentiment",
        "urgency_level",
        "primary_category",
        "city",
        "product_category",
        "one_line_summary",
        "rating",
        "requires_action",
    ]
    return enriched.select(
        "review_id", "embedding", *payload, F.substring("review_text", 1, text_limit).alias("original_text")
    )
