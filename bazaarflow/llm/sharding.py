"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key, ``-weight / ln(u)`` with u from the md5 of key and shard, and the highest draw wins.
The draw of a shard depends on nothing but the key, the shard and its weight: a new shard takes the keys that it wins and moves
no other, a lost shard's keys go to the next in their own order, and a shard's share is its weight over the sum of weights.
Placing a row therefore is a projection without a shuffle (``sharded``, ``write_shards``).

``placed`` also numbers the rows of every shard from 0 without sorting a shard in one task. Rows that agree in id, size and
checksum are counted first and dealt in pieces of ``COPIES``; each piece has a place from the md5 of its content. Places are
uniform whatever the data, so equal ranges of places hold equal shares of a shard: each range counts on from the sum of those
before it. The order of slots is thus a fixed shuffle of the shard's rows.

Defined cases: a null key is a key of its own; a null text has no bytes and checksum 0; rows that repeat are placed and numbered
each; rows of one id go to one shard, equal texts of several ids to the shards of their ids; an empty table gives no rows;
other columns are ignored by ``placed`` and kept by ``sharded``, where a column named as its output is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .frames import stored

LAW = "key"
# Fixed value: the bytes that a row counts beside its text.
ROW_BYTES = 8
# A draw has 52 bits, the first 13 digits of a hash.
DIGITS, DRAWS = 13, float(1 << 52)
COPIES = 1000
RANGE_ROWS = 4096


def number(text: Column) -> Column:
    """0 to 2^52 - 1 from the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")


def key_of(columns: Sequence[str]) -> Column:
    """One text from the values of the key columns; null and every value differ from all others."""
    parts = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat_ws(",", *parts)


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """The shard's draw for a key: above 0, and higher for heavier shards."""
    u = (number(F.concat(key, F.lit("@"), shard.cast("string"))) + 0.5) / DRAWS
    return -weight / F.log(u)


def _weights(shards: int, weights: Sequence[float] | None) -> list[float]:
    given = [1.0] * shards if weights is None else [float(w) for w in weights]
    if shards < 1 or len(given) != shards or min(given) <= 0:
        raise ValueError("one weight above 0 for each shard, and one shard at least")
    return given


def winners(key: Column, shards: int, weights: Sequence[float] | None = None) -> tuple[Column, Column]:
    """(shard, its draw); among equal draws the lowest shard wins."""
    held = F.array(*[F.lit(w) for w in _weights(shards, weights)])
    one = lambda i: F.struct(draw(key, i, F.get(held, i)).alias("draw"), (-i).alias("minus"))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), one))
    return -best["minus"], best["draw"]


def sharded(docs: DataFrame, key_cols: Sequence[str] = ("doc_id",), shards: int = 24, weights: Sequence[float] | None = None, shard_col: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; a projection of the key columns."""
    return docs.withColumn(shard_col, winners(key_of(key_cols), shards, weights)[0])


def write_shards(docs: DataFrame, path: str, key_cols: Sequence[str] = ("doc_id",), shards: int = 24, weights: Sequence[float] | None = None, max_records: int = 1_000_000) -> None:
    """One folder per shard; partitions are dealt by shard and split or joined by size while running."""
    rows = sharded(docs, key_cols, shards, weights).hint("rebalance", F.col("shard"))
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("shard").parquet(path)


def placed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    weights: Sequence[float] | None = None,
    new_weight: float = 1.0,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, and grown_shard: the shard if one of ``new_weight`` is added."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("bigint")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    key = key_of(["doc_id"])
    shard, best = winners(key, shards, weights)
    groups = groups.withColumn("shard", shard).withColumn("best", best)
    newer = draw(key, F.lit(shards), F.lit(float(new_weight))) > F.col("best")
    groups = groups.withColumn("grown_shard", F.when(newer, F.lit(shards)).otherwise(F.col("shard"))).drop("best")
    return _numbered(groups).select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def _numbered(groups: DataFrame) -> DataFrame:
    """One row for each of the ``n`` copies of a group, with its slot in the shard."""
    pieces = groups.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))))
    copies = F.least(F.lit(COPIES).cast("bigint"), F.col("n") - F.col("piece") * COPIES)
    content = F.concat(key_of(["doc_id"]), *[x for c in ("size", "text_crc32", "piece") for x in (F.lit("/"), F.col(c).cast("string"))])
    pieces = stored(pieces.withColumn("copies", copies).withColumn("place", number(content)), "shard-pieces")
    ranges = pieces.agg(F.max("shard").alias("last"), F.count("*").alias("n")).first()
    parts = max(1, -(-ranges.n // (RANGE_ROWS * ((ranges.last or 0) + 1))))
    pieces = pieces.withColumn("part", F.floor(F.col("place") * (parts / DRAWS)))
    sums = pieces.groupBy("shard", "part").agg(F.sum("copies").alias("held"))
    before = F.sum("held").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("shard", "part", F.coalesce(before, F.lit(0)).alias("base"))
    order = W.partitionBy("shard", "part").orderBy("place", F.col("doc_id").asc_nulls_first(), "size", "text_crc32", "piece")
    inside = F.coalesce(F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counted = pieces.withColumn("inside", inside).join(sums, ["shard", "part"])
    first = F.col("base") + F.col("inside")
    return counted.withColumn("slot", F.explode(F.sequence(first, first + F.col("copies") - 1)))


def shard_report(found: DataFrame) -> DataFrame:
    """Rows, bytes and rows that would move to one more shard, by shard of ``placed``."""
    moved = F.count_if(F.col("grown_shard") != F.col("shard"))
    return found.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), moved.alias("n_moved"))
