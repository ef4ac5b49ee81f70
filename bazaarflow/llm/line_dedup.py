"""Line deduplication that moves hashes and bits, never text.

Every line becomes a row (hash, document, position). The rows are range-partitioned by hash and document and
sorted by position inside, so a line that a third of all documents share spreads over many tasks. A pass over the
sorted rows keeps the first occurrence in each document; counting those gives the number of documents of a line.
What a document loses comes back as a sparse bitmap, 64 lines in a word, with no word where nothing is dropped.

Defined cases: a null or empty text is one empty line; rows that agree in id and text are one document; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .frames import BLANKS, keyed, row_key, stored

# The letters whose case is ignored.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH, KEY = ["h1", "h2"], ["k1", "k2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """h1, h2, k1, k2, pos: a row for each line whose key has ``min_chars`` code points."""
    lines = keyed(docs, id_col, text_col)
    lines = lines.select(*KEY, F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.select(*KEY, "pos", line_key(F.col("line")).alias("line")).filter(F.length("line") >= min_chars)
    return lines.select(F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2"), *KEY, "pos")


def drop_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """k1, k2, words: for each document that loses lines, the words of its bitmap that are not zero.

    Lines found in ``min_docs`` documents are dropped everywhere; with ``keep_first`` the document with the smallest
    row key keeps its first one.
    """
    occ = stored(occurrences(docs, id_col, text_col, min_chars), "lines")
    first = occ.repartitionByRange(*HASH, *KEY).withColumn("nth", F.row_number().over(W.partitionBy(*HASH, *KEY).orderBy("pos")))
    first = first.filter("nth = 1")
    common = first.groupBy(*HASH).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "pos")).alias("first"))
    common = common.filter(F.col("n") >= min_docs).select(*HASH, *(["first"] if keep_first else []))
    # As a table of its own, it lets the skew join split a line that many documents share.
    lost = occ.join(stored(common, "common-lines"), HASH)
    if keep_first:
        lost = lost.filter(F.struct(*KEY, "pos") != F.col("first"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos") % 64)
    words = lost.groupBy(*KEY, F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def dense(words: Column) -> Column:
    """The bitmap with its zero words, up to the last one that is not; linear in its length."""

    def piece(x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(words, i - 1)["word"])
        return F.concat(F.array_repeat(F.lit(0).cast("bigint"), x["word"] - before - 1), F.array(x["bits"]))

    return F.flatten(F.transform(words, piece))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with three columns more: dropped_bitmap (words of 64 lines), n_dropped and the kept text."""
    names = ("_llm_k1", "_llm_k2")
    bitmaps = drop_bitmaps(docs, id_col, text_col, **how).select(
        F.col("k1").alias(names[0]),
        F.col("k2").alias(names[1]),
        dense(F.col("words")).alias("dropped_bitmap"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda n, x: n + F.bit_count(x["bits"])).alias("_llm_n"),
    )
    joined = docs.select("*", *row_key(id_col, text_col, names)).join(bitmaps.hint("merge"), list(names), "left")
    words, lines = F.col("dropped_bitmap"), lines_of(F.col(f"`{text_col}`"))

    def stays(_line: Column, i: Column) -> Column:
        word = F.coalesce(F.get(words, F.floor(i / 64).cast("int")), F.lit(0).cast("bigint"))
        return F.call_function("getbit", word, i % 64) == 0

    kept = F.when(words.isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    return joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        words,
        F.coalesce("_llm_n", F.lit(0).cast("bigint")).alias("n_dropped"),
        kept.alias("kept_text"),
    )
