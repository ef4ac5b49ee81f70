"""Language identification by compression.

Texts are compared as lower-case words. For each language a raw-content dictionary is put together from training rows. A
text is cut into blocks, every block is compressed with every dictionary, and the language whose dictionary gives the smallest
total wins. The share by which it beats the next one is the margin; a narrow one is rejected. Blanks after each block keep the
encoder from storing short blocks as they are, which would make all dictionaries equal.

The dictionaries are fitted on a bounded sample: at most ``ROWS`` distinct texts per language, chosen by hash, and
``DICTIONARY`` bytes of them. Everything else reads whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without any training row all are ``und``;
ties go to the first language by code point; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window as W, functions as F

from .frames import held_out, texts

ROWS = 200
DICTIONARY = 8_000
BLOCK = 4_000
PAD = b" " * 200
SETTINGS = {"strategy": zstandard.STRATEGY_GREEDY, "min_match": 3, "window_log": 17, "chain_log": 16, "hash_log": 16, "search_log": 4}
MARGIN = 0.01
LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")


def words(text: str) -> bytes:
    """Lower-case words with one space between."""
    return OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", rows: int = ROWS, size: int = DICTIONARY) -> dict[str, bytes]:
    """A dictionary of at most ``size`` bytes for each language, from rows that are not held out.

    The sample is the ``rows`` texts with the smallest hashes, so copies count once and the input's order does not matter.
    """
    known = docs.filter(F.col(f"`{lang_col}`").isNotNull() & ~held_out(id_col))
    known = known.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = known.filter(F.length("text") > 0).withColumn("h", F.xxhash64("text"))
    # The smallest hashes are among those below a bound that a few times as many texts pass, so a language of any size is a few rows.
    per = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).withColumnRenamed("lang", "_lang")
    place = (F.col("h").cast("double") + float(1 << 63)) / float(1 << 64)
    first = known.select("lang", "h").join(per, F.col("lang") == F.col("_lang"))
    first = first.filter(place < (4 * rows + 100) / F.col("n")).select("lang", "h").distinct()
    first = first.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("nth") <= rows)
    chosen = first.select("lang", "h").collect()
    if not chosen:
        return {}
    hashes = sorted({r.h for r in chosen})
    sample = known.filter(F.col("h").isin(hashes)).groupBy("lang", "h").agg(F.min(F.left("text", F.lit(size))).alias("text"))
    out: dict[str, list[bytes]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.h)):
        out.setdefault(r.lang, []).append(words(r.text))
    return {lang: joined(pieces, size) for lang, pieces in sorted(out.items())}


def joined(pieces: list[bytes], size: int) -> bytes:
    """Equal shares of the pieces, all together at most ``size`` bytes."""
    left, share = size, []
    for k, p in enumerate(sorted(pieces, key=len)):
        share.append(p[: left // (len(pieces) - k)])
        left -= len(share[-1])
    return b" ".join(share)[:size]


class Judge:
    """Compressors for all languages, made once in each task."""

    def __init__(self, dictionaries: dict[str, bytes], margin: float = MARGIN):
        self.langs, self.margin, self.tools = list(dictionaries), margin, []
        how = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, **SETTINGS)
        for raw in dictionaries.values():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.tools.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is too narrow."""
        if not self.langs or text is None or not LETTER.search(text):
            return "und", 0.0, True
        raw = words(text)
        blocks = [raw[i : i + BLOCK] + PAD for i in range(0, len(raw), BLOCK)]
        sizes = np.array([sum(len(t.compress(b)) for b in blocks) for t in self.tools], dtype=float)
        best = int(sizes.argmin())
        rest = np.delete(sizes, best)
        gap = 1.0 - sizes[best] / rest.min() if len(rest) else 1.0
        return self.langs[best], float(1.0 - 0.5 * np.exp(-gap / 0.02)), bool(gap < self.margin)


def identified(docs: DataFrame, dictionaries: dict[str, bytes], id_col="doc_id", text_col="text", margin: float = MARGIN) -> DataFrame:
    """doc_id, lang_pred, score and rejected (the margin is narrow) for each row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = Judge(dictionaries, margin)
        for b in batches:
            found = [tell(t) for t in texts(b)]
            langs, scores, narrow = ([f[k] for f in found] for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(narrow, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
