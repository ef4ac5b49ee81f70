"""Substring dedup by sliding sentence spans.

A text is cut at newlines, at the first blank (also a no-break or wide one) after a full stop, question or exclamation mark, and
at the full-width forms of these marks; pieces with a word are its sentences. A span is a run of consecutive sentences: from each sentence the shortest run of at least
``SENTENCES`` sentences and ``WORDS`` words, and to each sentence the shortest such run that ends there; a run of fewer
sentences is a span if it has ``LONG`` words. Spans are hashed and joined over all documents. Of a span that repeats, the first
place (smallest document id, then position) stays; sentences covered by any other place of it are removed.

Only hashes of spans are shuffled, and only those seen twice are joined. A span that a third of all documents share is counted
with partial sums and joined to one row, which the skew join can split.

Defined cases: null and empty texts have no sentences and stay as they are; rows that agree in id and text are one document;
a null id comes after all others; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import keyed, stored, texts
from .shingles import U, code_points, lower_bytes, mix, placed_words

SENTENCES, WORDS, LONG = 3, 10, 40
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_OTHER = U(0xD6E8FEB86659FD93)


# Marks that end a sentence without a blank, and blanks beyond ASCII.
WIDE_MARKS = (0x3002, 0xFF01, 0xFF0E, 0xFF1F, 0xFF61)
WIDE_BLANKS = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def breaks(codes: np.ndarray) -> np.ndarray:
    """Which characters end a piece: newlines, full-width marks, and blanks right after a mark that ends a sentence."""
    out = codes == 10
    if len(codes) > 1:
        before, here = codes[:-1], codes[1:]
        marks = (before == 46) | (before == 33) | (before == 63)
        out[1:] |= marks & ((here == 32) | ((here >= 9) & (here <= 13)))
    wide = np.flatnonzero(codes >= 0x80)
    if len(wide):
        out[wide] |= np.isin(codes[wide], WIDE_MARKS)
        after = wide[wide > 0]
        out[after] |= np.isin(codes[after], WIDE_BLANKS) & np.isin(codes[after - 1], (46, 33, 63))
    return out


def byte_breaks(raw: np.ndarray) -> np.ndarray:
    """The same for the bytes of a text; a character stands at its first byte."""
    if not len(raw) or raw.max() < 0x80:
        return breaks(raw)
    codes, lead = code_points(raw)
    out = np.zeros(len(raw), dtype=bool)
    out[lead] = breaks(codes)
    return out


def run_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of words: sums of word hashes times powers of an odd number, so any run follows from running sums."""
    power, down = np.full(len(words) + 1, _BASE, dtype=U), np.full(len(words) + 1, _INVERSE, dtype=U)
    power[0] = down[0] = 1
    power, down = np.multiply.accumulate(power), np.multiply.accumulate(down)
    sums = np.concatenate([[U(0)], np.cumsum(words * power[:-1], dtype=U)])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U)).view(np.int64)


def spans(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First piece, last piece and two hashes, 128 bits together, of each span of a text."""
    none = np.empty(0, dtype=np.int64)
    raw = lower_bytes(text)
    starts, words = placed_words(raw)
    if len(words) < WORDS:
        return none, none, none, none
    piece, counts = np.unique(np.cumsum(byte_breaks(raw))[starts], return_counts=True)
    n = len(piece)
    upto = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(n)
    # Shortest runs from each sentence: enough words, and either enough sentences or so many words that fewer do.
    end = np.maximum(np.searchsorted(upto, upto[:-1] + WORDS), first + SENTENCES)
    end = np.minimum(end, np.maximum(np.searchsorted(upto, upto[:-1] + LONG), first + 1))
    start = np.minimum(np.searchsorted(upto, upto[1:] - WORDS, side="right") - 1, first + 1 - SENTENCES)
    start = np.maximum(start, np.minimum(np.searchsorted(upto, upto[1:] - LONG, side="right") - 1, first))
    ahead, back = end <= n, start >= 0
    runs = np.unique(np.concatenate([first[ahead] * (n + 1) + end[ahead], start[back] * (n + 1) + first[back] + 1]))
    if not len(runs):
        return none, none, none, none
    a, b = runs // (n + 1), runs % (n + 1)
    hashes = [run_hashes(w, upto[a], upto[b]) for w in (words, mix(words ^ _OTHER))]
    return piece[a], piece[b - 1], *hashes


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, found = [], []
        for i, text in enumerate(texts(b)):
            own = spans(text)
            if len(own[0]):
                at.append(np.full(len(own[0]), i))
                found.append(own)
        if found:
            rows = pa.array(np.concatenate(at))
            first, last, h, g = (np.concatenate([f[k] for f in found]) for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k).take(rows) for k in range(3)], pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(h, pa.int64()), pa.array(g, pa.int64())],
                names=["doc_id", "k1", "k2", "first", "last", "h", "g"],
            )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2 and the runs (first and last piece) of each document that repeat an earlier place."""
    rows = keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, k1 bigint, k2 bigint, first int, last int, h bigint, g bigint"
    found = stored(rows.select("doc_id", "k1", "k2", "text").mapInArrow(_span_rows, schema), "spans")
    twice = found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    # As tables of their own, the counted sides let the skew join split a span that many documents share.
    places = stored(found.join(stored(twice, "twice"), "h"), "places")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2", "first")
    # Spans that share one hash by chance differ in the other.
    first = places.groupBy("h", "g").agg(F.min(order).alias("kept"))
    later = places.join(stored(first, "first-places"), ["h", "g"]).filter(order != F.col("kept"))
    return later.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))


def cut(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int, list[int]]:
    """The text without the pieces of the runs, the numbers of sentences and of removed ones, and the removed places."""
    raw = lower_bytes(text)
    has_words = np.unique(np.cumsum(byte_breaks(raw))[placed_words(raw)[0]]) if len(raw) else np.empty(0, dtype=np.int64)
    if not runs:
        return text, len(has_words), 0, []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.append(np.flatnonzero(breaks(codes)), len(codes))
    starts = np.concatenate([[0], ends[:-1] + 1])
    gone = np.zeros(len(starts) + 1, dtype=np.int64)
    for first, last in runs:
        gone[first] += 1
        gone[last + 1] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    kept, removed, at = [], [], 0
    # A removed run takes the character that ends it along.
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    for a, b in zip(edges[::2], edges[1::2]):
        kept.append(text[at : starts[a]])
        removed += [int(starts[a]), int(ends[b - 1])]
        at = int(ends[b - 1]) + 1
    kept.append(text[at:])
    return "".join(kept), len(has_words), int(gone[has_words].sum()), removed


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text without repeated spans, n_sentences, n_removed and removed_spans (start:end in code points) of each row."""
    runs = repeated(docs, id_col, text_col)
    # One plan for any size: the texts meet their runs in a merge join.
    rows = keyed(docs, id_col, text_col).join(runs.hint("merge"), ["k1", "k2"], "left")
    rows = rows.select("doc_id", "text", F.col("runs.first").alias("firsts"), F.col("runs.last").alias("lasts"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, firsts, lasts in zip(texts(b), b.column(2).to_pylist(), b.column(3).to_pylist()):
                clean, n, gone, places = cut(text or "", list(zip(firsts or [], lasts or [])))
                pairs = ",".join(f"{s}:{e}" for s, e in zip(places[::2], places[1::2]))
                out.append((clean if text is not None else None, n, gone, pairs))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "text", "n_sentences", "n_removed", "removed_spans"])

    return rows.mapInArrow(apply, f"doc_id {kind}, text string, n_sentences bigint, n_removed bigint, removed_spans string")
