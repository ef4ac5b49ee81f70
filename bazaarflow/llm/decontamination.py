"""Benchmark decontamination: containment search for short items inside long documents.

Items of up to ``FINEST`` different shingles are looked up by each of them, so none is missed. For longer ones a document is
cut into blocks of shingles; the minima of ``HASHES`` hash functions over blocks of 8 give, joined in pairs
again and again, those of windows of 32, 64 and so on. These items are partitioned by size, and a partition of items of up to
m shingles is looked up in windows of 2 m shingles laid every m, so an item that a document holds in one piece makes
up at least a quarter of some window. A window with any minimum in common with an item of its partition makes the document
and the item a candidate; a candidate counts if at least ``threshold`` of the item's different shingles are in the document.

Items travel with the tasks in passes of ``PASS`` items, whatever their number. What one pass finds is written before the next
one is collected, so the driver holds one pass; documents are not shuffled, but for one join with their hits after several passes.

Defined cases: a document or an item of fewer than five words has no shingles and is never part of a match; equal items
are reported each under its own id; null and empty texts match nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import row_key, stored, texts
from .shingles import U, mix, shingle_hashes

HASHES = 48
THRESHOLD = 0.8
FINEST = 8
PASS = 8192
MANY = 1_000_000

_KEYS = mix(np.arange(1, HASHES + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def hashed(shingles: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash function: 32 bits of a product, so that minima are cheap to take and to compare."""
    return ((shingles ^ (shingles >> U(29))) * _KEYS[k] >> U(32)).astype(np.uint32)


@dataclass
class Partition:
    """Items of at most ``size`` shingles, and their minima by hash function."""

    size: int
    items: list[int] = field(default_factory=list)
    minima: list[np.ndarray] = field(default_factory=list)

    def finish(self) -> None:
        by_hash = np.stack(self.minima, axis=1)
        self.order = np.argsort(by_hash, axis=1, kind="stable")
        self.sorted = np.take_along_axis(by_hash, self.order, axis=1)
        # One look-up in a bit table sets most windows aside.
        self.table = np.zeros((HASHES, 1 << 16), dtype=bool)
        for k in range(HASHES):
            self.table[k, by_hash[k] & 0xFFFF] = True

    def matches(self, minima: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows, and places of the items that share their k-th minimum."""
        windows = np.flatnonzero(self.table[k, minima & 0xFFFF])
        left, right = (np.searchsorted(self.sorted[k], minima[windows], side=s) for s in ("left", "right"))
        n = right - left
        at = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.repeat(windows, n), self.order[k, at]


class Index:
    """Items by size; small enough to travel with a task."""

    def __init__(self, items: list[tuple[int, str | None]], threshold: float):
        self.threshold = threshold
        self.ids: list[int] = []
        self.shingles: list[np.ndarray] = []
        parts: dict[int, Partition] = {}
        short: list[int] = []
        for item, text in items:
            s = np.unique(shingle_hashes(text, short=False))
            if not len(s):
                continue
            if len(s) <= FINEST:
                short.append(len(self.ids))
            else:
                size = 2 * FINEST
                while size < len(s):
                    size *= 2
                part = parts.setdefault(size, Partition(size))
                part.items.append(len(self.ids))
                part.minima.append(np.array([hashed(s, k).min() for k in range(HASHES)], dtype=np.uint32))
            self.ids.append(item)
            self.shingles.append(s)
        # Shingles of short items in order, and the item of each.
        probes = np.concatenate([np.empty(0, dtype=U), *[self.shingles[i] for i in short]])
        order = np.argsort(probes, kind="stable")
        self.probes, self.probed = probes[order], np.repeat(short, [len(self.shingles[i]) for i in short]).astype(np.int64)[order]
        self.table = np.zeros(1 << 16, dtype=bool)
        self.table[probes & U(0xFFFF)] = True
        self.parts = [parts[k] for k in sorted(parts)]
        for p in self.parts:
            p.finish()

    def search(self, batch: Iterator[str | None]) -> Iterator[list[tuple[int, int, int]]]:
        """For each text the (item id, its shingles, those in the text) of the items it contains."""
        held: list[np.ndarray] = []
        for text in batch:
            held.append(shingle_hashes(text, short=False) if self.ids else np.empty(0, dtype=U))
            if sum(map(len, held)) > MANY or len(held) >= 2000:
                yield from self.search_shingles(held)
                held = []
        yield from self.search_shingles(held)

    def search_shingles(self, docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
        if not any(len(s) for s in docs):
            return out
        for d, items in self.candidates(docs).items():
            # A window may also touch a document without shingles.
            whole = np.unique(docs[d])
            if not len(whole):
                continue
            for i in sorted(items):
                own = self.shingles[i]
                at = np.minimum(np.searchsorted(whole, own), len(whole) - 1)
                common = int((whole[at] == own).sum())
                if common >= self.threshold * len(own):
                    out[d].append((self.ids[i], len(own), common))
        return out

    def candidates(self, docs: list[np.ndarray]) -> dict[int, set[int]]:
        """Items that a document may hold. The documents lie one after the other in one array; a block belongs to one."""
        sizes = np.array([len(s) for s in docs])
        blocks = -(-sizes // FINEST)
        owner = np.repeat(np.arange(len(docs)), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + inside * FINEST
        s = np.concatenate(docs)
        found: dict[int, set[int]] = {}
        if len(self.probes):
            at = np.flatnonzero(self.table[s & U(0xFFFF)])
            left, right = (np.searchsorted(self.probes, s[at], side=side) for side in ("left", "right"))
            at, left, right = (x[right > left] for x in (at, left, right))
            for d, a, b in zip(np.searchsorted(np.cumsum(sizes), at, side="right"), left, right):
                found.setdefault(int(d), set()).update(self.probed[a:b].tolist())
        for k in range(HASHES if self.parts else 0):
            low, size = np.minimum.reduceat(hashed(s, k), starts), FINEST
            for p in self.parts:
                while size < p.size:
                    low, size = np.minimum(low[::2], _next(low[::2], low[1::2])), size * 2
                # Two blocks of p.size next to each other hold any piece of p.size shingles. A window may reach into the
                # next documents; all that have a part in it become candidates.
                window = np.minimum(low[:-1], low[1:]) if len(low) > 1 else low
                for w, place in zip(*p.matches(window, k)):
                    at = int(w) * (size // FINEST)
                    end = min(at + 2 * (size // FINEST), len(owner)) - 1
                    for d in range(int(owner[at]), int(owner[end]) + 1):
                        found.setdefault(d, set()).add(p.items[place])
        return found


def _next(even: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The odd blocks, the last even one standing in for a missing one."""
    return odd if len(odd) == len(even) else np.append(odd, even[-1])


def _passes(items: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[int, Iterator[Index]]:
    """The number of passes and the items of one after the other, so that what travels with the tasks has a bound."""
    own = items.select(F.col(f"`{id_col}`").cast("bigint").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    passes = max(1, -(-own.count() // PASS))

    def indexes() -> Iterator[Index]:
        for p in range(passes):
            # Half a pass on average, so that an uneven deal stays within the bound.
            part = own if passes == 1 else own.filter(F.pmod(F.xxhash64("item", "text"), F.lit(2 * passes)).isin(2 * p, 2 * p + 1))
            yield Index([(r["item"], r["text"]) for r in part.collect()], threshold)

    return passes, indexes()


def contained(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, item_id, n_shingles of the item, n_common and containment for each item found in a document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, n_shingles bigint, n_common bigint"

    def one_pass(index: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, hits = [], []
                for i, own in enumerate(index.search(texts(b))):
                    at += [i] * len(own)
                    hits += own
                columns = [pa.array([h[j] for h in hits], pa.int64()) for j in range(3)]
                ids = b.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "n_shingles", "n_common"])

        return rows.mapInArrow(run, schema)

    passes, indexes = _passes(items, item_col, item_text_col, threshold)
    found = one_pass(next(indexes)) if passes == 1 else reduce(DataFrame.unionByName, [stored(one_pass(i), "hits") for i in indexes])
    return found.withColumn("containment", F.col("n_common") / F.col("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col="item_id", item_text_col="text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    passes, indexes = _passes(items, item_col, item_text_col, threshold)

    def searched(rows: DataFrame, index: Index, hit: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([bool(hits) == hit for hits in index.search(texts(b, text_col))], pa.bool_()))

        return rows.mapInArrow(run, T.StructType(rows.schema.fields))

    if passes == 1:
        return searched(docs, next(indexes), hit=False)
    # Whether a row goes depends on its text alone.
    keys = ("_text_key_1", "_text_key_2")
    keyed = docs.select("*", *row_key(text_col, text_col, keys))
    hits = [stored(searched(keyed.select(*keys, f"`{text_col}`"), i, hit=True).select(*keys), "hits") for i in indexes]
    gone = reduce(DataFrame.unionByName, hits).distinct()
    return keyed.join(gone.hint("merge"), list(keys), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
