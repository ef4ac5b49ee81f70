"""N-gram Jaccard self join with Bayesian pruning.

1. Sketches: documents with the same set of five-word shingles form one class; a class has ``HASHES`` MinHash values.
2. Buckets: classes that agree in a band of values meet in a bucket. Buckets with the same members count once.
3. Pruning: in a bucket, pairs are compared by more and more MinHash values. After each step a pair is dropped if the
   posterior probability that its similarity reaches the threshold (uniform prior) is below the tolerance. What remains
   joins classes to candidate groups; a bucket returns a spanning forest, never its pairs.
4. Verification: the groups are connected components of those forests, so every pair that survived lies inside one. All
   pairs of a group are counted exactly from their shingles by block products; a task returns links per class and a
   spanning forest of the links. The components of these are the near-duplicate classes.

Large buckets and groups are dealt into blocks, and a task works on two blocks. Band agreement misses a pair of similarity
0.8 with probability 3e-6, pruning with about 1e-5; verified links are exact.

Defined cases: a text of fewer than five words has one shingle of all its words; texts without words (also null) have no
links and are classes of their own, each row by itself; rows that agree in id and text are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .frames import keyed, row_key, stored, texts
from .shingles import U, mix, shingle_hashes

THRESHOLD = 0.8
BANDS, BAND_ROWS = 24, 4
HASHES = BANDS * BAND_ROWS
STEP = 16
TOLERANCE = 1e-5
BLOCK = 2048

_A = (mix(np.arange(1, HASHES + 1, dtype=U)) | U(1)).astype(np.uint32)
_B = (mix(np.arange(1001, HASHES + 1001, dtype=U)) | U(1)).astype(np.uint32)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of 32-bit hash functions of a set of shingles."""
    low, high = (shingles & U(0xFFFFFFFF)).astype(np.uint32), (shingles >> U(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 4096):
        values = _A[:, None] * low[None, at : at + 4096]
        values += _B[:, None] * high[None, at : at + 4096]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, matches needed) for each step.

    With a uniform prior the similarity after m matches in n values is Beta(m + 1, n - m + 1); the chance that it reaches t
    equals that of at most m successes in n + 1 trials with probability t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, sizes, sums, minima = [], [], [], []
        for i, text in enumerate(texts(b)):
            s = np.unique(shingle_hashes(text))
            if len(s):
                at.append(i)
                sizes.append(len(s))
                sums.append(mix(s).sum())
                minima.append(minhash(s))
        if not at:
            continue
        m, key = np.stack(minima), np.arange(1, BANDS + 1, dtype=U)[None, :]
        for r in range(BAND_ROWS):
            key = mix(key * U(0xD6E8FEB86659FD93) + m[:, r::BAND_ROWS].astype(U))
        names = mix(np.array(sums, dtype=U) + np.array(sizes, dtype=U)).view(np.int64)
        # A byte of each value: a chance match in 256 makes pruning no stricter.
        values = [row.tobytes() for row in m.astype(np.uint8)]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * BANDS, pa.int32()), pa.array(key.view(np.int64).ravel()))
        kept = [c.take(pa.array(at, pa.int64())) for c in (b.column(0), b.column(1))]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), lists, pa.array(values, pa.binary())],
            names=["k1", "k2", "cid", "size", "bands", "values"],
        )


class Forest:
    """Sets of places that are known to belong together."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))])

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def survivors(values: np.ndarray, one: int, others: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Those of ``others`` that pass every step against ``one``; values are compared ``STEP`` at a time."""
    matches, done = np.zeros(len(others), dtype=np.int32), 0
    for n, least in steps:
        matches += (values[others, done:n] == values[one, done:n]).sum(axis=1)
        stay = matches >= least
        others, matches, done = others[stay], matches[stay], n
        if not len(others):
            break
    return others


def pruned_forest(cids: np.ndarray, values: np.ndarray, steps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges that join the classes whose pairs survive; pairs already joined need no comparison."""
    n = len(cids)
    if n == 2:
        return [(int(cids[0]), int(cids[1]))] if len(survivors(values, 0, np.array([1]), steps)) else []
    forest, out = Forest(n), []
    for i in range(n - 1):
        others = np.arange(i + 1, n)
        if out:
            roots = forest.roots()
            others = others[roots[others] != roots[i]]
        for j in survivors(values, i, others, steps):
            if forest.join(i, int(j)):
                out.append((int(cids[i]), int(cids[j])))
    return out


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list]:
    """Columns of each run of rows with equal keys (the first ``keys`` columns) in sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        # Group keys are whole numbers without nulls.
        own = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.flatnonzero(np.any([np.diff(c) != 0 for c in own], axis=0)) + 1
        cuts = [0, *new.tolist(), b.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            key = tuple(c[at] for c in own)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(at, end - at))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _in_blocks(rows: DataFrame, group: str, size: str, name: str) -> DataFrame:
    """Rows with their cell (low, high block) of the group.

    A group of up to ``BLOCK`` rows has one cell; a larger one is dealt into blocks, and a row goes to the cells of its own
    block with each of them.
    """
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(17), name), blocks).cast("int")
    dealt = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("low", F.least("_own", "_other")).withColumn("high", F.greatest("_own", "_other"))


def _array(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2, cid (name of the shingle set), size, bands and values of each document with a word."""
    rows = keyed(docs, id_col, text_col).select("k1", "k2", "text")
    found = rows.mapInArrow(_sketch, "k1 bigint, k2 bigint, cid bigint, size bigint, bands array<bigint>, values binary")
    return stored(found, "sketches")


def candidate_groups(sketched: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """cid, grp: classes of groups that hold all surviving pairs."""
    classes = stored(sketched.groupBy("cid").agg(F.first("bands").alias("bands"), F.first("values").alias("values")), "classes")
    posts = classes.select("cid", F.explode("bands").alias("bucket"))
    counted = posts.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor("cid").alias("x"), F.sum(F.col("cid") % 1000003).alias("s"))
    # Buckets with the same members do the same work; the smallest stands for them.
    kept = counted.filter("n > 1").groupBy("n", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = posts.join(kept, "bucket").join(classes.select("cid", "values"), "cid")
    cells = _in_blocks(members, "bucket", "n", "cid").select("bucket", "low", "high", "cid", "values")
    cells = cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "cid")
    steps = least_matches(threshold, tolerance)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for run in _runs(batches, 3):
            cids = _array(run.column(3))
            values = np.frombuffer(b"".join(run.column(4).to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
            out += pruned_forest(cids, values, steps)
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return components(cells.mapInArrow(prune, "a bigint, b bigint")).select(F.col("node").alias("cid"), F.col("component").alias("grp"))


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of every left with every right set, by products over slices of the shared vocabulary."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), n) for side, n in zip((left, right), sizes)]
    words = np.intersect1d(flat[0], flat[1])
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not len(words):
        return out
    places = []
    for f, r in zip(flat, rows):
        at = np.minimum(np.searchsorted(words, f), len(words) - 1)
        hit = words[at] == f
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], r[hit][order]))
    for start in range(0, len(words), 2048):
        end = min(start + 2048, len(words))
        tables = []
        for (at, r), n in zip(places, (len(left), len(right))):
            a, b = np.searchsorted(at, [start, end])
            table = np.zeros((n, end - start), dtype=np.float32)
            table[r[a:b], at[a:b] - start] = 1.0
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def verified(group: pa.Table, threshold: float) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Spanning edges of the links of one cell, and the links of each class in it.

    Columns: grp, low, high, own, cid, shingles. In a cell of two blocks only pairs across them count.
    """
    cids = _array(group.column(4))
    sets = [np.frombuffer(x, dtype=U) for x in group.column(5).to_pylist()]
    low, high, own = int(group.column(1)[0].as_py()), int(group.column(2)[0].as_py()), _array(group.column(3))
    left = np.flatnonzero(own == low)
    right = left if low == high else np.flatnonzero(own == high)
    sizes = np.array([len(s) for s in sets])
    forest, edges, links = Forest(len(cids)), [], np.zeros(len(cids), dtype=np.int64)
    for at in range(0, len(left), 512):
        some = left[at : at + 512]
        common = common_counts([sets[i] for i in some], [sets[j] for j in right]) if len(right) else np.zeros((len(some), 0))
        union = sizes[some][:, None] + sizes[right][None, :] - common
        linked = common >= threshold * union - 1e-9
        if low == high:
            linked &= some[:, None] != right[None, :]
            links[some] += linked.sum(axis=1)
        else:
            links[some] += linked.sum(axis=1)
            links[right] += linked.sum(axis=0)
        for i, row in zip(some, linked):
            js = right[np.flatnonzero(row)]
            for j in js if len(js) < 64 else js[forest.roots()[js] != forest.root(int(i))]:
                if forest.join(int(i), int(j)):
                    edges.append((int(cids[i]), int(cids[j])))
    return edges, {int(c): int(n) for c, n in zip(cids, links) if n}


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """grp, n, cid and the set of shingles as bytes."""
    for b in batches:
        sets = [np.unique(shingle_hashes(t)).tobytes() for t in texts(b)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sets, pa.binary())], names=["grp", "n", "cid", "shingles"])


def linked(docs: DataFrame, id_col="doc_id", text_col="text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """k1, k2, cid, root, n_links for each document with a word.

    root is the smallest cid of its near-duplicate class, n_links the number of other shingle sets that its own is linked to.
    """
    sketched = sketches(docs, id_col, text_col)
    groups = stored(candidate_groups(sketched, threshold, tolerance), "groups")
    sizes = groups.groupBy("grp").agg(F.count("*").alias("n"))
    chosen = sketched.groupBy("cid").agg(F.min(F.struct("k1", "k2")).alias("k")).select("cid", "k.k1", "k.k2")
    chosen = stored(groups.join(sizes, "grp").join(chosen, "cid"), "members")
    # One plan for any size: the texts meet the members in a merge join.
    rows = keyed(docs, id_col, text_col).select("k1", "k2", "text").join(chosen.hint("merge"), ["k1", "k2"]).dropDuplicates(["cid"])
    sets = rows.select("grp", "n", "cid", "text").mapInArrow(_shingle_rows, "grp bigint, n bigint, cid bigint, shingles binary")
    cells = _in_blocks(sets, "grp", "n", "cid").select("grp", "low", "high", F.col("_own").alias("own"), "cid", "shingles")
    cells = cells.repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high", "cid")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, 3):
            edges, links = verified(run, threshold)
            a = [e[0] for e in edges] + list(links)
            b = [e[1] for e in edges] + [None] * len(links)
            n = [None] * len(edges) + list(links.values())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    found = stored(cells.mapInArrow(verify, "a bigint, b bigint, n bigint"), "links")
    roots = components(found.filter("b is not null").select("a", "b"))
    links = found.filter("n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n_links"))
    labels = links.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    out = sketched.select("k1", "k2", "cid").join(labels, "cid", "left")
    return out.select(
        "k1", "k2", "cid", F.coalesce("component", "cid").alias("root"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, class_id, copy_id, n_links for each row.

    class_id is the smallest id of the near-duplicate class, copy_id that of the documents with the same shingles; both are
    the document's own id where it stands alone.
    """
    labels = stored(linked(docs, id_col, text_col, **how).dropDuplicates(["k1", "k2"]), "labels")
    ids = keyed(docs, id_col, text_col).select("doc_id", "k1", "k2")
    known = stored(ids.join(labels, ["k1", "k2"], "left"), "labelled")
    first = lambda by, name: known.filter(F.col(by).isNotNull()).groupBy(by).agg(F.min("doc_id").alias(name))
    out = known.join(first("root", "class_id"), "root", "left").join(first("cid", "copy_id"), "cid", "left")
    own = F.col("doc_id")
    return out.select(
        "doc_id",
        F.coalesce("class_id", own).alias("class_id"),
        F.coalesce("copy_id", own).alias("copy_id"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each near-duplicate class, that with the smallest id; different rows without words all stay."""
    names = ("_llm_k1", "_llm_k2")
    labels = stored(linked(docs, id_col, text_col, **how).dropDuplicates(["k1", "k2"]), "labels")
    ids = keyed(docs, id_col, text_col).select("doc_id", "k1", "k2").join(labels.select("k1", "k2", "root"), ["k1", "k2"])
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    first = ids.groupBy("root").agg(F.min(order).alias("first"))
    gone = ids.join(first, "root").filter(order != F.col("first")).select(F.col("k1").alias(names[0]), F.col("k2").alias(names[1])).distinct()
    rows = docs.select("*", *row_key(id_col, text_col, names))
    single = rows.join(gone.hint("merge"), list(names), "left_anti").dropDuplicates(list(names))
    return single.select(*[F.col(f"`{c}`") for c in docs.columns])
