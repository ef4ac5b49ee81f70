"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id is the md5 of its role and text, 16 big-endian bytes; a conversation is the bytes of its turns in order. Equal
conversations are counted before anything else. The distinct byte strings are dealt into ranges of their order, so a range holds a
bounded number of them however common a first turn is, and every range becomes one adaptive radix tree: inner nodes of 4, 16, 48
and 256 places that grow when full, with whole runs of single branches kept as one compressed path. Only byte depths at the end of
a turn are nodes of the trie.

A node's members are neighbours in that order, so only prefixes that a range shares with its neighbours can be cut. All figures of
a node are sums (or a least value) over its ranges, as every node's text and every child is counted by the first range that holds it:
``saved`` is the bytes of all members from this depth on, less the bytes of the distinct nodes below. Each range gets the last string
before it and the first one after it, gives whole nodes as they are and cut ones as parts, and the parts are added up by prefix. There
is no loop over depths and no join of members to their ancestors.

Members that end at a node are listed in ascending order by streams: neighbouring ids are joined into chunks, the chunks of one
sequence are hashed in order, so a task holds one chunk.

Defined cases: turns are ordered by turn (null first), equal turns by their id; null role or text is empty; repeated rows are turns
each; rows without a conversation id take no part; an empty table has no nodes, not even a root; other columns are ignored.
A conversation travels as 24 bytes a turn, and is sorted at about 100 bytes a turn: one conversation's ids must fit a task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .frames import stored

WIDTH = 16
# Distinct sequences and bytes of one range; both only size the tasks.
RANGE_ROWS, RANGE_BYTES = 20_000, 8 << 20
CHUNK = 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Leaf:
    """One whole key: the bytes that follow its branch, and its number."""

    __slots__ = ("prefix", "value")

    def __init__(self, prefix: bytes, value: int):
        self.prefix, self.value = prefix, value

    def children(self):
        return ()


class Sorted:
    """A node of few places: branch bytes in order beside their children; grows at ``room``."""

    __slots__ = ("prefix", "value", "bytes", "nodes")
    room, wider = 4, None

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value, self.bytes, self.nodes = prefix, value, bytearray(), []

    def get(self, b: int):
        i = self.bytes.find(b)
        return self.nodes[i] if i >= 0 else None

    def put(self, b: int, node) -> "Sorted | Indexed | Direct":
        """The node to use from now on: this one, or the wider one it grew into."""
        i = bisect_left(self.bytes, b)
        if i < len(self.bytes) and self.bytes[i] == b:
            self.nodes[i] = node
            return self
        if len(self.bytes) == self.room:
            grown = self.wider(self.prefix, self.value)
            for x, child in self.children():
                grown.put(x, child)
            return grown.put(b, node)
        self.bytes.insert(i, b)
        self.nodes.insert(i, node)
        return self

    def children(self):
        return zip(self.bytes, self.nodes)


class Sorted16(Sorted):
    __slots__ = ()
    room = 16


class Indexed:
    """A node of 48 places: 256 bytes point into the list of children."""

    __slots__ = ("prefix", "value", "index", "nodes")

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value, self.index, self.nodes = prefix, value, bytearray(256), []

    def get(self, b: int):
        at = self.index[b]
        return self.nodes[at - 1] if at else None

    def put(self, b: int, node):
        if self.index[b]:
            self.nodes[self.index[b] - 1] = node
            return self
        if len(self.nodes) == 48:
            grown = Direct(self.prefix, self.value)
            for x, child in self.children():
                grown.put(x, child)
            return grown.put(b, node)
        self.nodes.append(node)
        self.index[b] = len(self.nodes)
        return self

    def children(self):
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.index) if at)


class Direct:
    """A node of 256 places."""

    __slots__ = ("prefix", "value", "nodes")

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value, self.nodes = prefix, value, [None] * 256

    def get(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node):
        self.nodes[b] = node
        return self

    def children(self):
        return ((b, x) for b, x in enumerate(self.nodes) if x is not None)


Sorted.wider, Sorted16.wider = Sorted16, Indexed


def common(a: bytes, b: bytes) -> int:
    """Length of the common head of two byte strings."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class RadixTree:
    """Adaptive radix tree from byte strings to their numbers; keys may be heads of other keys."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, value: int) -> None:
        up, branch, node, at = None, 0, self.root, 0
        while True:
            if node is None:
                made = Leaf(key[at:], value)
                break
            rest = key[at : at + len(node.prefix)]
            held = common(node.prefix, rest)
            if held < len(node.prefix):  # the compressed path is cut here
                made = Sorted(node.prefix[:held])
                b, node.prefix = node.prefix[held], node.prefix[held + 1 :]
                made.put(b, node)
                if at + held == len(key):
                    made.value = value
                else:
                    made.put(key[at + held], Leaf(key[at + held + 1 :], value))
                break
            at += held
            if at == len(key):
                node.value = value
                return
            if isinstance(node, Leaf):
                made = Sorted(node.prefix, node.value)
                made.put(key[at], Leaf(key[at + 1 :], value))
                break
            b = key[at]
            child = node.get(b)
            if child is None:
                made = node.put(b, Leaf(key[at + 1 :], value))
                if made is node:
                    return
                break
            up, branch, node, at = node, b, child, at + 1
        if up is None:
            self.root = made
        else:
            up.put(branch, made)


class Figures:
    """What a tree node needs of its members: byte interval, weights, ranks of its first and last key, sums below."""

    __slots__ = ("start", "end", "first", "last", "n", "least", "leaves", "total", "own", "tops", "key", "value", "below")


def measured(tree: RadixTree, keys: list[bytes], weights, leasts, totals, cums, before: int, last_is_leaf: bool) -> Figures:
    """Figures of all tree nodes, the lower ones first; ranks follow the order of the keys."""
    rank, stack, root = 0, [(tree.root, -1, None, None, None)], None
    while stack:
        node, start, fig, kids, parent = stack.pop()
        if fig is None:
            fig, kids = Figures(), []
            fig.start, fig.end = start, start + 1 + len(node.prefix)
            fig.value, fig.first = node.value, rank
            if node.value is not None:
                rank += 1
            stack.append((node, start, fig, kids, parent))
            stack.extend((child, fig.end, None, None, kids) for _, child in reversed(list(node.children())))
            continue
        fig.below, fig.last = kids, rank - 1
        fig.n = sum(k.n for k in kids)
        fig.total = sum(k.total for k in kids)
        fig.leaves = sum(k.leaves for k in kids)
        fig.own = sum(k.own for k in kids)
        fig.least = min((k.least for k in kids), default=None)
        fig.key = kids[0].key if kids else None
        if fig.value is not None:
            v = fig.value
            fig.n += weights[v]
            fig.total += weights[v] * totals[v]
            fig.least = leasts[v] if fig.least is None else min(fig.least, leasts[v])
            fig.key = v
            if not kids and (fig.last < len(keys) - 1 or last_is_leaf):
                fig.leaves += 1
        deepest, top = fig.end // WIDTH, fig.start // WIDTH + 1
        # Nodes on the path of the first key up to ``before`` belong to an earlier range.
        shared = before if fig.first == 0 else -1
        fig.tops = sum(k.tops for k in kids)
        if deepest >= top:
            from_ = max(top, shared + 1)
            if from_ <= deepest:
                cum = cums[fig.key]
                fig.own += int(cum[deepest] - cum[from_ - 1]) if from_ > 0 else int(cum[deepest])
            fig.tops = 1 if top > shared else 0
        if parent is None:
            root = fig
        else:
            parent.append(fig)
    return root


def nodes_of(keys: list[bytes], weights, leasts, lens, ends, previous: bytes | None, following: bytes | None) -> Iterator[tuple]:
    """The trie nodes of one range of sorted distinct keys, from the top.

    (path, depth, parent path, parent's least or null, least, members, children, leaves, saved, digest of ends, cut).
    ``path`` is given for cut nodes, the parent's path for children of cut nodes.
    """
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    cums = []
    for one in lens:
        cum = [0]
        for x in one:
            cum.append(cum[-1] + int(x))
        cums.append(cum)
    totals = [c[-1] for c in cums]
    before = -1 if previous is None else common(previous, keys[0]) // WIDTH
    after = -1 if following is None else common(keys[-1], following) // WIDTH
    last_is_leaf = following is None or not following.startswith(keys[-1])
    root = measured(tree, keys, weights, leasts, totals, cums, before, last_is_leaf)
    stack = [(root, None, None)]
    while stack:
        fig, up_path, up_least = stack.pop()
        key, cum = keys[fig.key], cums[fig.key]
        deepest, top = fig.end // WIDTH, fig.start // WIDTH + 1
        own = fig.own
        shared = before if fig.first == 0 else -1
        for depth in range(top, deepest + 1):
            cut = depth <= shared or (fig.last == len(keys) - 1 and depth <= after)
            above = cum[depth - 1] if depth else 0
            children, end = (1 if depth + 1 > shared else 0), None
            if depth == deepest:
                children, end = sum(k.tops for k in fig.below), ends[fig.value] if fig.value is not None else None
            path = hashlib.md5(key[: depth * WIDTH]).digest() if cut else None
            yield path, depth, up_path, up_least, fig.least, fig.n, children, fig.leaves, fig.total - fig.n * above - own, end, cut
            up_path, up_least = path, None if cut else fig.least
            if depth > shared:
                own -= cum[depth] - above
        stack.extend((k, up_path, up_least) for k in reversed(fig.below))


NODE_SCHEMA = (
    "part int, path binary, depth bigint, parent_path binary, parent_conv_id bigint, conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, cut boolean"
)


def _range_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one range; rows of kind -1 and 1 are the strings before and after it."""
    rows = table.to_pydict()
    place = sorted(range(table.num_rows), key=lambda i: (rows["kind"][i], rows["key"][i]))
    before = [rows["key"][i] for i in place if rows["kind"][i] < 0]
    after = [rows["key"][i] for i in place if rows["kind"][i] > 0]
    own = [i for i in place if rows["kind"][i] == 0]
    take = lambda name: [rows[name][i] for i in own]
    part = rows["part"][own[0]]
    found = nodes_of(take("key"), take("n"), take("least"), take("lens"), take("ends"), *(x[0] if x else None for x in (before, after)))
    names = ["path", "depth", "parent_path", "parent_conv_id", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "cut"]
    columns = list(zip(*found))
    types = [pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 6, pa.string(), pa.bool_()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.table([pa.array([part] * len(columns[0]), pa.int32()), *arrays], ["part", *names])


def turn_ids(role: Column, text: Column) -> Column:
    """32 hex digits that stand for one role and text."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and its turns in order: array<struct<id, bytes>>."""
    conv, turn = F.col(f"`{conv_col}`").cast("bigint"), F.col(f"`{turn_col}`").cast("bigint")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    # A struct with a null turn sorts first.
    one = F.struct(turn.alias("turn"), turn_ids(role, text).alias("id"), F.octet_length(text).alias("bytes"))
    rows = turns.select(conv.alias("conv_id"), one.alias("one")).filter("conv_id is not null")
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))).alias("turns"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (seq, conv_id) to chunks: seq, the first id and the decimal ids joined by commas."""
    out: list[tuple] = []

    def rows():
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(arrays, ["seq", "first", "ids"])

    seq, ids, held = None, [], 0
    for batch in batches:
        for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if s != seq or len(ids) == CHUNK:
                if ids:
                    out.append((seq, ids[0], ",".join(map(str, ids))))
                    held += len(ids)
                seq, ids = s, []
            ids.append(c)
        if held > CHUNK:
            yield rows()
            out, held = [], 0
    if ids:
        out.append((seq, ids[0], ",".join(map(str, ids))))
        yield rows()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest for each sequence."""
    seq, digest, out = None, None, []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["seq", "ends"])

    for batch in batches:
        for s, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if s != seq:
                if seq is not None:
                    out.append((seq, digest.hexdigest()))
                seq, digest = s, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield rows()
            out = []
    if seq is not None:
        out.append((seq, digest.hexdigest()))
        yield rows()


def ends_of(members: DataFrame) -> DataFrame:
    """seq and the digest of its members, from (seq, conv_id)."""
    ordered = members.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    chunks = ordered.mapInArrow(_joined, "seq binary, first bigint, ids string")
    return chunks.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_hashed, "seq binary, ends string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row for every distinct prefix of ``sequences`` (conv_id, turns), the empty one included."""
    # An array function that joins at once; a fold over concat would copy the key for each turn.
    key = F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), ""))
    rows = sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda x: x["bytes"].cast("bigint")).alias("lens"))
    rows = stored(rows.withColumn("seq", F.unhex(F.md5("key"))), "trie-rows")
    distinct = rows.groupBy("seq").agg(F.first("key").alias("key"), F.first("lens").alias("lens"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    distinct = stored(distinct.join(ends_of(rows), "seq").drop("seq"), "trie-keys")
    size = distinct.agg(F.count("*").alias("n"), F.sum(F.length("key") * 1.5 + 64).alias("bytes")).first()
    parts = max(1, -(-size.n // RANGE_ROWS), int((size.bytes or 0) // RANGE_BYTES) + 1)
    ranged = stored(distinct.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "trie-ranges")
    # One row for each range: the string before it and the one after it.
    order = W.orderBy("part")
    ends = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    beside = [ends.select("part", F.lag("high").over(order).alias("key"), F.lit(-1).alias("kind"))]
    beside.append(ends.select("part", F.lead("low").over(order).alias("key"), F.lit(1).alias("kind")))
    beside = beside[0].union(beside[1]).filter("key is not null")
    held = ranged.withColumn("kind", F.lit(0)).unionByName(beside, allowMissingColumns=True)
    nodes = stored(held.groupBy("part").applyInArrow(_range_nodes, NODE_SCHEMA), "trie-nodes")
    return _whole(nodes)


def _whole(nodes: DataFrame) -> DataFrame:
    """Parts of cut nodes added up, and the parents of nodes under cut ones filled in."""
    cut = nodes.filter("cut")
    added = cut.groupBy("path", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("parent_path").alias("parent_path"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    added = stored(added, "trie-cut")
    least = added.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("above"))
    # By range and prefix: a node with many children is met in each range by the children there.
    near = cut.select("part", F.col("path").alias("parent_path")).join(least, "parent_path")
    under = nodes.filter("not cut and parent_path is not null").drop("parent_conv_id").join(near, ["part", "parent_path"])
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")]
    top = added.join(least, "parent_path", "left").withColumnRenamed("above", "parent_conv_id")
    inside = nodes.filter("not cut and parent_path is null")
    return inside.select(*out).unionByName(under.withColumnRenamed("above", "parent_conv_id").select(*out)).unionByName(top.select(*out))


def rebuilt(sequences: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % every; h is crc32(c) % most."""
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    heads = sequences.select(F.col("conv_id").alias("donor"), F.slice("turns", 1, most - 1).alias("head"))
    rows = sequences.withColumn("donor", F.col("conv_id") - F.pmod("conv_id", F.lit(every))).withColumn("h", h).join(heads, "donor", "left")
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(F.slice("head", 1, F.col("h")))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, own).alias("turns"))
