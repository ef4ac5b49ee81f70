"""The prefix trie against a plain version, whole and cut into many ranges."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bazaarflow.llm import radix_trie
from bazaarflow.llm.queries import QUERIES, SQL
from tools.compare import duck, rows_of_duck, rows_of_spark

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(convs):
    """Nodes of {conv_id: [(role, text), ...]} as the definition states them."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(set)
    for path in members:
        if path:
            kids[path[:-1]].add(path)
    leaves, saved, out = {}, {}, set()
    for path in sorted(members, key=len, reverse=True):
        bytes_ = len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = sum(saved[k] for k in kids[path]) + (len(members[path]) - 1) * bytes_
    for path, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(path))))
        up = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(held), len(path), up, len(held), len(kids[path]), leaves[path], saved[path], digest))
    return out


def ordered(rows):
    """{conv_id: turns} by turn, null first, equal turns by their id."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}


def spliced(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def nodes(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(r) for r in df.select(*cols).collect()]
    assert len(got) == len(set(got))
    return set(got)


def trie(spark, rows, splice=False):
    seqs = radix_trie.sequences(spark.createDataFrame(rows, SCHEMA))
    return nodes(radix_trie.prefix_trie(radix_trie.rebuilt(seqs) if splice else seqs))


@pytest.fixture(scope="module")
def mixed():
    """Common first turns, copies, heads of other conversations, long ones, empty and repeated turns."""
    draw, rows = random.Random(7), []
    words = ["hi", "", "ü€", "yes", "no", "long " * 50]
    for c in range(400):
        if c % 3 == 0:
            turns = [("user", "same"), ("assistant", "first")] + [("user", draw.choice(words)) for _ in range(draw.randrange(5))]
        else:
            turns = [(draw.choice(["user", "assistant", "system"]), draw.choice(words)) for _ in range(draw.randrange(1, 7))]
        if c in (7, 8):
            turns = [("user", f"{i}") for i in range(500)] + [("assistant", str(c))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    rows += [(None, 0, "user", "x"), (500, None, None, None), (500, 1, "user", "a"), (500, 1, "user", "a"), (500, 1, "assistant", "b"), (-3, 0, "user", "same")]
    return rows


def test_registered_query_equals_plain_version_and_sql(spark, root):
    rows = [tuple(r) for r in spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_prefix_trie"](spark, root)
    assert nodes(found) == plain(spliced(ordered(rows)))
    names, values, _ = rows_of_duck(duck(root), SQL["op11_prefix_trie"])
    assert (names, values) == rows_of_spark(found)


def test_whole_and_cut_tries_equal_the_plain_version(spark, mixed, monkeypatch):
    want = plain(ordered(mixed))
    assert trie(spark, mixed) == want
    monkeypatch.setattr(radix_trie, "RANGE_ROWS", 11)
    assert trie(spark, mixed) == want
    monkeypatch.setattr(radix_trie, "RANGE_ROWS", 1)
    assert trie(spark, mixed) == want
    assert trie(spark, mixed, splice=True) == plain(spliced(ordered(mixed)))


def test_many_copies_and_their_ends(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(2)] + [(5000, 0, "user", "turn 0")]
    want = plain(ordered(rows))
    assert trie(spark, rows) == want
    monkeypatch.setattr(radix_trie, "CHUNK", 64)
    assert trie(spark, rows) == want


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert radix_trie.prefix_trie(radix_trie.sequences(empty)).collect() == []
    assert trie(spark, [(1, None, None, None)]) == plain({1: [("", "")]})
    turnless = radix_trie.rebuilt(radix_trie.sequences(spark.createDataFrame([(c, 0, "user", "only") for c in range(1, 60)], SCHEMA)))
    assert nodes(radix_trie.prefix_trie(turnless)) == plain(spliced({c: [("user", "only")] for c in range(1, 60)}))
    clash = spark.createDataFrame([(1, 0, "u", "a")], SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("id", "bytes", "key", "part", "depth", "seq", "one", "turns", "donor", "h")])
    assert nodes(radix_trie.prefix_trie(radix_trie.rebuilt(radix_trie.sequences(clash)))) == plain(spliced({1: [("u", "a")]}))


def test_tree_holds_all_keys_through_all_layouts():
    draw = random.Random(3)
    keys = sorted({bytes(draw.randrange(256) for _ in range(draw.randrange(1, 5))) for _ in range(20_000)} | {bytes([b]) for b in range(256)})
    keys = sorted({*keys, *(bytes([200, 7, b]) for b in range(12)), *(bytes([201, 7, 9, 9, b]) for b in range(3))})
    tree, kinds = radix_trie.RadixTree(), set()
    for i in draw.sample(range(len(keys)), len(keys)):
        tree.insert(keys[i], i)
    found, stack = {}, [(tree.root, b"")]
    while stack:
        node, head = stack.pop()
        kinds.add(type(node).__name__)
        head += node.prefix
        if node.value is not None:
            found[node.value] = head
        for b, child in node.children():
            assert node.get(b) is child
            stack.append((child, head + bytes([b])))
    assert [found[i] for i in range(len(keys))] == keys
    assert kinds == {"Leaf", "Sorted", "Sorted16", "Indexed", "Direct"}
