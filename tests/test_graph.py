"""Levels of deep, cyclic and random graphs, and the number of rounds they take."""

import random
from collections import defaultdict

import pytest

from bazaarflow.operators import graph as G


def plain(pairs, nodes=()):
    """Levels by Kahn's order; nodes on or behind a cycle have none."""
    after, waiting, level = defaultdict(set), defaultdict(int), {}
    for a, b in set(pairs):
        after[a].add(b)
        waiting[b] += 1
    ready = [n for n in {x for p in pairs for x in p} | set(nodes) if not waiting[n]]
    level = dict.fromkeys(ready, 0)
    best = defaultdict(int)
    for n in ready:
        for m in after[n]:
            best[m] = max(best[m], level[n] + 1)
            waiting[m] -= 1
            if not waiting[m]:
                level[m] = best[m]
                ready.append(m)
    return level


def levels(spark, pairs, nodes=None):
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    given = None if nodes is None else spark.createDataFrame([(n,) for n in nodes], "node bigint")
    return {r.node: r.level for r in G.topo_levels(edges, given).collect()}


@pytest.fixture
def rounds(monkeypatch):
    seen = []
    real = G._next_round
    monkeypatch.setattr(G, "_next_round", lambda *a: seen.append(1) or real(*a))
    return seen


def test_a_deep_chain_takes_few_rounds(spark, rounds):
    pairs = [(i, i + 1) for i in range(2000)]
    random.Random(1).shuffle(pairs)
    assert levels(spark, pairs) == plain(pairs)
    assert len(rounds) <= 15


def test_random_graphs_and_cycles(spark):
    draw = random.Random(5)
    pairs = []
    for base in range(0, 400, 40):  # ten graphs side by side: sparse to dense, half of them with edges back
        for _ in range(draw.randrange(30, 90)):
            a, b = draw.randrange(40), draw.randrange(40)
            if a != b and (base % 80 == 0 or a < b or draw.random() < 0.03):
                pairs.append((base + min(a, b), base + max(a, b)) if base % 80 == 0 else (base + a, base + b))
    pairs += pairs[:20] + [(500, 500), (500, 501), (600, 601), (601, 602), (602, 601), (602, 603), (599, 602)]
    assert levels(spark, pairs, [1000, 3]) == plain(pairs, [1000, 3])
    # A cycle beside a long path does not end the rounds early, nor do its lengths overflow.
    long = [(i, i + 1) for i in range(0, 80)] + [(i, i + 2) for i in range(0, 40)] + [(901, 902), (902, 903), (903, 901), (903, 80)]
    assert levels(spark, long) == plain(long)


def test_edges_without_an_end_are_none(spark):
    assert levels(spark, [(1, 2), (None, 2), (2, None)]) == {1: 0, 2: 1}
    assert levels(spark, [(None, None)], [4]) == {4: 0}
