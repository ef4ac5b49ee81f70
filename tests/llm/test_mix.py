"""How near the mix comes to its targets, and inputs whose columns are named as the operator's own."""

from collections import defaultdict

from pyspark.sql import functions as F

from bazaarflow.llm import mixing
from bazaarflow.llm.queries import QUERIES


def taken_of(spark, sources, **given):
    """{source: (target, taken, smallest document)} of sources given as lists of document sizes."""
    rows = [(f"{name}-{i}", n, name) for name, sizes in sources.items() for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id string, n int, source string").withColumn("text", F.expr("repeat('w ', n)"))
    out = defaultdict(lambda: [0.0, 0, 1 << 60])
    for r in mixing.mixed(docs, **given).collect():
        one = out[r.source]
        one[0], one[1], one[2] = r.target, one[1] + r.copies * r.size, min(one[2], r.size)
        assert 0 <= r.copies <= 2 and r.size == r.n
    return out


def test_sources_meet_targets_that_can_be_reached(spark):
    """Every source lies within its smallest document or one percent of its target."""
    shapes = {
        "one_long": [100] * 300 + [20_000],
        "one_half": [100] * 50 + [5_000],
        "mixed": [1 + (i * i) % 977 for i in range(400)] + [9_000, 4_000],
        "single": [700],
        "steps": [2**i for i in range(12)] * 3,
        "equal": [10] * 77,
    }
    for name, sizes in shapes.items():  # each alone, so that targets are half above the sizes
        (target, taken, least), = taken_of(spark, {name: sizes}).values()
        assert abs(target - 1.5 * sum(sizes)) < 1e-6
        assert abs(taken - target) <= max(least, 0.01 * target), name
    for name, (target, taken, least) in taken_of(spark, shapes).items():
        assert abs(taken - target) <= max(least, 0.01 * target), name


def test_registered_mix_is_near_every_target(spark, root):
    sums, size = defaultdict(int), defaultdict(lambda: 1 << 60)
    target = {}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "source").collect()}
    for r in QUERIES["op7_mixing"](spark, root).collect():
        s = source[r.doc_id]
        sums[s] += r.taken
        target[s] = r.target
        if r.size:
            size[s] = min(size[s], r.size)
    # Sources of ten documents: what single documents allow.
    assert all(abs(sums[s] - t) <= max(size[s], 0.02 * t) for s, t in target.items())


def test_clashing_columns_change_nothing(spark):
    docs = spark.createDataFrame([(i, "w " * (i + 1), f"s{i % 2}") for i in range(40)], "doc_id bigint, text string, source string")
    plain = {r.doc_id: r.copies for r in mixing.mixed(docs).collect()}
    names = ["size", "odds", "rate", "target", "source_size", "whole", "s0", "s1", "bins", "bin", "rest", "cut", "last", "missing", "lean", "rank", "row", "steps", "still", "copies", "k1", "words"]
    found = mixing.mixed(docs.select("*", *[F.lit("x").alias(n) for n in names]))
    assert len(found.columns) == len(set(found.columns))
    assert {r.doc_id: r.copies for r in found.collect()} == plain
    assert found.select("odds", "rank", "row").distinct().collect() == [("x", "x", "x")]
