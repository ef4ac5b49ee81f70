"""Search of many queries by blocks, and the recall of the approximate form."""

import numpy as np
from pyspark.sql import functions as F

from bazaarflow.operators import search as S
from registry import QUERIES


def frame(spark, matrix, key, name):
    return spark.createDataFrame([(f"{key}{i}", [float(x) for x in v]) for i, v in enumerate(matrix)], f"{name}_id string, {'embedding' if key == 'R' else 'query_vector'} array<double>")


def pairs(df):
    return {(r.query_id, r.review_id) for r in df.collect()}


def test_blocks_equal_the_plain_form(spark):
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(400, 8))
    vectors[:40] = vectors[40:80]  # ties
    vectors[90] = 0
    held = frame(spark, vectors, "R", "review").unionAll(spark.createDataFrame([("none", None)], "review_id string, embedding array<double>"))
    asked = frame(spark, draw.normal(size=(60, 8)), "Q", "query")
    want = S.semantic_search(asked, held, k=7)
    got = S.semantic_search(asked, held, k=7, max_query_bytes=0, block_bytes=2000)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert S.semantic_search(asked, held.limit(0), max_query_bytes=0).count() == 0


def test_near_neighbours_are_found_with_the_defaults(spark):
    """Groups of ten vectors around a centre: their cosine is about 0.9."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(120, 64)) / 8
    vectors = np.repeat(centres, 10, axis=0) + draw.normal(size=(1200, 64)) * 0.04
    held, asked = frame(spark, vectors, "R", "review"), frame(spark, centres[:40], "Q", "query")
    exact, found = (pairs(f(asked, held, k=5)) for f in (S.semantic_search, S.approximate_search))
    assert len(exact & found) >= 0.9 * len(exact)


def test_recall_on_the_given_vectors(spark, root):
    exact = pairs(QUERIES["v2_semantic_search"](spark, root))
    found = QUERIES["v2_approximate_search"](spark, root)
    assert len(exact & pairs(found)) >= 0.9 * len(exact)
    assert found.filter(F.col("place") > 5).count() == 0
