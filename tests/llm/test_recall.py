"""Recall of the permutation index by inner product on vectors of varied length, and spans named by two hashes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarflow.llm import permutation_index, span_dedup


@pytest.mark.parametrize("sigma", [0.0, 0.5, 1.0, 1.5])
def test_recall_does_not_depend_on_lengths(spark, sigma):
    draw = np.random.default_rng(int(sigma * 10))
    x = draw.normal(size=(3000, 64))
    x *= np.exp(draw.normal(size=(3000, 1)) * sigma) / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in permutation_index.search(df, F.col("id") % 100 == 0).collect():
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.id]), abs=1e-9)
        found.setdefault(r.query_id, set()).add(r.id)
    hits = 0
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got & set(np.argsort(-score)[:20].tolist()))
    assert len(found) == 30 and hits >= 0.95 * 600


def test_spans_of_one_hash_are_told_apart(spark, monkeypatch):
    """With the first hash made the same for all spans, the second one alone decides."""
    real = span_dedup.spans

    def clashing(text):
        first, last, h, g = real(text)
        return first, last, np.zeros_like(h), g

    sentence = lambda a: " ".join(f"{a}{i}" for i in range(12)) + ". "
    shared = sentence("x") + sentence("y") + sentence("z")
    texts = [sentence("a") + shared, sentence("b") + sentence("c") + shared + sentence("d"), sentence("e") * 1 + sentence("f") + sentence("g")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = sorted(map(tuple, span_dedup.deduplicated(df).collect()))
    assert want[1][1] != texts[1] and want[2][1] == texts[2]
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"doc_id": [0, 1, 2], "k1": [0, 1, 2], "k2": [0, 1, 2], "text": texts})
    monkeypatch.setattr(span_dedup, "spans", clashing)
    (batch,) = span_dedup._span_rows(iter([rows]))
    found = batch.to_pydict()
    assert set(found["h"]) == {0}
    by_second = {}
    for doc, g in zip(found["doc_id"], found["g"]):
        by_second.setdefault(g, set()).add(doc)
    assert {frozenset(d) for d in by_second.values() if len(d) > 1} == {frozenset({0, 1})}
