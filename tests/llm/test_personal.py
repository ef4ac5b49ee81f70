"""Address parts of zeros, texts of very many matches, and both settings of ANSI mode."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from bazaarflow.llm import pii

from .test_corpus import TRICKY, brute_base

ZEROS = ["127.0.0.1 and 10.0.0.1", "0.0.0.0", "000.00.0.0000", "00255.0.0.1 0256.0.0.0", "99999999999999999999.1.1.1 1.2.3.00000000000000000000000000004", "1.1.1.256 0.0.0"]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def compared(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pii.digest(pii.personal_data(df)).collect():
        want = brute_base(texts[r.doc_id])
        named = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.spans.startswith(named), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()


def test_base_spans_under_both_settings(spark, ansi):
    draw = random.Random(9)
    parts = ["127.0.0.1", "0.0.0.0", "a@b.c", "4111 1111 1111 1111", "+49 30 1234567", " ", "0", ".", "é", "𝄞", "1", "@", "-", "x"]
    mixed = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(400)]
    compared(spark, [*ZEROS, *TRICKY, *mixed])


def test_many_matches_take_time_in_proportion(spark):
    many = " ".join(f"é user{i}@mail{i % 7}.example.org" for i in range(40_000))
    df = spark.createDataFrame([(1, "a@b.c")], "doc_id bigint, text string")
    pii.digest(pii.personal_data(df)).collect()
    start = time.time()
    got = pii.digest(pii.personal_data(spark.createDataFrame([(1, many)], "doc_id bigint, text string"))).first()
    took = time.time() - start
    want = brute_base(many)
    assert got.n_email == 40_000 and took < 30  # lists copied for each match took minutes
    named = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
    assert got.base_sha256 == hashlib.sha256(named.encode()).hexdigest()


def test_context_raises_the_score(spark):
    texts = ["mail: a@b.c", "x a@b.c y", "call +49 30 1234567 now", "4111 1111 1111 1111" + " " * 60 + "card"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.personal_data(df).select("doc_id", F.array_join("scored", ",").alias("s"), F.size("email").alias("n")).collect()}
    assert [got[i].s.rsplit(":", 1)[1] for i in range(4)] == ["1.00", "0.90", "0.70", "0.80"]
