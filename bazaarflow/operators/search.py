"""Exact cosine search of many queries at once, and text context built from the hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F, Window as W

from ..functions.numeric import round_half_up
from ..session import materialize
from .reviews import sentiment_summary
from .topk import urgent_reviews


# Scores held in memory at a time by a task.
SCORES_AT_ONCE = 4_000_000


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    norms[norms == 0] = 1.0
    return rows / norms


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best scores, equal scores in id order."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _search_pass(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """k best vectors per query and task; ``queries`` must fit into memory."""
    rows = queries.collect()
    qids = [str(r["query_id"]) for r in rows]
    matrix = _unit(np.array([r["query_vector"] for r in rows], dtype="float64"))
    shared = vectors.sparkSession.sparkContext.broadcast((qids, matrix))
    id_type = vectors.schema["review_id"].dataType.simpleString()
    qid_type = queries.schema["query_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, targets = shared.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        floor = np.full(len(names), -np.inf)
        step = max(1, SCORES_AT_ONCE // len(names))
        for batch in batches:
            ids = np.array(batch.column("review_id").to_pylist())
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, step):
                rows = min(step, batch.num_rows - at)
                width = targets.shape[1]
                block = _unit(flat[at * width : (at + rows) * width].reshape(rows, width).astype("float64"))
                scores = block @ targets.T
                # Only queries for which something here reaches their k best so far.
                for q in np.flatnonzero((scores >= floor).any(axis=0)):
                    mine, mine_ids = scores[:, q], ids[at : at + rows]
                    if q in best:
                        mine, mine_ids = np.concatenate([best[q][0], mine]), np.concatenate([best[q][1], mine_ids])
                    top = _best(mine, mine_ids, k)
                    best[q] = (mine[top], mine_ids[top])
                    floor[q] = mine[top[-1]] if len(top) == k else -np.inf
        for q, (found, found_ids) in best.items():
            yield pa.RecordBatch.from_pydict(
                {"query_id": [names[q]] * len(found), "review_id": [str(i) for i in found_ids], "score": found.tolist()}
            )

    slim = vectors.select("review_id", "embedding").filter(F.col("embedding").isNotNull())
    hits = slim.mapInArrow(scan, "query_id string, review_id string, score double")
    return hits.select(F.col("query_id").cast(qid_type), F.col("review_id").cast(id_type), "score")


def _block_join(queries: DataFrame, vectors: DataFrame, k: int, block_bytes: int) -> DataFrame:
    """k best vectors per query and cell, a cell being one block of queries against one block of vectors.

    The vectors are read once and dealt into blocks by id, queries likewise; every block meets all blocks of the other side, and a
    task holds one of each. Neither side passes through the driver, whatever its number of rows.
    """
    id_type, qid_type = (df.schema[c].dataType.simpleString() for df, c in ((vectors, "review_id"), (queries, "query_id")))
    slim = vectors.select("review_id", "embedding").filter(F.col("embedding").isNotNull())
    sizes = [df.agg(F.coalesce(F.sum(F.size(c)), F.lit(0)) * 8).first()[0] for df, c in ((slim, "embedding"), (queries, "query_vector"))]
    v_blocks, q_blocks = (max(1, -(-size // block_bytes)) for size in sizes)
    # Numbers of all blocks of the other side; their count is a size over a size, not a number of rows.
    dealt = lambda df, key, own, n, other, m: df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<bigint>")))
    left = dealt(queries.select("query_id", "query_vector"), "query_id", "q", q_blocks, "v", v_blocks)
    right = dealt(slim, "review_id", "v", v_blocks, "q", q_blocks)

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        qids, ids = asked.column("query_id").to_pylist(), held.column("review_id").to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        if qids and ids:
            targets, places = _unit(np.array(asked.column("query_vector").to_pylist(), dtype="float64")), np.array(ids)
            block = _unit(np.array(held.column("embedding").to_pylist(), dtype="float64"))
            step = max(1, SCORES_AT_ONCE // len(ids))
            for at in range(0, len(qids), step):
                scores = targets[at : at + step] @ block.T
                for q, mine in enumerate(scores, at):
                    top = _best(mine, places, k)
                    out[0].extend([str(qids[q])] * len(top))
                    out[1].extend(str(ids[i]) for i in top)
                    out[2].extend(mine[top].tolist())
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.string(), pa.float64()))], ["query_id", "review_id", "score"])

    hits = left.groupBy("q", "v").cogroup(right.groupBy("q", "v")).applyInArrow(meet, "query_id string, review_id string, score double")
    return hits.select(F.col("query_id").cast(qid_type), F.col("review_id").cast(id_type), "score")


def semantic_search(
    queries: DataFrame, vectors: DataFrame, k: int = 5, sentiment: str | None = None, max_query_bytes: int = 8 << 20, block_bytes: int = 32 << 20
) -> DataFrame:
    """The k most similar vectors of each query: (query_id, place, review_id, similarity_score).

    ``queries``: query_id, query_vector. The filter runs before any scoring, and the vectors are scanned once. Queries of up to
    ``max_query_bytes`` go to the tasks as they are; more of them are dealt into blocks of ``block_bytes`` that meet blocks of vectors.
    """
    if sentiment is not None:
        vectors = vectors.filter(F.col("sentiment") == sentiment)
    size = queries.agg(F.coalesce(F.sum(F.size("query_vector")), F.lit(0)) * 8).first()[0]
    if not size:
        schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, place int, " \
                 f"review_id {vectors.schema['review_id'].dataType.simpleString()}, similarity_score double"
        return queries.sparkSession.createDataFrame([], schema)
    found = _search_pass(queries, vectors, k) if size <= max_query_bytes else _block_join(queries, vectors, k, block_bytes)
    return _placed(found, k)


def _placed(found: DataFrame, k: int) -> DataFrame:
    by = W.partitionBy("query_id").orderBy(F.desc("score"), "review_id")
    best = found.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= k)
    return best.select("query_id", "place", "review_id", round_half_up("score", 3).alias("similarity_score"))


def _unit_vector(c: str) -> F.Column:
    """A vector of length one as the learning library wants it."""
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return array_to_vector(F.transform(c, lambda x: F.coalesce(F.try_divide(x.cast("double"), norm), F.lit(0.0))))


def approximate_search(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    sentiment: str | None = None,
    tables: int = 12,
    projections: int = 6,
    bucket_length: float = 0.3,
    seed: int = 7,
) -> DataFrame:
    """As ``semantic_search`` by random projections in buckets: only vectors that share a bucket with a query are scored.

    A bucket is ``projections`` neighbouring strips of ``bucket_length``, and each of ``tables`` independent sets of buckets gives another
    chance to meet. Scores of what is found are exact. More tables, fewer projections and wider strips find more and score more; how
    much is found depends on how near the neighbours are. Vectors of a cosine of 0.9 meet in about nine of ten cases with the defaults and
    unrelated ones of 64 dimensions in about one of five; where all neighbours are far, as among random vectors, no selective setting finds
    them, and the exact search is as cheap.
    """
    if sentiment is not None:
        vectors = vectors.filter(F.col("sentiment") == sentiment)
    slim = vectors.select("review_id", "embedding").filter(F.col("embedding").isNotNull())
    asked = queries.select("query_id", "query_vector")
    lsh = BucketedRandomProjectionLSH(inputCol="unit", outputCol="strips", numHashTables=tables * projections, bucketLength=bucket_length, seed=seed)
    # The projections depend on the dimension and the seed alone.
    model = lsh.fit(asked.select(_unit_vector("query_vector").alias("unit")))

    def buckets(df: DataFrame, key: str, vector: str) -> DataFrame:
        strips = F.transform("strips", lambda v: vector_to_array(v)[0].cast("bigint"))
        rows = model.transform(df.select(key, _unit_vector(vector).alias("unit"))).select(key, strips.alias("s"))
        each = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.xxhash64(t, F.slice("s", t * projections + 1, projections)))
        return rows.select(key, F.explode(each).alias("bucket"))

    pairs = buckets(asked, "query_id", "query_vector").join(buckets(slim, "review_id", "embedding"), "bucket").select("query_id", "review_id").distinct()
    met = pairs.join(asked, "query_id").join(slim, "review_id")
    unit = lambda c: vector_to_array(_unit_vector(c))
    score = F.aggregate(F.zip_with(unit("query_vector"), unit("embedding"), lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    return _placed(met.select("query_id", "review_id", score.alias("score")), k)


# Fixed value: the text for a question that nothing is known about.
NO_DATA = "No relevant data found in database."


def assemble_context(
    hits: DataFrame, reviews: DataFrame, urgent: int = 3, shown: int = 200, questions: DataFrame | None = None
) -> DataFrame:
    """One text per question: its reviews, the sentiment distribution, the urgent issues.

    ``hits`` come from ``semantic_search``; only they are joined to the review texts. With ``questions``
    (query_id) every one of them has a row, also without hits. Each section appears if it has lines.
    """
    hits = materialize(hits)
    asked = (hits if questions is None else questions).select("query_id").distinct()
    payload = reviews.select("review_id", "sentiment", "seller_id", "one_line_summary", "review_text")
    line = F.format_string(
        f"%d. [%s] Similarity: %.2f | Seller: %s | Summary: %s | Text: %s...",
        "place",
        "sentiment",
        round_half_up("similarity_score", 2),
        F.col("seller_id").cast("string"),
        "one_line_summary",
        F.substring("review_text", 1, shown),
    )
    lines = hits.join(payload, "review_id").select("query_id", F.struct("place", line.alias("line")).alias("l"))
    # At most k lines for a question.
    found = lines.groupBy("query_id").agg(F.array_sort(F.collect_list("l"))["line"].alias("lines"))
    stat = F.format_string(
        "- %s: %d reviews (avg score: %s, avg rating: %s)",
        "sentiment",
        "count",
        F.col("avg_score").cast("string"),
        F.col("avg_rating").cast("string"),
    )
    stats = sentiment_summary(reviews).select((-F.col("count")).alias("o"), F.col("sentiment").alias("s"), stat.alias("line"))
    stat_lines = stats.agg(F.array_sort(F.collect_list(F.struct("o", "s", "line")))["line"].alias("x")).scalar()

    level = F.when(F.col("urgency_level") == "CRITICAL", 1).otherwise(2)
    issue = F.format_string(
        "- [%s] Seller %s in %s: %s", "urgency_level", F.col("seller_id").cast("string"), "city", "one_line_summary"
    )
    open_ = urgent_reviews(reviews, urgent).select(
        level.alias("o"), (-F.unix_date("review_date")).alias("d"), "review_id", issue.alias("line")
    )
    issue_lines = open_.agg(F.array_sort(F.collect_list(F.struct("o", "d", "review_id", "line")))["line"].alias("x")).scalar()

    def section(title: str, body) -> F.Column:
        empty = F.array().cast("array<string>")
        return F.when(F.size(body) > 0, F.concat(F.array(F.lit(title)), body)).otherwise(empty)

    everything = F.concat(
        section("RELEVANT REVIEWS FROM DATABASE:", F.col("lines")), section("\nSENTIMENT DISTRIBUTION:", stat_lines), section("\nURGENT ISSUES REQUIRING ACTION:", issue_lines)
    )
    whole = F.when(F.size(everything) > 0, F.array_join(everything, "\n")).otherwise(NO_DATA)
    return asked.join(found, "query_id", "left").select("query_id", whole.alias("context"))
