"""Approximate nearest neighbours with a permutation index.

Every vector is represented by the order of its ``prefix`` nearest pivots. Nearness is the inner product: a vector gets one more
coordinate that brings all to the length of the longest, a query gets none, and then the order by angle is that by inner product. Vectors are dealt at random into blocks; a block
holds an inverted file for each pivot with the rows that have it in their prefix and its place there. A query adds up, over
the files of its own pivots, how much each row's footrule distance shrinks; the ``share`` of the rows of a block with the
smallest distance is reranked by exact inner products in double precision. The best of all blocks are the answer.

Queries are dealt into chunks, and a task works on one chunk against one block, both of bounded size; a task returns ``k``
rows for each query, never pairs.

Pivots are a sample of ``pivots`` vectors with the smallest hashes. Equal vectors are one entry with their ``k + 1``
smallest ids, which is all that any query can return, so groups of copies add no work.

Defined cases: vectors that are null, zero, or hold a null or a non-finite component take no part, nor do those of
another length than the most common one; ties go to the smaller id; a query with fewer candidates returns all of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .frames import stored

PIVOTS, PREFIX, SHARE = 256, 64, 0.35
BLOCK, CHUNK = 4096, 1024


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def entries(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """vector, its smallest ids in order (k + 1 at most), and the smallest of them as its name."""
    own = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    own = own.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + 0.0))
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    few = own.distinct().withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("entry", F.col("ids")[0])


def lifted(x: np.ndarray, longest: float | None) -> np.ndarray:
    """Unit vectors with one coordinate more: what ``x`` lacks of the ``longest`` length, or none for queries."""
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    if longest is None:
        return np.hstack([x / norms, np.zeros_like(norms)])
    return np.hstack([x / longest, np.sqrt(np.maximum(0.0, 1.0 - (norms / longest) ** 2))])


def prefixes(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the nearest pivots by angle, nearest first; ties go to the smaller number. Both sides are unit vectors."""
    near = x @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.int16)


def footrule_gain(rows: np.ndarray, queries: np.ndarray, pivots: int) -> np.ndarray:
    """How much smaller the footrule distance is than that of prefixes with nothing in common (half of it).

    A pivot at places a and b, both counted as ``length`` where it is missing, adds |a - b|; sharing it saves
    2 * (length - max(a, b)). Only the inverted files of a query's own pivots are read.
    """
    length = rows.shape[1]
    gain = np.zeros((len(queries), len(rows)), dtype=np.int32)
    row_order, query_order = np.argsort(rows, axis=None, kind="stable"), np.argsort(queries, axis=None, kind="stable")
    row_at = np.searchsorted(rows.ravel()[row_order], np.arange(pivots + 1))
    query_at = np.searchsorted(queries.ravel()[query_order], np.arange(pivots + 1))
    for p in range(pivots):
        post, asks = row_order[row_at[p] : row_at[p + 1]], query_order[query_at[p] : query_at[p + 1]]
        if len(post) and len(asks):
            saved = length - np.maximum((asks % length)[:, None], (post % length)[None, :])
            gain[np.ix_(asks // length, post // length)] += saved.astype(np.int32)
    return gain


def search(vectors: DataFrame, is_query: Column, id_col="vec_id", vector_col="embedding", k=20, pivots=PIVOTS, prefix=PREFIX, share=SHARE) -> DataFrame:
    """query_id, rank, id and score: for each row with ``is_query`` (on its id) the ``k`` nearest other rows found."""
    index = stored(entries(vectors, id_col, vector_col, k), "vectors")
    largest = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("square")
    stats = index.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), largest).orderBy(F.desc("n"), "dim").first()
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    if stats is None:
        return empty
    dim, n = stats["dim"], stats["n"]
    index = index.filter(F.size("v") == dim)
    sampled = index.orderBy(F.xxhash64(F.lit(7), "v"), "entry").limit(pivots).select("v").collect()
    longest = float(np.sqrt(stats["square"]))
    centres = lifted(np.array([r["v"] for r in sampled]), longest)
    length, blocks = min(prefix, len(centres)), max(1, -(-n // BLOCK))

    ids = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    asked = ids.filter(is_query & usable(F.col("v")) & (F.size("v") == dim)).select("id", F.transform("v", lambda x: x + 0.0).alias("v")).distinct()
    asked = stored(asked.join(index.select("v", "entry"), "v").select("id", "entry"), "queries")
    names = asked.select("entry").distinct()
    chunks = max(1, -(-names.count() // CHUNK))

    def packed(upto: float | None):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            order = np.argsort(pdf["entry"].to_numpy())
            x = np.stack(pdf["v"].to_numpy())[order]
            row = {"names": pdf["entry"].to_numpy()[order].tobytes(), "data": x.tobytes(), "orders": prefixes(lifted(x, upto), centres, length).tobytes()}
            return pd.DataFrame([{"part": int(pdf["part"].iloc[0]), **row}])

        return run

    kinds = "part int, names binary, data binary, orders binary"
    deal = lambda m, salt: F.pmod(F.xxhash64(F.lit(salt), "entry"), F.lit(m)).cast("int").alias("part")
    rows = index.select("entry", "v", deal(blocks, 11)).groupBy("part").applyInPandas(packed(longest), kinds)
    asks = index.join(names, "entry", "left_semi").select("entry", "v", deal(chunks, 13)).groupBy("part").applyInPandas(packed(None), kinds)
    rows = rows.select(F.col("part").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "names", "data", "orders")
    asks = asks.select(F.col("part").alias("chunk"), *[F.col(c).alias(f"q_{c}") for c in ("names", "data", "orders")])

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        names_, q_names = np.frombuffer(r["names"], dtype=np.int64), np.frombuffer(r["q_names"], dtype=np.int64)
        data, q_data = (np.frombuffer(r[c]).reshape(-1, dim) for c in ("data", "q_data"))
        orders, q_orders = (np.frombuffer(r[c], dtype=np.int16).reshape(-1, length) for c in ("orders", "q_orders"))
        many = min(len(data), max(k + 1, int(np.ceil(share * len(data)))))
        out = []
        for at in range(0, len(q_data), 256):
            gain = footrule_gain(orders, q_orders[at : at + 256], len(centres))
            chosen = np.argpartition(-gain, many - 1, axis=1)[:, :many] if many < len(data) else np.tile(np.arange(len(data)), (len(gain), 1))
            for name, q, rows_ in zip(q_names[at : at + 256], q_data[at : at + 256], chosen):
                rows_ = np.sort(rows_)
                score = data[rows_] @ q
                top = np.lexsort((names_[rows_], -score))[: k + 1]
                out.append((name, names_[rows_][top], score[top]))
        return pd.DataFrame(out, columns=["query", "entries", "scores"])

    cells = rows.join(asks, "chunk").groupBy("block", "chunk").applyInPandas(best, "query bigint, entries array<bigint>, scores array<double>")
    hits = cells.select("query", F.explode(F.arrays_zip("entries", "scores")).alias("hit")).select("query", F.col("hit.entries").alias("entry"), F.col("hit.scores").alias("score"))
    order = W.partitionBy("query").orderBy(F.desc("score"), "entry")
    hits = hits.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    # Ids instead of entries; k + 1 entries hold the k best ids other than the query's own.
    found = hits.join(index.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("id"))
    order = W.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    found = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("hits"))
    answers = asked.select(F.col("id").alias("query_id"), F.col("entry").alias("query")).join(found, "query")
    others = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, k)
    out = answers.select("query_id", F.posexplode(others).alias("pos", "hit"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), F.col("hit.score").alias("score"))
