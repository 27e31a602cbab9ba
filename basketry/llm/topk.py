"""Exact top-k search by no-random-access aggregation (NRA) over sorted component lists.

A score is the sum of one contribution per component, ``q_j * x_j``. In every shard of the candidates each component
has a list sorted by value, read from its best end (its largest values for a positive ``q_j``, its smallest for a negative
one). All lists are read in step. What has been read of a candidate, plus for the rest the last value read (or the
worst value of the list), gives an upper (or lower) bound of its score; reading stops for a query when no other
candidate's upper bound reaches the k-th largest lower bound, and the few that remain get their final scores. Bounds
are integers held in doubles, hence exact as long as scores stay below 2**53.

Shards have about ``shard_rows`` candidates, and each block of queries meets each shard once: work is (queries x
candidates), as asked, and no task holds more than one shard and one block. Results per shard are ``k`` rows a query.

Defined results: see ``valid_vectors`` for vectors that take no part; a query with fewer candidates gets all of them; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.vectors import best_first, matrix, valid_vectors

SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
# Part of every list read before bounds are compared again.
DEPTHS = (0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875)
FEW = 32  # candidates whose final scores are resolved at once
FOUND = "query_id long, vec_id long, score long"


def nra(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query number, row number, score)`` of every query's k best rows, its own id excluded."""
    n, d = rows.shape
    order = np.argsort(rows, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], (n, d)), axis=0)
    values = np.take_along_axis(rows, order, axis=0)
    low, high = values[0], values[-1]
    weights = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
    own = query_ids[:, None] == ids[None, :]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    open_queries = np.arange(len(queries))

    def resolve(q: np.ndarray, may: np.ndarray) -> None:
        """Final scores of the rows that may qualify, and the best ``k`` of them."""
        for query, row in zip(q.tolist(), may, strict=True):
            rest = np.flatnonzero(row)
            score = rows[rest] @ queries[query]
            best = np.lexsort((ids[rest], -score))[:k]
            out.append((np.full(len(best), query), rest[best], score[best].astype(np.int64)))

    for depth in [max(1, int(n * f)) for f in DEPTHS] if n > FEW else []:
        down, up = place >= n - depth, place < depth
        last_down, last_up = values[n - depth], values[depth - 1]
        upper = weights[open_queries] @ np.hstack([np.where(down, rows, last_down), np.where(up, rows, last_up)]).T
        lower = weights[open_queries] @ np.hstack([np.where(down, rows, low), np.where(up, rows, high)]).T
        mine = own[open_queries]
        upper[mine] = lower[mine] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n >= k else np.full(len(lower), -np.inf)
        may = (upper >= kth[:, None]) & ~mine
        settled = may.sum(axis=1) <= max(FEW, 2 * k)
        resolve(open_queries[settled], may[settled])
        open_queries = open_queries[~settled]
        if not len(open_queries):
            break
    resolve(open_queries, ~own[open_queries])  # these lists are read to their ends
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def search(vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for every row of ``queries``; both ``(vec_id, x)``,
    ``x`` of whole numbers."""
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_queries))

    def dealt(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select(every(shards).alias("shard"), dealt(blocks).alias("block"), "vec_id", "x")
    right = vectors.select(dealt(shards).alias("shard"), every(blocks).alias("block"), "vec_id", "x")

    def run(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or given.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        query_ids, ids = asked["vec_id"].to_numpy(), given["vec_id"].to_numpy()
        q, row, score = nra(matrix(asked["x"]), query_ids, matrix(given["x"]), ids, k)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[row], "score": score})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(run, FOUND)
    return best_first(found, k)


def op2_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    vectors = vectors.withColumn("x", F.transform("x", lambda v: F.floor(v * 256.0).cast("double")))
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP2_SQL = """
WITH clean AS (
  SELECT vec_id, min(list_transform(embedding, lambda v: floor(256 * v::DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM clean q JOIN clean c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
