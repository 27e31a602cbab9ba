"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

* Index: vectors get one more component that makes all norms equal (so the largest inner product is the smallest
  distance), are turned by a random rotation, and join the list of their nearest centroid. Centroids are fitted on a
  bounded sample (``sample_rows``); every vector is indexed. Lists longer than ``list_rows`` are dealt into chunks by
  hash, so that a list which holds a third of all vectors is many tasks.
* Search: a query goes to its nearest list first, whose k-th best score is its threshold in the other lists it probes.
  Candidates are scanned in blocks of rotated columns: after each block one is abandoned if the hypothesis that its
  whole distance is within the threshold is rejected, i.e. if its partial distance, scaled to all columns, exceeds the
  threshold by the factor ``(1 + EPSILON / sqrt(columns))`` of the distance. Survivors get the exact inner product of
  the original vectors.
* Each chunk returns at most ``k`` rows a query, and only such as reach its threshold.

Probing 70 % of the lists (8 at least) is what unclustered vectors need for a recall above 0.95; clustered ones need
fewer. Defined results: see ``valid_vectors``; zero vectors take no part either; a query with fewer candidates gets all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.vectors import best_first, matrix, valid_vectors
from basketry.session import materialize

SAMPLE_ROWS = 16_384  # vectors the centroids are fitted on, at most
LIST_ROWS = 1024  # vectors of a list, on average; longer lists are cut into chunks of about twice this
PROBED = 0.7  # part of the lists that a query visits
LEAST_PROBED = 8
EPSILON = 2.1  # larger: fewer candidates are abandoned wrongly
TOGETHER = 256  # queries scanned together
BLOCK = 16  # columns between two tests
SEED = 11
FOUND = "query_id long, vec_id long, score double"


def rotation(d: int) -> np.ndarray:
    """A random orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))[0]


def centroids(sample: np.ndarray, n_lists: int, rounds: int = 10) -> np.ndarray:
    """K-means centres of a bounded sample; an empty cluster keeps its centre."""
    centres = sample[np.random.default_rng(SEED).permutation(len(sample))[:n_lists]]
    for _ in range(rounds):
        nearest = (sample @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
        for c in np.unique(nearest):
            centres[c] = sample[nearest == c].mean(axis=0)
    return centres


def scan(
    queries: np.ndarray, turned: np.ndarray, own: np.ndarray, floor: np.ndarray, x: np.ndarray, rotated: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query number, row number, exact score)`` of at most ``k`` rows a query that reach its ``floor``.

    ``x`` and ``rotated`` hold the same rows, ``queries`` and ``turned`` the same queries; a query's own id is skipped.
    A floor of minus infinity is raised to the k-th best score of the first rows.
    """
    first = min(len(ids), 4 * k)
    if first >= k and np.isneginf(floor).any():
        score = queries @ x[:first].T
        score[own[:, None] == ids[:first]] = -np.inf
        floor = np.maximum(floor, np.partition(score, first - k, axis=1)[:, first - k])
    # Distances stand for scores, since all norms are equal; the slack is for rounding alone.
    limit = (turned**2).sum(axis=1) + float(rotated[0] @ rotated[0]) - 2 * floor + 1e-9
    d, to = rotated.shape[1], min(BLOCK, rotated.shape[1])
    partial = (turned[:, :to] ** 2).sum(axis=1)[:, None] + (rotated[:, :to] ** 2).sum(axis=1) - 2 * turned[:, :to] @ rotated[:, :to].T
    stays = partial * (d / to) <= (limit * (1 + EPSILON / np.sqrt(to)) ** 2)[:, None] if to < d else np.isfinite(partial)
    q, row = np.nonzero(stays & (own[:, None] != ids))
    partial = partial[q, row]
    for at in range(to, d, BLOCK):
        to = min(d, at + BLOCK)
        gap = rotated[row, at:to] - turned[q, at:to]
        partial = partial + np.einsum("ij,ij->i", gap, gap)
        if to < d:
            stays = partial * (d / to) <= limit[q] * (1 + EPSILON / np.sqrt(to)) ** 2
            q, row, partial = q[stays], row[stays], partial[stays]
    score = np.einsum("ij,ij->i", x[row], queries[q])
    good = score >= floor[q]
    q, row, score = q[good], row[good], score[good]
    order = np.lexsort((ids[row], -score, q))
    q, row, score = q[order], row[order], score[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], row[best], score[best]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    sample_rows: int = SAMPLE_ROWS,
    list_rows: int = LIST_ROWS,
    probed: float = PROBED,
    least_probed: int = LEAST_PROBED,
) -> DataFrame:
    """The nearest ``k`` rows of ``vectors`` found for every row of ``queries``; both ``(vec_id, x)``."""
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.max(F.expr("aggregate(x, 0D, (s, v) -> s + v * v)")).alias("norm")).first()
    n, d, norm = facts["n"], facts["d"] or 1, facts["norm"] or 1.0
    n_lists = max(1, n // list_rows)
    # The rows with the smallest hashes: a sample that does not depend on the partitions.
    sample = matrix(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(n, sample_rows)).toPandas()["x"]).reshape(-1, d)
    n_lists = min(n_lists, max(1, len(sample) // 8))
    turn = rotation(d + 1)
    centres = centroids(sample, n_lists) if len(sample) else np.zeros((1, d))
    half = 0.5 * (centres**2).sum(axis=1)
    probes = min(n_lists, max(least_probed, int(np.ceil(probed * n_lists))))

    def index(batches):
        for batch in batches:
            x = matrix(batch["x"]).reshape(-1, d)
            rest = np.sqrt(np.maximum(0.0, norm - np.einsum("ij,ij->i", x, x)))
            yield batch.assign(list=(x @ centres.T - half).argmax(axis=1), rotated=list(np.column_stack([x, rest]) @ turn))

    def visit(batches):
        for batch in batches:
            x = matrix(batch["x"]).reshape(-1, d)
            near = np.argsort(-(x @ centres.T - half), axis=1)[:, :probes]
            yield batch.assign(lists=list(near), rotated=list(np.column_stack([x, np.zeros(len(x))]) @ turn))

    indexed = materialize(vectors.select("vec_id", "x").mapInPandas(index, "vec_id long, x array<double>, list int, rotated array<double>"), "ann-index")
    lengths = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}
    chunks = np.array([max(1, -(-lengths.get(c, 0) // (2 * list_rows))) for c in range(n_lists)]).tolist()
    chunks_of = F.element_at(F.array(*map(F.lit, chunks)), F.col("list") + 1)

    asked = materialize(queries.select("vec_id", "x").mapInPandas(visit, "vec_id long, x array<double>, lists array<int>, rotated array<double>"), "ann-queries")
    given = indexed.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), chunks_of).cast("int"))

    def run(questions: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(questions) and len(rows):
            ids, x, rotated = rows["vec_id"].to_numpy(), matrix(rows["x"]), matrix(rows["rotated"])
            for at in range(0, len(questions), TOGETHER):
                part = questions.iloc[at : at + TOGETHER]
                own = part["vec_id"].to_numpy()
                q, row, score = scan(matrix(part["x"]), matrix(part["rotated"]), own, part["floor"].to_numpy(), x, rotated, ids, k)
                found.append(pd.DataFrame({"query_id": own[q], "vec_id": ids[row], "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    def visited(visits: DataFrame) -> DataFrame:
        visits = visits.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks_of - 1))).select("list", "chunk", "vec_id", "x", "rotated", "floor")
        return best_first(visits.groupBy("list", "chunk").cogroup(given.groupBy("list", "chunk")).applyInPandas(run, FOUND), k)

    # The nearest list gives every query a floor, below which the other lists return nothing.
    near = materialize(visited(asked.withColumn("list", F.element_at("lists", 1)).withColumn("floor", F.lit(float("-inf")))), "ann-near")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    rest = asked.withColumn("list", F.explode(F.slice("lists", 2, max(1, probes - 1)))).join(floors, "vec_id", "left")
    far = visited(rest.withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))))
    return best_first(near.drop("rank").unionByName(far.drop("rank")), k)


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    vectors = materialize(vectors.where(F.exists("x", lambda v: v != 0)), "ann-vectors")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)
