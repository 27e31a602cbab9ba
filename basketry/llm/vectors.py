"""Vectors as the search operators read them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_DIMENSIONS = 65_536


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` with ``x`` an array of doubles.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a null id. Of rows
    that share an id, the smallest vector counts. All vectors must have the most frequent length (the larger of equally
    frequent ones); others take no part.
    """
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(F.col("x"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.size("x").between(1, MAX_DIMENSIONS) & finite)
    rows = rows.groupBy("vec_id").agg(F.min("x").alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (sizes[0]["d"] if sizes else 1))


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.float64)


def best_first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query of ``(query_id, vec_id, score)``, ties to the smaller ``vec_id``, with their rank.

    Spark trims each query to ``k`` rows before the shuffle, so a query brings ``k`` rows from each task at most.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
