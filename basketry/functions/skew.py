"""Joins whose big side has keys that hold a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from this many rows on, or from a share of one in MOST_KEYS of all rows if that is more. So there are never more than
# MOST_KEYS heavy keys, which bounds what is broadcast.
HEAVY_ROWS = 100_000
MOST_KEYS = 20_000


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """``(key, _parts)`` of the heavy keys: into how many parts of about the limit their rows are split."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    limit = F.greatest(F.lit(HEAVY_ROWS), F.ceil(F.coalesce(counts.agg(F.sum("_n").alias("t")).scalar(), F.lit(0)) / MOST_KEYS))
    return counts.withColumn("_limit", limit).where("_n > _limit").select(key, F.ceil(F.col("_n") / F.col("_limit")).cast("int").alias("_parts"))


def split_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``big.join(small, key, how)`` for inner and left joins. Rows of a heavy key go to several tasks by their own hash, each of which gets
    a copy of the key's rows of ``small``; all other rows are joined as ever."""
    heavy = F.broadcast(heavy_keys(big, key))
    own = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = big.join(heavy, key, "left").withColumn("_part", own).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    copies = small.join(heavy, key, "left").withColumn("_part", every).drop("_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")
