"""Integrity checks. Each returns a DataFrame of counts or of the offending rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaError(ValueError):
    """A table lacks the columns an operator needs."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def require_features(features: Sequence[str]) -> Sequence[str]:
    if not features:
        raise SchemaError("no feature column left after removing ids and label")
    return features


def orphan_counts(lines: DataFrame, parent: DataFrame, key: str, split: str = "eval_set", out: str = "n_orphans") -> DataFrame:
    """Line items per split and how many of them have no parent row."""
    keys = parent.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        lines.select(split, key)
        .join(keys, key, "left")
        .groupBy(split)
        .agg(F.count("*").alias("n_rows"), F.count_if(F.col("_known").isNull()).alias(out))
    )


def first_order_gap_violations(orders: DataFrame) -> DataFrame:
    """Orders that break the rule "the gap is null exactly for a first order"."""
    first, has_gap = F.col("order_number") == 1, F.col("days_since_prior_order").isNotNull()
    return orders.agg(
        F.count("*").alias("n_orders"),
        F.count_if(first).alias("n_first_orders"),
        F.count_if(first & has_gap).alias("n_first_with_gap"),
        F.count_if(~first & ~has_gap).alias("n_later_without_gap"),
    )


def with_bigint_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("bigint") for k in keys if k in df.columns})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def users_with_many_orders(df: DataFrame) -> DataFrame:
    """Users that own more than one order among the candidates."""
    pairs = df.select("user_id", "order_id").distinct()
    return pairs.groupBy("user_id").agg(F.count("order_id").alias("n_orders")).where("n_orders > 1")


def label_domain(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label).isNull() | ~F.col(label).isin(0, 1)).alias("n_bad_labels"),
    )


def id_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct ids two tables have, and how many they share."""
    a = left.select(key).where(F.col(key).isNotNull()).distinct().withColumns({"_l": F.lit(1), "_r": F.lit(0)})
    b = right.select(key).where(F.col(key).isNotNull()).distinct().withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    sides = a.unionByName(b).groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    counts = [F.sum("_l"), F.sum("_r"), F.sum(F.col("_l") * F.col("_r"))]
    names = ["n_left", "n_right", "n_shared"]
    return sides.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for c, n in zip(counts, names)])


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing values per column of each table, one row per (table, column)."""

    def one(name: str, df: DataFrame) -> DataFrame:
        wide = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"c_{c}") for c in df.columns])
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c_{c}").alias("n_missing")) for c in df.columns])
        return wide.select(F.lit(name).alias("table_name"), "n_rows", F.inline(cells))

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
        )

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def pairs_with_factors(pairs: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Kept and total pairs when both ids must be known to the factor model."""
    known_users = users.select("user_id").distinct().withColumn("_u", F.lit(1))
    known_products = products.select("product_id").distinct().withColumn("_p", F.lit(1))
    joined = pairs.join(known_users, "user_id", "left").join(known_products, "product_id", "left")
    return joined.agg(
        F.count("*").alias("n_total"),
        F.count_if(F.col("_u").isNotNull() & F.col("_p").isNotNull()).alias("n_kept"),
    )


def numeric_features(df: DataFrame, ids: Sequence[str] = ("user_id", "order_id", "product_id"), label: str = "label") -> list[str]:
    """Numeric columns that are neither ids nor label, in schema order."""
    return [f.name for f in df.schema if f.name not in ids and f.name != label and isinstance(f.dataType, T.NumericType)]
