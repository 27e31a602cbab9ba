"""Profiles and distributions of the order history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.positions import quantiles
from basketry.functions.scalars import DAY_SHORT, GAP_BINS, day_name, log1p_floor0, right_closed_bin
from basketry.operators.preprocess import unpivot


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Absolute and relative frequency of a categorical column."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n").alias("t")).scalar())


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per column."""
    cells = unpivot(df, columns)
    sums = cells.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return sums.join(quantiles(cells, "value", {"q25": 0.25, "median": 0.5, "q75": 0.75}, ["column_name"]), "column_name", "left")


def cardinalities(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct users and products in the lines, aisles and departments in the catalog."""

    def one(df: DataFrame, column: str) -> DataFrame:
        return df.select(column).distinct().agg(F.count(column).alias("n_distinct")).select(F.lit(column).alias("column_name"), "n_distinct")

    parts = [one(lines, "user_id"), one(lines, "product_id"), one(products, "aisle_id"), one(products, "department_id")]
    return reduce(DataFrame.unionByName, parts)


def orders_by(orders: DataFrame, column: str) -> DataFrame:
    """Orders per day of week or hour with their percentage."""
    counts = orders.groupBy(column).agg(F.count("*").alias("n_orders"))
    return counts.withColumn("pct", 100.0 * F.col("n_orders") / F.sum("n_orders").over(Window.partitionBy()))


def orders_by_day(orders: DataFrame) -> DataFrame:
    return orders_by(orders, "order_dow").withColumn("day_name", day_name(F.col("order_dow")))


def equal_width_histogram(df: DataFrame, value: str, n_bins: int) -> DataFrame:
    """Counts in equal bins between min and max; the last bin is closed. Empty bins are listed."""
    spark = df.sparkSession
    values = df.select(F.col(value).cast("double").alias("v")).where("v is not null")
    edges = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e")).scalar()
    lo, hi = edges.getField("lo"), edges.getField("hi")
    index = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("v") - lo) * n_bins / (hi - lo)), F.lit(n_bins - 1)))
    counts = values.select(index.cast("bigint").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    width = (hi - lo) / n_bins
    return (
        spark.range(n_bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * width).alias("bin_low"),
            (lo + (F.col("bin") + 1) * width).alias("bin_high"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
    )


def orders_per_user_histogram(orders: DataFrame, width: int = 5, top: int = 100) -> DataFrame:
    """Users per bin of ``width`` orders on [0, top], last bin closed, users above dropped.

    The cumulative percentage is taken over all users, so it stays below 100 if users were dropped.
    """
    n_bins = top // width
    users = orders.groupBy("user_id").agg(F.max("order_number").alias("total_orders"))
    # Users above the top fall into one more bin, which counts for the percentage only.
    index = F.when(F.col("total_orders") > top, F.lit(n_bins)).otherwise(F.least(F.floor(F.col("total_orders") / width), F.lit(n_bins - 1)))
    bins = users.groupBy(index.cast("bigint").alias("bin")).agg(F.count("*").alias("n_users"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        orders.sparkSession.range(n_bins + 1)
        .withColumnRenamed("id", "bin")
        .join(bins, "bin", "left")
        .select("bin", (F.col("bin") * width).alias("bin_low"), ((F.col("bin") + 1) * width).alias("bin_high"), F.coalesce("n_users", F.lit(0)).alias("n_users"))
        .withColumn("cum_pct", 100.0 * F.sum("n_users").over(upto) / F.sum("n_users").over(Window.partitionBy()))
        .where(F.col("bin") < n_bins)
    )


def top_groups(lines: DataFrame, dimension: DataFrame, key: str, names: Sequence[str], n: int = 15) -> DataFrame:
    """The ``n`` names with most line items and their share within these ``n``.

    ``dimension`` leads from ``key`` to the names. Lines are counted per key before the join, so the
    join sees one row per key however often a key is bought.
    """
    per_key = lines.groupBy(key).agg(F.count("*").alias("n_key"))
    per_name = per_key.join(dimension, key, "left").groupBy(*names).agg(F.sum("n_key").alias("n_lines"))
    top = per_name.orderBy(F.col("n_lines").desc(), *[F.col(c) for c in names]).limit(n)
    return top.withColumn("pct_of_top", 100.0 * F.col("n_lines") / F.sum("n_lines").over(Window.partitionBy()))


def reorder_rate_by(lines: DataFrame, key: str | Column, name: str) -> DataFrame:
    column = F.col(key) if isinstance(key, str) else key
    return lines.groupBy(column.alias(name)).agg(F.count("*").alias("n_lines"), F.avg("reordered").alias("reorder_rate"))


def reorder_rate_by_day(lines: DataFrame) -> DataFrame:
    return reorder_rate_by(lines, "order_dow", "order_dow").withColumn("day_name", day_name(F.col("order_dow"), DAY_SHORT))


def reorder_rate_by_gap(lines: DataFrame) -> DataFrame:
    """Rate per right-closed gap bin; empty bins stay with a null rate and gap 0 falls in none."""
    spark = lines.sparkSession
    rates = reorder_rate_by(lines, right_closed_bin(F.col("days_since_prior_order")), "gap_bin").where("gap_bin is not null")
    bins = spark.createDataFrame([(i, name) for i, (_, _, name) in enumerate(GAP_BINS)], "bin_no bigint, gap_bin string")
    return bins.join(rates, "gap_bin", "left").select("bin_no", "gap_bin", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "reorder_rate")


def product_popularity(lines: DataFrame, products: DataFrame, min_purchases: int = 200) -> DataFrame:
    """Purchases and reorder rate of the products bought at least ``min_purchases`` times."""
    stats = lines.groupBy("product_id").agg(F.count("*").alias("n_purchases"), F.avg("reordered").alias("reorder_rate"))
    names = products.select("product_id", "product_name")
    return stats.where(F.col("n_purchases") >= min_purchases).join(names, "product_id", "left")


def log_frequency_histogram(lines: DataFrame, n_bins: int = 50) -> DataFrame:
    counts = lines.groupBy("product_id").agg(F.count("*").alias("n"))
    return equal_width_histogram(counts.select(log1p_floor0(F.col("n")).alias("log_n")), "log_n", n_bins)


def purchase_history(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Per (user, product): purchases, reorders and product name."""
    stats = lines.groupBy("user_id", "product_id").agg(F.count("*").alias("purchase_count"), F.sum("reordered").alias("reordered"))
    return stats.join(products.select("product_id", "product_name"), "product_id", "left")


def basket_summary(baskets: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Rows and distinct orders, users, products and (user, product) pairs.

    Each count goes over the distinct values of its own columns, so no row is copied once per count. With
    ``relative_error`` the counts are approximate and take one pass without a shuffle of values.
    """
    if relative_error is not None:

        def about(*columns: str) -> Column:
            every = F.lit(True)
            for c in columns:
                every = every & F.col(c).isNotNull()
            return F.approx_count_distinct(F.when(every, F.struct(*columns)), relative_error)

        return baskets.agg(
            F.count("*").alias("n_rows"),
            about("order_id").alias("n_orders"),
            about("user_id").alias("n_users"),
            about("product_id").alias("n_products"),
            about("user_id", "product_id").alias("n_pairs"),
        )
    pairs = baskets.groupBy("user_id", "product_id").agg(F.count("*").alias("n"))
    users = pairs.where("user_id IS NOT NULL").groupBy("user_id").agg(F.count_if(F.col("product_id").isNotNull()).alias("n"))
    rows = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    sums = users.agg(F.count("*").alias("n_users"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
    orders = baskets.where("order_id IS NOT NULL").select("order_id").distinct().agg(F.count("*").alias("n_orders"))
    products = pairs.where("product_id IS NOT NULL").select("product_id").distinct().agg(F.count("*").alias("n_products"))
    one = rows.withColumns({"n_orders": orders.scalar(), "n_products": products.scalar()})
    return one.withColumn("s", sums.select(F.struct("n_users", "n_pairs")).scalar()).select("n_rows", "n_orders", "s.n_users", "n_products", "s.n_pairs")


def subset_statistics(rows: DataFrame, users: DataFrame) -> DataFrame:
    """What is left of a table when only the given users are kept: users found and missing, rows, reduction."""
    wanted = users.select("user_id").distinct()
    per_user = rows.groupBy("user_id").agg(F.count("*").alias("n"))
    both = per_user.join(wanted.withColumn("_w", F.lit(1)), "user_id", "full")
    found = F.col("_w").isNotNull() & F.col("n").isNotNull()
    totals = both.agg(
        F.count("_w").alias("n_wanted"),
        F.count_if(found).alias("n_found"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(found, F.col("n"))), F.lit(0)).alias("n_kept"),
    )
    return totals.select(
        "n_wanted",
        "n_found",
        (F.col("n_wanted") - F.col("n_found")).alias("n_missing"),
        "n_rows",
        "n_kept",
        (100.0 * (1 - F.try_divide("n_kept", "n_rows"))).alias("reduction_pct"),
        F.try_divide("n_kept", "n_found").alias("rows_per_user"),
    )


def subset(rows: DataFrame, users: DataFrame) -> DataFrame:
    return rows.join(users.select("user_id").distinct(), "user_id", "left_semi")
