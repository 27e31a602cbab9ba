"""User, product and user x product features of the prior orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.positions import quantiles, rounded
from basketry.operators.quality import require_columns

# Column order of the candidate table.
USER_FEATURES = [
    "u_total_orders",
    "u_total_items",
    "u_distinct_products",
    "u_avg_basket_size",
    "u_reorder_ratio",
    "u_mean_days_between",
    "u_std_days_between",
]
PRODUCT_FEATURES = ["p_total_purchases", "p_distinct_users", "p_avg_add_to_cart", "p_reorder_prob"]
PAIR_FEATURES = [
    "up_times_bought",
    "up_last_order_number",
    "up_first_order_number",
    "up_avg_add_to_cart",
    "u_last_prior_order",
    "up_recency",
    "user_total_bought",
    "up_rate_in_user_history",
]
# End of the fixed values.

HISTORY_SLICE = 10_000


def attach_order(lines: DataFrame, orders: DataFrame, how: str = "left") -> DataFrame:
    """Line items with the attributes of their order."""
    return lines.join(orders, "order_id", how)


def split(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("eval_set") == name)


def pair_totals(lines: DataFrame) -> DataFrame:
    """Counts and sums per (user, product).

    The user, product and pair features, the history and the interactions all follow from this table,
    so the lines are shuffled for it once. Columns the lines lack are left out.
    """
    sums = [F.count("product_id").alias("n"), F.max("order_number").alias("last"), F.min("order_number").alias("first")]
    for column, total, count in (("add_to_cart_order", "cart", "n_cart"), ("reordered", "re", "n_re")):
        if column in lines.columns:
            sums += [F.sum(column).alias(total), F.count(column).alias(count)]
    return lines.groupBy("user_id", "product_id").agg(*sums)


def user_features(lines: DataFrame, order_grain: bool = False, totals: DataFrame | None = None) -> DataFrame:
    """Seven features per user from line items that carry their order's columns.

    Gaps are averaged over line items, so a large basket weighs more; ``order_grain`` weighs every
    order once. Distinct products and orders are counted on the two grouped tables instead of by
    ``count distinct``, which would copy each line once per distinct column.
    """
    require_columns(lines, ["user_id", "order_id", "product_id", "order_number", "reordered", "days_since_prior_order"], "lines")
    totals = pair_totals(lines) if totals is None else totals
    per_order = lines.groupBy("user_id", "order_id", "order_number", "days_since_prior_order").agg(F.count("*").alias("n_items"))
    gap = F.col("days_since_prior_order").cast("double")
    weight = F.when(gap.isNotNull(), F.lit(1) if order_grain else F.col("n_items"))
    # Gaps are small whole days, so the sums below are exact and the variance loses no digits.
    by_order = per_order.groupBy("user_id").agg(
        F.max("order_number").alias("u_total_orders"),
        F.count("order_id").alias("n_orders"),
        F.sum(weight).alias("w"),
        F.sum(weight * gap).alias("wx"),
        F.sum(weight * gap * gap).alias("wxx"),
    )
    by_product = totals.groupBy("user_id").agg(
        F.sum("n").alias("u_total_items"),
        F.count("product_id").alias("u_distinct_products"),
        F.sum("re").alias("re"),
        F.sum("n_re").alias("n_re"),
    )
    variance = (F.col("wxx") - F.col("wx") * F.col("wx") / F.col("w")) / (F.col("w") - 1)
    return by_order.join(by_product, "user_id").select(
        "user_id",
        "u_total_orders",
        "u_total_items",
        "u_distinct_products",
        (F.col("u_total_items") / F.col("n_orders")).alias("u_avg_basket_size"),
        F.coalesce(F.try_divide("re", "n_re"), F.lit(0.0)).alias("u_reorder_ratio"),
        F.try_divide("wx", "w").alias("u_mean_days_between"),
        F.when(F.col("w") > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("u_std_days_between"),
    )


def product_features(lines: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Four features per product, from the totals per (user, product), which split the hot products."""
    totals = pair_totals(lines) if totals is None else totals
    return totals.groupBy("product_id").agg(
        F.sum("n").alias("p_total_purchases"),
        F.count("user_id").alias("p_distinct_users"),
        F.try_divide(F.sum("cart"), F.sum("n_cart")).alias("p_avg_add_to_cart"),
        F.try_divide(F.sum("re"), F.sum("n_re")).alias("p_reorder_prob"),
    )


def pair_features(lines: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Eight features per (user, product) with recency and share of the user's history.

    Lines without cart positions give the seven others.
    """
    totals = pair_totals(lines) if totals is None else totals
    users = totals.groupBy("user_id").agg(F.max("last").alias("u_last_prior_order"), F.sum("n").alias("user_total_bought"))
    cart = [F.try_divide("cart", "n_cart").alias("up_avg_add_to_cart")] if "cart" in totals.columns else []
    return totals.join(users, "user_id").select(
        "user_id",
        "product_id",
        F.col("n").alias("up_times_bought"),
        F.col("last").alias("up_last_order_number"),
        F.col("first").alias("up_first_order_number"),
        *cart,
        "u_last_prior_order",
        (F.col("u_last_prior_order") - F.col("last")).alias("up_recency"),
        "user_total_bought",
        (F.col("n") / F.col("user_total_bought")).alias("up_rate_in_user_history"),
    )


def history_pairs(lines: DataFrame) -> DataFrame:
    """Distinct (user, product) of the history: the long form of the product list."""
    return lines.select("user_id", "product_id").where(F.col("product_id").isNotNull()).distinct()


def history_lists(lines: DataFrame) -> DataFrame:
    """A user's distinct products as sorted lists.

    One list per run of ``HISTORY_SLICE`` product ids, which bounds its length; catalogs below that
    size give one list per user.
    """
    part = F.floor(F.col("product_id") / HISTORY_SLICE).cast("bigint").alias("list_no")
    return history_pairs(lines).groupBy("user_id", part).agg(F.sort_array(F.collect_list("product_id")).alias("products"))


def interactions(lines: DataFrame) -> DataFrame:
    """Implicit feedback: purchases per (user, product)."""
    return lines.groupBy("user_id", "product_id").agg(F.count("*").alias("count"))


def collapse_duplicates(df: DataFrame) -> DataFrame:
    """One row per (user, product): mean score, best and mean similarity, summed edge count."""
    return df.groupBy("user_id", "product_id").agg(
        F.avg("als_score").alias("als_score"),
        F.max("sim_max").alias("sim_max"),
        F.avg("sim_mean").alias("sim_mean"),
        F.avg("sim_topk_mean_10").alias("sim_topk_mean_10"),
        F.sum("sim_nonzero_cnt").alias("sim_nonzero_cnt"),
    )


def part_of_day() -> dict[str, Column]:
    """Morning (before noon) and evening (from 6 pm) flags of the order hour."""
    hour = F.col("order_hour_of_day")
    return {"is_morning": (hour < 12).cast("int"), "is_evening": (hour >= 18).cast("int")}


def purchase_rank(pairs: DataFrame, out: str = "purchase_rank") -> DataFrame:
    """Dense rank of each product among its user's products, most bought first.

    Ranks run over the distinct counts of a user, so a long history is not sorted in one task.
    """
    levels = pairs.select("user_id", "up_times_bought").distinct()
    ranked = levels.withColumn(out, F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("up_times_bought").desc())))
    return pairs.join(ranked, ["user_id", "up_times_bought"])


def minus_group_median(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """The value minus the exact median of its group."""
    rounded_rows = df.withColumn("_rounded", rounded(value))
    middle = quantiles(rounded_rows, "_rounded", {"_median": 0.5}, [group], slice_by=F.floor(F.col("_v") * 16))
    return rounded_rows.join(middle, group).withColumn(out, F.col(value) - F.col("_median")).drop("_rounded", "_median")
