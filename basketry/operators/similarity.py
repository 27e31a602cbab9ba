"""Product similarity from co-purchases, and its aggregates per (user, product).

Co-purchase counts. The pairs of an order grow with the square of its size, so orders are split by it:

* up to ``pair_limit`` products: pairs are expanded inside the JVM, at most ``pair_limit`` per line;
* larger orders: products are cut into blocks of ``BLOCK`` ids; each (block, block, run of orders)
  cell adds its orders into one small count matrix and emits one row per pair that occurs, so a pair
  leaves a cell once however many orders hold it, and no task sees a whole order's pairs.

Both parts are exact and add up. The counted pairs themselves are the result of the operator.

The most similar products need no table of pairs: where all orders are small, each product of an order gets the whole order as a list,
so that a list travels in place of its pairs, and the task that has the product counts, ranks and cuts its neighbors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.skew import split_join
from basketry.operators.metrics import top_k_per_group

PAIR_LIMIT = 64
BLOCK = 512
ORDERS_PER_RUN = 4096
BLOCK_SALTS = 16
# The lists of products in more orders than this are expanded before they are dealt, by pair.
HOT_ORDERS = 100_000
# Words of 64 bits in which a user's candidates are marked.
MARK_WORDS = 4


def product_support(baskets: DataFrame) -> DataFrame:
    """Number of orders that contain each product; ``baskets`` has one row per (order, product)."""
    return baskets.groupBy("product_id").agg(F.count("*").alias("n_orders"))


def _small_order_pairs(baskets: DataFrame) -> DataFrame:
    items = baskets.groupBy("order_id").agg(F.sort_array(F.collect_list("product_id")).alias("items"))
    first = items.select("items", F.posexplode("items").alias("at", "product_a"))
    rest = F.slice("items", F.col("at") + 2, F.size("items"))
    return first.select("product_a", F.explode(rest).alias("product_b")).groupBy("product_a", "product_b").agg(F.count("*").alias("n"))


def _cell_counts(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    row_block, column_block = int(key[0]), int(key[1])
    counts = np.zeros((BLOCK, BLOCK), dtype=np.int64)
    for batch in batches:
        for rows, columns in zip(batch["rows"], batch["columns"]):
            counts[np.ix_(np.asarray(rows), np.asarray(columns))] += 1
    if row_block == column_block:
        counts = np.triu(counts, 1)
    a, b = np.nonzero(counts)
    yield pd.DataFrame({"product_a": a + row_block * BLOCK, "product_b": b + column_block * BLOCK, "n": counts[a, b]})


def _large_order_pairs(baskets: DataFrame, n_large: Column) -> DataFrame:
    runs = F.greatest(F.lit(1), F.ceil(n_large / ORDERS_PER_RUN))
    block = F.floor(F.col("product_id") / BLOCK).cast("bigint")
    packed = (
        baskets.select("order_id", block.alias("block"), (F.col("product_id") % BLOCK).cast("int").alias("place"))
        .groupBy("order_id", "block")
        .agg(F.collect_list("place").alias("places"))
    )
    rows = packed.select("order_id", (F.col("block") % BLOCK_SALTS).alias("salt"), F.col("block").alias("row_block"), F.col("places").alias("rows"))
    salts = F.explode(F.array(*[F.lit(s).cast("bigint") for s in range(BLOCK_SALTS)]))
    columns = packed.select("order_id", salts.alias("salt"), F.col("block").alias("column_block"), F.col("places").alias("columns"))
    cells = rows.join(columns, ["order_id", "salt"]).where("row_block <= column_block")
    cells = cells.withColumn("run", F.pmod(F.xxhash64("order_id"), runs))
    counted = cells.select("row_block", "column_block", "run", "rows", "columns").groupBy("row_block", "column_block", "run")
    return counted.applyInPandas(_cell_counts, "product_a bigint, product_b bigint, n bigint")


def co_purchases(baskets: DataFrame, min_support: int = 1, pair_limit: int = PAIR_LIMIT, largest: int | None = None) -> DataFrame:
    """Orders that contain both products, one row per unordered pair ``product_a < product_b``.

    ``largest`` is an upper bound of the order size, if one is known.
    """
    baskets = baskets.select("order_id", "product_id")
    if largest is not None and largest <= pair_limit:
        return _small_order_pairs(baskets).withColumnRenamed("n", "n_both").where(F.col("n_both") >= min_support)
    large = baskets.groupBy("order_id").agg(F.count("*").alias("n")).where(F.col("n") > pair_limit).select("order_id")
    small_pairs = _small_order_pairs(baskets.join(large, "order_id", "left_anti"))
    large_pairs = _large_order_pairs(baskets.join(large, "order_id", "left_semi"), large.agg(F.count("*")).scalar())
    pairs = small_pairs.unionByName(large_pairs).groupBy("product_a", "product_b").agg(F.sum("n").alias("n_both"))
    return pairs.where(F.col("n_both") >= min_support)


def both_directions(pairs: DataFrame) -> DataFrame:
    a, b = F.col("product_a"), F.col("product_b")
    ways = F.array(
        F.struct(a.alias("product_id"), b.alias("neighbor_product_id")), F.struct(b.alias("product_id"), a.alias("neighbor_product_id"))
    )
    return pairs.select("n_both", F.inline(ways)).select("product_id", "neighbor_product_id", "n_both")


def cosine_scores(pairs: DataFrame, support: DataFrame) -> DataFrame:
    """Cosine of every co-purchased pair, in both directions."""
    own = support.select("product_id", F.col("n_orders").alias("n_own"))
    other = support.select(F.col("product_id").alias("neighbor_product_id"), F.col("n_orders").alias("n_other"))
    joined = both_directions(pairs).join(other, "neighbor_product_id").join(own, "product_id")
    return joined.select("product_id", "neighbor_product_id", (F.col("n_both") / F.sqrt(F.col("n_own") * F.col("n_other"))).alias("score"))


def _top_of_lists(baskets: DataFrame, support: DataFrame, k: int) -> DataFrame:
    """``(product_id, neighbor_product_id, n_both, n_own, n_other, rank)`` from baskets of at most ``PAIR_LIMIT`` products."""
    known = baskets.select("order_id", "product_id").join(support.select("product_id", "n_orders"), "product_id")
    items = known.groupBy("order_id").agg(F.sort_array(F.collect_list(F.struct("product_id", "n_orders"))).alias("items")).where(F.size("items") > 1)
    lists = items.select(F.col("items.product_id").alias("ids"), F.col("items.n_orders").alias("sizes"), F.posexplode("items").alias("at", "own"))
    lists = lists.select("own.product_id", F.col("own.n_orders").alias("n_own"), "at", "ids", "sizes")

    def best(rows: DataFrame) -> DataFrame:
        ways = rows.select("product_id", "n_own", "at", "sizes", F.posexplode("ids").alias("to", "neighbor_product_id")).where("to <> at")
        # A basket that repeats a product has both ways of that pair, as the pairs themselves have.
        way = ((F.col("product_id") == F.col("neighbor_product_id")) & (F.col("to") > F.col("at"))).alias("way")
        other = F.get("sizes", F.col("to")).alias("n_other")
        counted = ways.select("product_id", "neighbor_product_id", way, "n_own", other).groupBy("product_id", "neighbor_product_id", "way")
        strengths = counted.agg(F.count("*").alias("n_both"), F.max("n_own").alias("n_own"), F.max("n_other").alias("n_other"))
        return top_k_per_group(strengths.withColumn("strength", _strength()), ["product_id"], _by_strength(), k)

    top = best(lists.where(F.col("n_own") <= HOT_ORDERS).repartition("product_id"))
    if not support.where(F.col("n_orders") > HOT_ORDERS).isEmpty():
        top = top.unionByName(best(lists.where(F.col("n_own") > HOT_ORDERS)))
    return top


def _strength() -> Column:
    return F.col("n_both").cast("double") * F.col("n_both") / F.col("n_other")


def _by_strength() -> list[Column]:
    return [F.col("strength").desc(), F.col("neighbor_product_id")]


def top_neighbors(
    baskets: DataFrame, k: int = 10, decimals: int | None = None, support: DataFrame | None = None, **pair_options: int | None
) -> DataFrame:
    """The ``k`` most similar products per product: score down, then neighbor id up.

    ``support`` may be given as a written table: Spark then knows its size and can tell whether a
    broadcast spares the shuffle of the pairs.

    Within one product ``n_both**2 / n_orders(neighbor)`` sorts exactly like the cosine and gives equal
    pairs equal keys. Ranking on it comes before the join with the product's own support, so
    each product's list is cut to ``k`` ahead of that shuffle.
    """
    support = product_support(baskets) if support is None else support
    largest, limit = pair_options.get("largest"), pair_options.get("pair_limit", PAIR_LIMIT)
    if largest is not None and largest <= limit and not pair_options.get("min_support", 1) > 1:
        top = _top_of_lists(baskets, support, k)
    else:
        other = support.select(F.col("product_id").alias("neighbor_product_id"), F.col("n_orders").alias("n_other"))
        ways = both_directions(co_purchases(baskets, **pair_options)).join(other, "neighbor_product_id").withColumn("strength", _strength())
        own = support.select("product_id", F.col("n_orders").alias("n_own"))
        top = top_k_per_group(ways, ["product_id"], _by_strength(), k).join(own, "product_id")
    score = F.col("n_both") / F.sqrt(F.col("n_own") * F.col("n_other"))
    return top.select(
        "product_id", "neighbor_product_id", (score if decimals is None else F.round(score, decimals)).alias("score"), "rank"
    )


def _word_and_bit(product: str) -> tuple[Column, Column]:
    """Where a product is marked."""
    hashed = f"xxhash64(cast({product} AS bigint))"
    return F.expr(f"cast(pmod(shiftright({hashed}, 6), {MARK_WORDS}) AS int)"), F.expr(f"shiftleft(1L, cast(pmod({hashed}, 64) AS int))")


def candidate_marks(pairs: DataFrame) -> DataFrame:
    """``(user_id, marks)``: bits of the user's candidate products. Most products that are no candidates of the user have none."""
    word, bit = _word_and_bit("product_id")
    words = [F.coalesce(F.bit_or(F.when(word == w, bit)), F.lit(0).cast("bigint")) for w in range(MARK_WORDS)]
    return pairs.groupBy("user_id").agg(F.array(*words).alias("marks"))


def pair_similarity(pairs: DataFrame, history: DataFrame, edges: DataFrame, top: int = 10) -> DataFrame:
    """Similarity aggregates of each candidate pair to its user's history.

    Goes from the history along the edges (at most K per product) to the candidates, instead of pairing
    every candidate with the whole history; pairs without an edge add nothing to any aggregate. Most neighbors are no candidates of the
    user; the marks of the candidates tell, so that these are not shuffled. The exact check follows.
    """
    word, bit = _word_and_bit("product_id")
    marked = split_join(history.select("user_id", F.col("product_id").alias("from_id")), candidate_marks(pairs), "user_id")
    reached = marked.join(
        edges.select(F.col("product_id").alias("from_id"), F.col("neighbor_product_id").alias("product_id"), "score"), "from_id"
    ).where(F.get("marks", word).bitwiseAND(bit) != 0)
    wanted = reached.select("user_id", "product_id", "score").join(pairs.select("user_id", "product_id"), ["user_id", "product_id"], "left_semi")
    place = F.row_number().over(Window.partitionBy("user_id", "product_id").orderBy(F.col("score").desc_nulls_last()))
    aggregates = (
        wanted.withColumn("_at", place)
        .groupBy("user_id", "product_id")
        .agg(
            F.max("score").alias("sim_max"),
            F.avg("score").alias("sim_mean"),
            F.avg(F.when(F.col("_at") <= top, F.col("score"))).alias("sim_topk_mean_10"),
            F.count("score").alias("sim_nonzero_cnt"),
        )
    )
    joined = pairs.join(aggregates, ["user_id", "product_id"], "left")
    zero = F.lit(0.0)
    return joined.withColumns(
        {
            "sim_max": F.coalesce("sim_max", zero),
            "sim_mean": F.coalesce("sim_mean", zero),
            "sim_topk_mean_10": F.coalesce("sim_topk_mean_10", zero),
            "sim_nonzero_cnt": F.coalesce("sim_nonzero_cnt", F.lit(0)).cast("bigint"),
        }
    )
