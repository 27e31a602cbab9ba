"""Candidate products of each target order, their labels and their features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.skew import split_join
from basketry.operators.features import PAIR_FEATURES, PRODUCT_FEATURES, USER_FEATURES, history_pairs

# Column order of the candidate table.
ID_COLUMNS = ["user_id", "order_id", "product_id"]
ORDER_COLUMNS = ["order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]
SIMILARITY_COLUMNS = ["als_score", "sim_max", "sim_mean", "sim_topk_mean_10", "sim_nonzero_cnt"]
FEATURE_COLUMNS = [*ORDER_COLUMNS, *SIMILARITY_COLUMNS, *USER_FEATURES, *PRODUCT_FEATURES, *PAIR_FEATURES]
# End of the fixed values.


def expand_candidates(targets: DataFrame, history: DataFrame, owners: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """Every target order with all products its user bought before.

    The history is a long table, not a list per user, and brings further columns along; ``carried`` names those of the targets.
    A user without history keeps one row with a null product. The history of a hot user is split over several tasks; users without
    one are added by an anti join with ``owners``, the users of the history, so give a cheap table of them if there is one.
    """
    wanted = targets.select("user_id", "order_id", *ORDER_COLUMNS, *carried)
    found = split_join(history, wanted, "user_id")
    users = (history if owners is None else owners).select("user_id").distinct()
    alone = wanted.join(users, "user_id", "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)


def attach_labels(candidates: DataFrame, target_lines: DataFrame) -> DataFrame:
    """Label 1 if the product is in the target order, else 0."""
    bought = target_lines.select("order_id", "product_id").distinct().withColumn("_hit", F.lit(1))
    return candidates.join(bought, ["order_id", "product_id"], "left").withColumn("label", F.coalesce("_hit", F.lit(0)).cast("bigint")).drop("_hit")


def attach_similarity(candidates: DataFrame, pair_scores: DataFrame) -> DataFrame:
    """Factor score and similarity aggregates; 0 where a pair has none."""
    scores = pair_scores.select("user_id", "product_id", *SIMILARITY_COLUMNS)
    joined = candidates.join(scores, ["user_id", "product_id"], "left")
    fill = {c: F.coalesce(c, F.lit(0.0)) for c in SIMILARITY_COLUMNS if c != "sim_nonzero_cnt"}
    return joined.withColumns({**fill, "sim_nonzero_cnt": F.coalesce("sim_nonzero_cnt", F.lit(0)).cast("bigint")})


def attach_features(candidates: DataFrame, users: DataFrame | None, products: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Star join of the feature tables; numeric gaps become 0, also the gap of a first order.

    ``pairs`` is left out if the history brought its columns along, ``users`` if the targets did.
    """
    joined = candidates if pairs is None else candidates.join(pairs, ["user_id", "product_id"], "left")
    joined = joined if users is None else joined.join(users, "user_id", "left")
    joined = joined.join(products, "product_id", "left")
    filled = [c for c in FEATURE_COLUMNS if c in joined.columns]
    return joined.na.fill(0, filled)


def ordered_columns(df: DataFrame) -> DataFrame:
    """Ids, label if present, then the features in their fixed order."""
    names = [*ID_COLUMNS, "label", *FEATURE_COLUMNS]
    return df.select(*[c for c in names if c in df.columns])


def candidate_base(orders: DataFrame, lines: DataFrame, split: str) -> DataFrame:
    """Candidates of one split with labels; the lines of test orders are not looked at."""
    targets = orders.where(F.col("eval_set") == split)
    history = history_pairs(lines.where("eval_set = 'prior'"))
    expanded = expand_candidates(targets, history)
    return attach_labels(expanded, lines.where("eval_set = 'train'")) if split == "train" else expanded


def group_sizes(candidates: DataFrame, group: str = "order_id") -> DataFrame:
    return candidates.groupBy(group).agg(F.count("*").alias("n_candidates"))
