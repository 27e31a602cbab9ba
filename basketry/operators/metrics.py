"""Classification metrics over (label, score) rows and ranking metrics over groups of scored rows.

Labels are 0 or 1. Scores are compared after rounding (see ``functions.positions``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.skew import split_join
from basketry.functions.positions import quantile_sums, quantile_values, rounded, running_totals, score_slice

KS = (5, 10, 20)


def threshold_counts(df: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = (), slice_by: Column | None = None) -> DataFrame:
    """Positives and negatives per distinct score (``pos``, ``neg``), at or above it (``tp``, ``fp``) and in all."""
    counts = df.groupBy(*group, rounded(score).alias("threshold")).agg(
        F.sum(F.col(label)).alias("pos"), F.sum(1 - F.col(label)).alias("neg")
    )
    placed = running_totals(counts, "threshold", ["pos", "neg"], score_slice("threshold") if slice_by is None else slice_by, group, descending=True)
    return placed.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "all_pos": "n_pos", "all_neg": "n_neg"})


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score plus the origin (null threshold)."""
    points = threshold_counts(df, label, score).select(
        "threshold", F.try_divide("fp", "n_neg").alias("fpr"), F.try_divide("tp", "n_pos").alias("tpr")
    )
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", group: Sequence[str] = (), slice_by: Column | None = None) -> DataFrame:
    """Probability that a positive scores above a negative; ties count half.

    A positive loses to the negatives above it, so the class sizes come from the same aggregate.
    """
    counts = threshold_counts(df, label, score, group, slice_by)
    losses = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2))
    return counts.groupBy(*group).agg((1 - F.try_divide(losses, F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score plus the closing point (precision 1, recall 0)."""
    points = threshold_counts(df, label, score).select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide("tp", "n_pos").alias("recall")
    )
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Sum over distinct scores of the recall gained there times the precision there."""
    counts = threshold_counts(df, label, score)
    gained = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return counts.agg(F.try_divide(gained, F.sum("pos")).alias("average_precision"))


def ks_statistic(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return roc_curve(df, label, score).agg(F.max(F.col("tpr") - F.col("fpr")).alias("ks"))


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    predicted = (F.col(score) >= threshold).cast("bigint")
    return df.groupBy(F.col(label).alias("actual"), predicted.alias("predicted")).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""
    cells = confusion_matrix(df, label, score, threshold).agg(
        *[
            F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))), F.lit(0)).alias(f"n{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    columns = {}
    for c, other in ((0, 1), (1, 0)):
        hit, support = F.col(f"n{c}{c}"), F.col(f"n{c}{c}") + F.col(f"n{c}{other}")
        columns[f"p{c}"] = ratio(hit, hit + F.col(f"n{other}{c}"))
        columns[f"r{c}"] = ratio(hit, support)
        columns[f"s{c}"] = support
    rates = cells.select("*", *[v.alias(k) for k, v in columns.items()])
    rates = rates.withColumns({f"f{c}": ratio(2 * F.col(f"p{c}") * F.col(f"r{c}"), F.col(f"p{c}") + F.col(f"r{c}")) for c in (0, 1)})
    total = F.col("s0") + F.col("s1")
    accuracy = ratio(F.col("n00") + F.col("n11"), total)

    def row(name: str, values: Sequence[Column], support: Column) -> Column:
        named = zip(("precision", "recall", "f1"), values)
        return F.struct(F.lit(name).alias("row"), *[v.cast("double").alias(n) for n, v in named], support.cast("bigint").alias("support"))

    classes = [row(str(c), [F.col(f"p{c}"), F.col(f"r{c}"), F.col(f"f{c}")], F.col(f"s{c}")) for c in (0, 1)]
    macro = row("macro avg", [(F.col(f"{m}0") + F.col(f"{m}1")) / 2 for m in "prf"], total)
    weighted = row("weighted avg", [ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total) for m in "prf"], total)
    return rates.select(F.inline(F.array(*classes, row("accuracy", [accuracy] * 3, total), macro, weighted)))


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score", n_bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin; empty bins are dropped.

    The bin of a score is the number of inner quantile edges below it. An interpolated edge lies below a
    score exactly if its lower rank does, so ranks decide and the edges need not be computed.
    """
    counts = df.groupBy(rounded(score).alias("p")).agg(F.count("*").alias("n"), F.sum(label).alias("pos"))
    placed = running_totals(counts, "p", ["n"], score_slice("p"))
    start = F.col("cum_n") - F.col("n")
    below = [(F.floor((F.col("all_n") - 1) * F.lit(i / n_bins)) < start).cast("bigint") for i in range(1, n_bins)]
    binned = placed.withColumn("bin", sum(below[1:], below[0]))
    return binned.groupBy("bin").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("mean_predicted"),
        (F.sum("pos") / F.sum("n")).alias("observed_rate"),
    )


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group. Spark trims each group before the shuffle, so none is moved whole."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def _discount(rank: Column) -> Column:
    return F.lit(1.0) / F.log2(rank + 1)


def ideal_dcg(n_pos: Column, k: int) -> Column:
    """DCG of a list that starts with all positives, cut at ``k``."""
    sums, total = [0.0], 0.0
    for i in range(1, k + 1):
        total += 1.0 / math.log2(i + 1)
        sums.append(total)
    return F.element_at(F.array(*[F.lit(s) for s in sums]), F.least(n_pos, F.lit(k)).cast("int") + 1)


def ranking_metrics(
    df: DataFrame,
    group: str = "order_id",
    item: str = "product_id",
    label: str = "label",
    score: str = "score",
    ks: Sequence[int] = KS,
    empty_value: float = 0.0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All metrics per group and ``k``.

    Only the first ``max(ks)`` rows of a group and its number of positives are needed: with 0/1 labels
    the ideal DCG depends on that number alone. ``empty_value`` is the NDCG of a group without positives.
    ``recall_window`` divides by the positives inside the first k, ``recall`` by all of them.
    ``keep`` names further columns that are constant within a group.
    """
    rows = df.select(group, item, F.col(label).alias("_y"), rounded(score).alias("_s"))
    kept = [F.max(c).alias(c) for c in keep]
    totals = df.groupBy(group).agg(F.count("*").alias("n_rows"), F.sum(label).alias("n_pos"), *kept)
    top = top_k_per_group(rows, [group], [F.col("_s").desc(), F.col(item)], max(ks), "_r")
    upto = Window.partitionBy(group).orderBy("_r").rowsBetween(Window.unboundedPreceding, 0)
    hits = top.withColumn("_precision", F.sum("_y").over(upto) / F.col("_r"))
    sums = []
    for k in ks:
        hit = (F.col("_r") <= k) & (F.col("_y") == 1)
        sums += [
            F.sum(F.when(hit, _discount(F.col("_r")))).alias(f"_dcg{k}"),
            F.count(F.when(hit, F.lit(1))).alias(f"_hits{k}"),
            F.avg(F.when(hit, F.col("_precision"))).alias(f"_map{k}"),
        ]
    per_group = hits.groupBy(group).agg(*sums).join(totals, group)
    zero = F.lit(0.0)
    out = [F.col(group), F.col("n_rows"), F.col("n_pos"), *[F.col(c) for c in keep]]
    for k in ks:
        dcg, n_hits = F.coalesce(f"_dcg{k}", zero), F.col(f"_hits{k}")
        out += [
            dcg.alias(f"dcg_{k}"),
            F.when(F.col("n_pos") > 0, dcg / ideal_dcg(F.col("n_pos"), k)).otherwise(F.lit(float(empty_value))).alias(f"ndcg_{k}"),
            F.coalesce(f"_map{k}", zero).alias(f"map_{k}"),
            (n_hits > 0).cast("double").alias(f"recall_window_{k}"),
            F.coalesce(F.try_divide(n_hits, F.col("n_pos")), zero).alias(f"recall_{k}"),
            (n_hits > 0).cast("double").alias(f"hitrate_{k}"),
        ]
    return per_group.select(*out)


def first_hits(df: DataFrame, group: str = "order_id", item: str = "product_id", label: str = "label", score: str = "score") -> DataFrame:
    """Rank of the first positive of each group, its reciprocal, and whether it comes first.

    The rank is the number of rows ahead of the best positive, so no group is sorted.
    """
    rows = df.select(group, item, F.col(label).alias("_y"), rounded(score).alias("_s"))
    best_score = rows.where("_y = 1").groupBy(group).agg(F.max("_s").alias("_best"))
    ties = split_join(rows.where("_y = 1"), best_score, group).where("_s = _best")
    best = ties.groupBy(group).agg(F.max("_best").alias("_best"), F.min(item).alias("_item"))
    ahead = (F.col("_s") > F.col("_best")) | ((F.col("_s") == F.col("_best")) & (F.col(item) < F.col("_item")))
    placed = split_join(rows, best, group, "left").groupBy(group).agg(F.max("_best").alias("_best"), F.count_if(ahead).alias("_ahead"))
    found = placed.select(group, F.when(F.col("_best").isNotNull(), F.col("_ahead") + 1).alias("first_rank"))
    return found.select(
        group,
        "first_rank",
        F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0)).alias("reciprocal_rank"),
        F.coalesce((F.col("first_rank") == 1).cast("int"), F.lit(0)).alias("top1"),
    )


def metric_means(per_group: DataFrame, group: str = "order_id") -> DataFrame:
    """Number of groups and rows, and the mean of every metric column."""
    names = [c for c in per_group.columns if c not in (group, "n_rows", "n_pos")]
    return per_group.agg(F.count("*").alias("n_groups"), F.sum("n_rows").alias("rows_scored"), *[F.avg(c).alias(c) for c in names])


def metric_distribution(per_group: DataFrame, metric: str, hit: str) -> DataFrame:
    """Mean, quartiles and spread of a metric in [0, 1], and how many groups have a hit."""
    counts = per_group.groupBy(rounded(metric).alias("_v")).agg(F.count("*").alias("n"), F.count_if(F.col(hit) > 0).alias("hits"))
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    v, n = F.col("_v"), F.col("n")
    sums = running_totals(counts, "_v", ["n"], score_slice("_v")).agg(
        *quantile_sums(quartiles), F.sum(v * n).alias("s1"), F.sum(v * v * n).alias("s2"), F.sum("hits").alias("n_hit")
    )
    total = F.col("_total")
    variance = F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / total, F.lit(0.0)) / (total - 1)
    return sums.select(
        total.alias("n_groups"),
        (F.col("s1") / total).alias("mean"),
        F.when(total > 1, F.sqrt(variance)).alias("std"),
        *quantile_values(quartiles),
        "n_hit",
        (total - F.col("n_hit")).alias("n_missed"),
        (F.col("n_hit") / total).alias("hit_share"),
    )
