"""Hand-made cases for metrics, scalar functions and distributions."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.functions import scalars as E
from basketry.functions.positions import dense_index, grouped_position, quantiles, running_totals
from basketry.operators import explore as P
from basketry.operators import metrics as M


def ranked(spark, groups):
    """Rows whose score falls with their position: {group: labels by rank}."""
    rows = [(g, i, y, 1.0 - i / 100) for g, labels in groups.items() for i, y in enumerate(labels)]
    return spark.createDataFrame(rows, "order_id long, product_id long, label long, score double")


def test_ndcg_goldens(spark):
    groups = {1: [1, 0, 1, 0, 1] + [0] * 5, 2: [1, 1, 1] + [0] * 7, 3: [0] * 9 + [1] + [0] * 9 + [0, 1, 1], 4: [0, 0, 0], 5: [1, 0, 1]}
    got = {r.order_id: r for r in M.ranking_metrics(ranked(spark, groups)).collect()}
    assert got[1].dcg_10 == pytest.approx(1.8869, abs=1e-4)
    assert got[1].ndcg_10 == pytest.approx(0.8855, abs=1e-4)
    assert got[1].map_10 == pytest.approx(0.7556, abs=1e-4)
    assert got[2].ndcg_10 == pytest.approx(1.0)
    assert got[3].ndcg_10 == pytest.approx(0.1357, abs=1e-4)
    assert all(got[4][m] == 0 for m in ("ndcg_5", "map_10", "recall_window_20", "recall_20", "hitrate_5"))
    assert got[5].ndcg_10 == pytest.approx((1 + 0.5) / (1 + 1 / math.log2(3)))


def test_window_recall_differs_from_recall(spark):
    got = M.ranking_metrics(ranked(spark, {1: [1] + [0] * 10 + [1]})).first()
    assert (got.recall_window_10, got.recall_10) == (1.0, 0.5)


def test_empty_group_value(spark):
    assert M.ranking_metrics(ranked(spark, {1: [0, 0]}), empty_value=1.0).first().ndcg_5 == 1.0


def test_ties_go_to_the_smaller_product(spark):
    df = spark.createDataFrame([(1, 7, 0.5), (1, 3, 0.5)], "order_id long, product_id long, score double")
    top = M.top_k_per_group(df, ["order_id"], [F.col("score").desc(), F.col("product_id")], 1)
    assert top.first().product_id == 3


def test_first_hits(spark):
    got = {r.order_id: (r.first_rank, r.top1) for r in M.first_hits(ranked(spark, {1: [0, 0, 1], 2: [1, 1], 3: [0]})).collect()}
    assert got == {1: (3, 0), 2: (1, 1), 3: (None, 0)}


def test_auc_is_pairwise_probability(spark):
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 40
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert M.roc_auc(df).first().auc == pytest.approx(want)
    flipped = df.withColumn("score", -F.col("score"))
    assert M.roc_auc(flipped).first().auc == pytest.approx(1 - want)


def test_average_precision_is_stepwise(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label long, score double")
    assert M.average_precision(df).first()[0] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert M.ks_statistic(df).first()[0] == pytest.approx(0.5)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.3)], "label long, score double")
    assert M.roc_auc(df).first()[0] is None and M.average_precision(df).first()[0] == 1.0
    assert [r.fpr for r in M.roc_curve(df).where("threshold is not null").collect()] == [None, None]


def test_report_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label long, score double")
    rows = {r.row: r for r in M.classification_report(df).collect()}
    assert (rows["1"].precision, rows["1"].f1, rows["accuracy"].f1) == (0, 0, 0.5)


def test_calibration_bins_match_numpy(spark):
    rng = np.random.default_rng(1)
    p = np.round(rng.beta(1, 6, 500), 3)
    y = (rng.random(500) < p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": p}))
    edges = np.percentile(p, np.arange(10, 100, 10))
    bins = np.searchsorted(edges, p)
    got = {r.bin: (r.n, r.mean_predicted, r.observed_rate) for r in M.calibration_curve(df).collect()}
    assert set(got) == set(bins)
    for b in got:
        assert got[b] == pytest.approx(((bins == b).sum(), p[bins == b].mean(), y[bins == b].mean()))


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.5)], "label long, score double")
    assert M.log_loss(df).first()[0] == pytest.approx(-math.log(0.5) / 2)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 999), "v": np.round(rng.lognormal(0, 2, 999), 4)})
    df = spark.createDataFrame(pdf)
    got = quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.93}, ["g"]).collect()
    for r in got:
        assert [r.a, r.b, r.c] == pytest.approx(np.quantile(pdf.v[pdf.g == r.g], [0.1, 0.5, 0.93]))
    assert quantiles(df, "v", {"m": 0.5}).first().m == pytest.approx(pdf.v.median())


@pytest.mark.parametrize("descending", [False, True])
def test_sliced_positions_equal_plain_ones(spark, descending):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": np.where(rng.random(400) < 0.4, 0, rng.integers(1, 9, 400)), "v": rng.integers(0, 50, 400), "i": range(400)})
    df = spark.createDataFrame(pdf)
    order = [F.col("v").desc() if descending else F.col("v"), F.col("i")]
    sliced = grouped_position(df, ["g"], F.floor(F.col("v") / 7), order, "at", descending)
    plain = grouped_position(df, ["g"], F.lit(0), order, "at", descending, largest=400)
    assert sorted(map(tuple, sliced.select("i", "at").collect())) == sorted(map(tuple, plain.select("i", "at").collect()))


def test_running_totals(spark):
    df = spark.createDataFrame([(k, 1) for k in range(100)], "k long, n long")
    got = running_totals(df, "k", ["n"], F.floor(F.col("k") / 9), descending=True).orderBy("k").collect()
    assert [r.cum_n for r in got] == list(range(100, 0, -1)) and {r.all_n for r in got} == {100}


def test_dense_index(spark):
    df = spark.createDataFrame([(i,) for i in (5, 900_000, 5, 100_001, None, -3)], "u long")
    got = {r.u: r.x for r in dense_index(df, "u", "x").collect()}
    assert got == {-3: 0, 5: 1, 100_001: 2, 900_000: 3}


def test_gap_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 2, 3, 30)] + [(None,)], "v double")
    got = [r[0] for r in df.select(E.right_closed_bin(F.col("v"))).collect()]
    assert got == [None, "0-2", "3-5", "16-30", None]


def test_orders_per_user_edges(spark):
    rows = [(u, n) for u, n in enumerate((4, 5, 100, 101))]
    bins = {r.bin: (r.n_users, r.cum_pct) for r in P.orders_per_user_histogram(spark.createDataFrame(rows, "user_id long, order_number long")).collect()}
    assert (bins[0], bins[1], bins[19]) == ((1, 25.0), (1, 50.0), (1, 75.0))


def test_scalars(spark):
    row = spark.createDataFrame([("x" * 46, 3, "  DairY ", "7, a,12 ,,-3", None)], "t string, n long, d string, ids string, e string")
    got = row.select(
        E.ellipsis(F.col("t")).alias("short"),
        E.confidence(F.col("n")).alias("conf"),
        E.normalized_key(F.col("d")).alias("key"),
        E.normalized_key(F.col("e")).alias("missing"),
        E.parse_id_list(F.col("ids")).alias("ids"),
        E.forward_slashes(F.lit("a\\b\\c")).alias("path"),
        E.lookup(F.lit("none"), {"a": "1", "missing": "0"}).alias("default"),
        E.logit(F.lit(0.8)).alias("logit"),
        E.logit(F.lit(0.8), compat=True).alias("compat"),
        E.log1p_floor0(F.lit(-4)).alias("floor"),
        E.log1p_floor0(F.lit(None)).alias("null"),
        *[E.purchase_badge(F.lit(n)).alias(f"b{n}") for n in (1, 2, 5)],
    ).first()
    assert got.short == "x" * 45 + "..." and got.conf == 121 and got.key == "dairy" and got.missing == "missing"
    assert got.ids == [7, 12] and got.path == "a/b/c" and got.default == "0"
    assert got.logit == pytest.approx(math.log(4)) and got.compat == pytest.approx(math.log(0.2))
    assert got.floor == 0 and got["null"] is None
    assert (got.b1, got.b2, got.b5) == ("✓ Bought before", "✓ Bought 2x before", "⭐ Bought 5x before")
