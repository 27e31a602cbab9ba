"""Learned models: against numpy, and for the properties they must have."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.operators import attribution as A
from basketry.operators import calibrate as B
from basketry.operators import factors as L
from basketry.operators import inner_product as IP
from basketry.operators import metrics as M
from basketry.operators import preprocess as Q
from basketry.operators import qda as D
from basketry.operators import ranker as K
from basketry.plans import QUERIES
from basketry.plans import scoring as S
from basketry.session import materialize, scratch_path
from basketry.sources import tables as T

IDS = ["user_id", "order_id", "product_id"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(9)
    n = 1200
    y = (rng.random(n) < 0.3).astype(int)
    a = rng.normal(0, 1 + y, n)
    b = 0.5 * a + rng.normal(y, 1, n)
    c = rng.lognormal(0, 1.2, n) * (1 + y)
    order = np.arange(n) // 12
    return pd.DataFrame({"user_id": order, "order_id": order + 1000, "product_id": np.arange(n) % 12, "label": y, "a": a, "b": b, "c": c})


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame)


def plain_log_odds(x, y, reg):
    sides = []
    for k in (0, 1):
        xk = x[y == k]
        s = (1 - reg) * np.cov(xk.T) + reg * np.eye(x.shape[1])
        d = x - xk.mean(axis=0)
        sides.append(np.log(len(xk) / len(x)) - 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) + np.linalg.slogdet(s)[1]))
    return sides[1] - sides[0]


def prepared(frame):
    x = frame[["a", "b", "c"]].copy()
    x["c"] = np.log1p(x["c"])
    return ((x - x.mean()) / x.std(ddof=0)).to_numpy()


def test_skew_matches_pandas(table, frame):
    got = {r.column_name: (r.skew, r.is_skewed) for r in Q.skewed_columns(table, ["a", "b", "c"]).collect()}
    for c in "abc":
        assert got[c][0] == pytest.approx(frame[c].skew()) and got[c][1] == (frame[c].skew() > 1)
    with_null = table.withColumn("a", F.when(F.col("product_id") > 0, F.col("a")))
    assert Q.skewed_columns(with_null, ["a"]).first().skew is None


def test_preprocessing(spark, table, frame):
    holes = table.withColumn("b", F.when(F.col("product_id") != 3, F.col("b")))
    prep = Q.fit_preprocessing(holes, ["a", "b", "c"])
    assert prep.logged == ["c"]
    want = frame["b"].where(frame["product_id"] != 3)
    assert prep.median[1] == pytest.approx(want.median())
    assert prep.mean[1] == pytest.approx(want.fillna(want.median()).mean()) and prep.scale[1] == pytest.approx(want.fillna(want.median()).std(ddof=0))
    constant = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert Q.scales(constant, ["v"]).first().scale == 1.0


def test_folds_are_stratified(table, frame):
    folds = Q.stratified_folds(table, IDS).toPandas()
    sizes = folds.groupby(["label", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all() and len(folds) == len(frame)
    again = Q.stratified_folds(table.repartition(5), IDS).toPandas()
    key = [*IDS, "fold"]
    assert folds[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_qda_matches_numpy(spark, table, frame):
    fit, rows = D.fit_qda(table, ["a", "b", "c"], IDS)
    x, y = prepared(frame), frame["label"].to_numpy()
    scored = D.score_new(table, fit).toPandas().set_index(IDS).loc[list(frame[IDS].itertuples(index=False, name=None))]
    want = 1 / (1 + np.exp(-plain_log_odds(x, y, fit.reg)))
    np.testing.assert_allclose(scored["qda_p_score"], want, rtol=1e-6, atol=1e-9)
    assert fit.cv_auc > 0.6 and fit.cv_auc == max(s[2] for s in fit.search if s[0] == "fine")
    folds = rows.select(*IDS, "fold").toPandas().set_index(IDS).loc[list(frame[IDS].itertuples(index=False, name=None))]["fold"].to_numpy()
    out = D.score_training(rows, fit).toPandas().set_index(IDS).loc[list(frame[IDS].itertuples(index=False, name=None))]
    keep, at = folds != 2, folds == 2
    model = D.QdaModel.from_stats(*[D.ClassStats(int((y[keep] == k).sum()), x[keep & (y == k)].sum(0), x[keep & (y == k)].T @ x[keep & (y == k)]) for k in (0, 1)])
    np.testing.assert_allclose(out["qda_p_score"][at], 1 / (1 + np.exp(-model.log_odds(x[at], fit.reg))), rtol=1e-6, atol=1e-9)
    saved = T.load_classifier(spark, T.save_classifier(spark, fit, scratch_path(spark, "qda")))
    again = D.score_new(table, saved).toPandas().set_index(IDS).loc[scored.index]
    np.testing.assert_allclose(again["qda_p_score"], scored["qda_p_score"])


def test_refined_range():
    assert D.refined(0.1) == [round(0.05 + 0.01 * i, 2) for i in range(11)] and D.refined(0.4)[-1] == 0.45


def brute_lambdas(part, truncation):
    part = part.sort_values(["score", "product_id"], ascending=[False, True]).reset_index(drop=True)
    ideal = sum(1 / np.log2(i + 2) for i in range(min(part.label.sum(), truncation)))
    push, curve = np.zeros(len(part)), np.zeros(len(part))
    for i in range(min(truncation, len(part))):
        for j in range(i + 1, len(part)):
            if part.label[i] == part.label[j]:
                continue
            hi, lo = (i, j) if part.label[i] else (j, i)
            w = abs(1 / np.log2(i + 2) - 1 / np.log2(j + 2)) / ideal
            m = 1 / (1 + np.exp(part.score[hi] - part.score[lo]))
            push[hi] += w * m
            push[lo] -= w * m
            curve[[hi, lo]] += w * m * (1 - m)
    return {int(p): (a, b) for p, a, b in zip(part.product_id, push, curve)}


@pytest.mark.parametrize("largest", [None, 12])
def test_lambda_gradients(spark, frame, largest):
    rows = frame[frame.order_id < 1010].assign(score=lambda d: d.b.round(1), n_pos=lambda d: d.groupby("order_id").label.transform("sum"))
    rows = rows[rows.n_pos > 0]
    got = K.lambda_gradients(spark.createDataFrame(rows[["order_id", "product_id", "label", "score", "n_pos"]]), truncation=4, largest=largest).collect()
    for order, part in rows.groupby("order_id"):
        want = {p: v for p, v in brute_lambdas(part, 4).items() if v != (0, 0)}
        assert {r.product_id: (r.push, r.curve) for r in got if r.order_id == order} == {p: pytest.approx(v) for p, v in want.items()}


@pytest.fixture(scope="module")
def ranker(table):
    params = K.RankerParams(rounds=5, learning_rate=0.5, max_depth=3, min_rows_per_leaf=10, min_hessian=0.1, l1=0.0, patience=3, checkpoint_every=2)
    return K.fit_ranker(table, ["a", "b", "c"], params)


def test_ranker_beats_random_order(spark, table, ranker):
    assert 1 <= ranker.best_round <= len(ranker.log)
    valid = Q.user_split(table).where("is_valid")
    ours = M.metric_means(M.ranking_metrics(ranker.score(valid))).first().ndcg_5
    random = M.metric_means(M.ranking_metrics(valid.withColumn("score", F.pmod(F.xxhash64(*IDS), F.lit(1000)) / 1000.0))).first().ndcg_5
    assert ours > random
    # The best round is that of the metric that stalled first; the kept trees are those up to it.
    assert ours == pytest.approx(ranker.log[ranker.best_round - 1]["valid_ndcg_5"])


def test_ranker_round_trip(spark, table, ranker):
    saved = T.load_ranker(spark, T.save_ranker(spark, ranker, scratch_path(spark, "ranker")))
    a, b = [sorted(map(tuple, r.score(table).select(*IDS, "score").collect())) for r in (ranker, saved)]
    assert a == b
    gains = K.gain_importance(ranker, spark)
    assert gains.count() == 3 and gains.first().gain > 0


def test_newton_values():
    leaves = {0: (5.0, 25.0), 1: (-0.5, 30.0), 2: (9.0, 1.0)}
    got = {leaf: K.newton_value(push, curve, 1.0, 5.0, 20.0) for leaf, (push, curve) in leaves.items()}
    assert got == pytest.approx({0: 4 / 30, 1: 0.0, 2: 0.0})


def test_attributions_add_up(table, ranker):
    rows = table.limit(6)
    got = A.sampled_attributions(rows, table, ranker.features, IDS, ranker.score, permutations=5, n_background=20).toPandas()
    sums = got.groupby(IDS).agg(total=("attribution", "sum"), base=("base_value", "first"))
    scores = ranker.score(rows).toPandas().set_index(IDS)["score"]
    np.testing.assert_allclose((sums.total + sums.base).sort_index(), scores.sort_index(), atol=1e-9)
    assert A.mean_absolute(A.sampled_attributions(rows, table, ranker.features, IDS, ranker.score)).count() == 3


def test_linear_attributions_are_exact(table, frame):
    """For a linear score the mean attribution is the weight times the distance to the sampled base rows."""
    rows = table.limit(3)
    score = lambda df: df.withColumn("score", 2 * F.col("a") - F.col("b"))
    got = A.sampled_attributions(rows, table, ["a", "b", "c"], IDS, score, permutations=3, n_background=1).toPandas()
    base = Q.seeded_sample(table, 1, IDS).first()
    want = {"a": lambda v: 2 * (v - base.a), "b": lambda v: -(v - base.b), "c": lambda v: 0.0}
    for r in got.itertuples():
        assert r.attribution == pytest.approx(want[r.feature](r.value), abs=1e-9)


def test_factors(spark):
    taste = [(u, p, 3) for u in range(20) for p in range(10) if (u < 10) == (p < 5) and (u + p) % 4]
    pairs = spark.createDataFrame(taste, "user_id long, product_id long, count long")
    model = L.fit_factors(pairs, L.FactorParams(rank=4, iterations=8, blocks=2))
    users, products = L.factor_tables(model)
    every = spark.createDataFrame([(0, 2), (0, 7), (77, 1)], "user_id long, product_id long")
    got = {(r.user_id, r.product_id): r.als_score for r in L.score_pairs(every, users, products).collect()}
    assert got[0, 2] > got[0, 7] + 0.3 and got[77, 1] == 0
    plain = {(r.user_id, r.product_id): r.prediction for r in model.transform(every.limit(2)).collect()}
    assert {k: got[k] for k in plain} == pytest.approx(plain, abs=1e-5)
    seen = pairs.where("user_id < 2")
    top = L.recommend_unseen(model, pairs.where("user_id < 2").select("user_id"), seen, 3).toPandas()
    assert (top.groupby("user_id").size() == 3).all()
    assert not set(map(tuple, top[["user_id", "product_id"]].values)) & {(u, p) for u, p, _ in taste}
    again = T.load_factors(spark, T.save_factors(users, products, scratch_path(spark, "factors")))
    assert L.factor_stability(users, again[0], "user_id").first().mean_cosine == pytest.approx(1.0)


def test_unseen_skips_long_exclusions(spark):
    """A user who excludes almost everything still gets what is left."""
    pairs = spark.createDataFrame([(u, p, 1) for u in range(3) for p in range(60)], "user_id long, product_id long, count long")
    model = L.fit_factors(pairs, L.FactorParams(rank=2, iterations=2, blocks=2))
    exclude = spark.createDataFrame([(0, p) for p in range(57)] + [(1, 0)], "user_id long, product_id long")
    top = L.recommend_unseen(model, pairs.select("user_id"), exclude, 5).toPandas()
    assert sorted(top[top.user_id == 0].product_id) == [57, 58, 59] and (top[top.user_id == 1].shape[0], top[top.user_id == 2].shape[0]) == (5, 5)


def skewed_vectors(n, rank, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, rank)) * np.exp(rng.normal(0, spread, (n, 1)))


@pytest.mark.parametrize("portion", [None, 3000])
def test_top_products_equal_brute_force(spark, monkeypatch, portion):
    """Over several blocks, and over several portions; with ties, zero vectors, and users who exclude nearly everything."""
    monkeypatch.setattr(IP, "BLOCK", 16)
    if portion:
        monkeypatch.setattr(IP, "PORTION", portion)
    u, v = skewed_vectors(90, 5, 1), skewed_vectors(130, 5, 2)
    v[100:110] = v[3]  # ties
    v[120:] = 0
    u[7] = 0
    rng = np.random.default_rng(3)
    exclude = {k: set(rng.choice(130, int(rng.choice([0, 3, 40, 128, 130])), replace=False).tolist()) for k in range(90)}
    users = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(u)], "user_id long, factors array<double>")
    products = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(v)], "product_id long, factors array<double>")
    pairs = spark.createDataFrame([(k, p) for k, s in exclude.items() for p in s] + [(1, 999), (777, 1), (2, None)], "user_id long, product_id long")
    got = {}
    for r in L.top_products(users, products, pairs, 7).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["product_id"], r["score"]))
    scores = np.round(u @ v.T, 9)
    for k in range(90):
        best = sorted((-scores[k, p], p) for p in range(130) if p not in exclude[k])[:7]
        assert [(a, b) for a, b, _ in sorted(got.get(k, []))] == [(at + 1, p) for at, (_, p) in enumerate(best)], k


def test_short_vectors_are_not_looked_at(monkeypatch):
    """Users are done when no later block can hold a better product."""
    class Shared:
        value = IP.blocks_of([{"product_id": k, "factors": row, "length": float(np.linalg.norm(row))} for k, row in enumerate(sorted(skewed_vectors(40 * IP.BLOCK, 4, 5, 1.5), key=lambda r: -np.linalg.norm(r)))])

    looked = []
    real = IP.merged
    monkeypatch.setattr(IP, "merged", lambda *a: looked.append(1) or real(*a))
    u = skewed_vectors(20, 4, 6)
    batch = pd.DataFrame({"user_id": range(20), "factors": list(u), "excluded": [None] * 20, "ids": [[]] * 20, "scores": [[]] * 20, "done": [False] * 20})
    out = pd.concat(IP.searcher(Shared, 10, -1.0)([batch]))
    assert len(looked) < 20 * 8  # of 20 x 40 blocks
    every = np.concatenate([b[2] for b in Shared.value])
    want = np.sort(np.round(u @ every.T, 9), axis=1)[:, ::-1][:, :10]
    np.testing.assert_allclose(np.stack(out["scores"]), want)


def test_no_products_and_no_users(spark):
    users = spark.createDataFrame([(1, [1.0])], "user_id long, factors array<double>")
    products = spark.createDataFrame([(1, [1.0])], "product_id long, factors array<double>")
    none = spark.createDataFrame([], "user_id long, product_id long")
    assert L.top_products(users, products.limit(0), none).count() == 0
    assert L.top_products(users.limit(0), products, none).count() == 0
    assert [tuple(r) for r in L.top_products(users, products, none).collect()] == [(1, 1, 1.0, 1)]


def test_ids_beyond_an_int(spark):
    """MLlib's factors need ids of 32 bits; wider ones are numbered for the fit and come back."""
    wide = 1 << 40
    pairs = spark.createDataFrame([(wide + u, wide * 2 + p, 1 + (u + p) % 2) for u in range(8) for p in range(8) if (u < 4) == (p < 4)], "user_id long, product_id long, count long")
    fitted = L.fit_wide_factors(pairs, L.FactorParams(rank=3, iterations=3, blocks=2))
    users, products = fitted
    assert {r["user_id"] for r in users.collect()} == {wide + u for u in range(8)}
    assert {r["product_id"] for r in products.collect()} == {wide * 2 + p for p in range(8)}
    top = L.top_products(users, products, pairs.limit(0), 3).collect()
    assert all((r["user_id"] - wide < 4) == (r["product_id"] - 2 * wide < 4) for r in top)


def plain_isotonic(points):
    """Pooled adjacent violators over (score, label) rows, one row at a time."""
    totals = {}
    for p, y in points:
        a, n = totals.get(p, (0, 0))
        totals[p] = (a + y, n + 1)
    blocks = []
    for p in sorted(totals):
        blocks.append([[p], *totals[p]])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            q, a, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + q, blocks[-1][1] + a, blocks[-1][2] + n]
    return {p: a / n for ps, a, n in blocks for p in ps}, len(blocks)


@pytest.mark.parametrize("kind", ["noisy", "falling", "one score"])
def test_isotonic_equals_brute_force(spark, kind):
    rng = np.random.default_rng(8)
    p = np.round(rng.random(3000), 3)
    y = (rng.random(3000) < p**2).astype(int)
    if kind == "falling":
        y = (p < 0.5).astype(int)
    if kind == "one score":
        p[:] = 0.25
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)] + [(None, 1), (0.5, None)], "p double, y int")
    blocks = B.isotonic_blocks(df, "p", "y")
    want, n_blocks = plain_isotonic(list(zip(p.tolist(), y.tolist())))
    assert blocks.count() == n_blocks <= 3 * 3000 ** (2 / 3)
    got = {r["p"]: r["v"] for r in B.with_isotonic(df.where("p IS NOT NULL AND y IS NOT NULL"), blocks, "p", "v").collect()}
    assert got == pytest.approx(want)

def brute_auc(score, y):
    s, pos, neg = np.round(score, 9), y == 1, y == 0
    return ((s[pos, None] > s[None, neg]).sum() + 0.5 * (s[pos, None] == s[None, neg]).sum()) / (pos.sum() * neg.sum())


def test_cross_validated_auc_equals_all_pairs(spark, monkeypatch):
    """Packed slices, with ties inside a slice and a task that packs several times."""
    monkeypatch.setattr(D, "PACKED", 100)
    rng = np.random.default_rng(3)
    n = 900
    y, fold, x = rng.integers(0, 2, n), rng.integers(0, 3, n), rng.normal(0, 1, (n, 2)).round(1)
    x[y == 1] *= 2
    stats = {(f, k): D.ClassStats(int(m.sum()), x[m].sum(0), x[m].T @ x[m]) for f in range(3) for k in (0, 1) for m in [(fold == f) & (y == k)]}
    _, models = D.fold_models(stats, range(3))
    rows = spark.createDataFrame(pd.DataFrame({"fold": fold, "label": y, "x": list(x.tolist())})).repartition(3)
    got = {r.reg: r.cv_auc for r in D.cross_validated_auc(rows, models, [0.1, 0.3]).collect()}
    for reg in (0.1, 0.3):
        want = np.mean([brute_auc(models[f].log_odds(x[fold == f], reg), y[fold == f]) for f in range(3)])
        assert got[reg] == pytest.approx(want, abs=1e-12)


def test_medians_and_moments_of_odd_columns(spark):
    rng = np.random.default_rng(4)
    wide = rng.normal(0, 1, 501) * 10.0 ** rng.integers(-300, 300, 501)
    rows = pd.DataFrame({"wide": wide, "even": np.r_[wide[:500], 7.0], "zeros": np.where(rng.random(501) < 0.5, -0.0, 0.0), "far": 1e9 + rng.random(501)})
    table = spark.createDataFrame(rows).repartition(4).withColumns({"even": F.when(F.col("even") != 7.0, F.col("even")), "none": F.lit(None).cast("double"), "same": F.lit(0.1)})
    got = {r.column_name: r.median for r in Q.medians(table, table.columns).collect()}
    assert got == {"wide": np.median(wide), "even": pytest.approx(np.median(wide[:500])), "zeros": 0.0, "far": np.median(rows.far), "same": 0.1}
    spread = {r.column_name: r for r in Q.scales(table, ["far", "none", "same"]).collect()}
    assert spread["far"]["std"] == pytest.approx(rows.far.std(ddof=0), rel=1e-6) and spread["far"]["mean"] == pytest.approx(rows.far.mean())
    assert spread["none"]["mean"] is None and spread["none"]["scale"] == 1.0
    assert spread["same"]["mean"] == 0.1 and spread["same"]["std"] == 0.0
    assert Q.skewed_columns(table, ["same"]).first().skew is None


def test_moments_and_medians_move_no_cells(spark):
    """A statistic per batch or count per digit leaves the tasks, not a row per value."""
    table = spark.range(0, 4000, 1, 2).select((F.col("id") % 1000).cast("double").alias("a"), F.rand(3).alias("b"))
    plan = Q.skewed_columns(table, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    assert len(Q.digit_counts(table, {"a": {0}, "b": {0}}, 0)) < 1000


def test_factor_fit_drops_the_shuffles_of_past_iterations(spark):
    """The files of the user factors, the larger side, go with each iteration, so disk does not grow with their number."""
    pairs = spark.range(200).select((F.col("id") % 20).cast("int").alias("user_id"), (F.col("id") % 7).cast("int").alias("product_id"), F.lit(1.0).alias("count")).distinct()
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    kept = {}
    for params in (L.FactorParams(rank=2, iterations=9, blocks=2), L.FactorParams(rank=2, iterations=9, blocks=2, checkpoint_every=10)):
        before = tracker.shuffleStatuses().size()
        L.fit_factors(pairs, params)
        kept[params.checkpoint_every] = tracker.shuffleStatuses().size() - before
    assert kept[1] <= kept[10] - 7


def test_medians_stop_when_all_values_in_reach_are_equal(spark, monkeypatch):
    """Whole numbers and shares are known after a pass or two, and later passes look at open columns only."""
    passes, count = [], Q.digit_counts
    monkeypatch.setattr(Q, "digit_counts", lambda df, known, digit: passes.append(sorted(known)) or count(df, known, digit))
    table = spark.range(2001).select((F.col("id") % 20).cast("double").alias("small"), (F.col("id") / 7).alias("share"), (1 + F.col("id") * F.lit(2.0**-50)).alias("close"))
    assert Q.exact_medians(table, ["small", "share", "close"]) == {"small": 9.0, "share": 1000 / 7, "close": 1 + 1000 * 2.0**-50}
    assert passes[0] == ["close", "share", "small"] and "small" not in passes[1] and passes[2:] == [["close"], ["close"]]


def test_preprocessing_fills_missing_values_and_nan(spark):
    rng = np.random.default_rng(6)
    v = np.r_[rng.lognormal(0, 1.5, 400), [np.nan] * 50]
    table = spark.createDataFrame(pd.DataFrame({"k": range(450), "v": v, "w": np.r_[rng.normal(3, 2, 400), [0.0] * 50]}))
    table = table.select("v", F.when(F.col("k") < 400, F.col("w")).alias("w"), F.lit(None).cast("double").alias("none"))
    prep = Q.fit_preprocessing(table, ["v", "w", "none"], unlogged=[])
    filled = Q.scales(table.na.fill(dict(zip(prep.columns, prep.median))), prep.columns).collect()
    for r in filled:
        at = prep.columns.index(r.column_name)
        assert (prep.mean[at], prep.scale[at]) == pytest.approx((r["mean"], r["scale"]))


def test_shuffle_files_go_with_the_write(spark):
    """What a write shuffled is gone from the disk when the table is there, also while the table that led to it is still known."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}
    before = names()
    df = spark.range(20_000).repartition(3, "id").groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n"))
    first, second = materialize(df, "once"), materialize(df, "twice")
    left = names() - before
    for _ in range(50):  # Files are removed in the background.
        if not left:
            break
        time.sleep(0.2)
        left = names() - before
    assert not left and first.count() == second.count() == 5000


def test_factor_blocks_grow_with_what_they_hold():
    """Small tables keep the asked number of blocks; larger ones get as many as keep the vectors and the ratings of a block in bounds."""
    assert L.blocks_needed(500_000, 10_000, 64, 10) == L.blocks_needed(31_000_000, 600_000, 64, 10) - 1 == 10
    n, users, rows = L.blocks_needed(187_000_000, 3_600_000, 64, 10), 3_600_000, 187_000_000
    met = lambda blocks: users * (1 - (1 - 1 / blocks) ** (rows / users)) * 280
    assert met(n) <= L.BLOCK_BYTES < met(n - 1) < met(10) and rows / n < L.BLOCK_ROWS
    assert L.blocks_needed(0, 0, 64, 10) == 10


def test_wide_fit_takes_more_blocks_where_needed(spark, monkeypatch):
    asked, fit = [], L.fit_factors
    monkeypatch.setattr(L, "BLOCK_ROWS", 5)
    monkeypatch.setattr(L, "fit_factors", lambda df, params, blocks: asked.append(blocks) or fit(df, params, blocks))
    pairs = spark.range(20).select((F.col("id") % 10).alias("user_id"), (F.col("id") % 4).alias("product_id"), F.lit(1.0).alias("count"))
    users, products = L.fit_wide_factors(pairs, L.FactorParams(rank=2, iterations=1, blocks=2))
    assert asked == [(4, 4)] and (users.count(), products.count()) == (10, 4)


def test_factor_properties_move_no_cells(spark, data):
    """Dot products are summed within a row; vectors are not taken apart into a row per cell."""
    plan = QUERIES["m04_m05_factor_properties"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(factors" not in plan


def test_mean_attributions_of_trees_are_those_of_the_steps(table, ranker):
    """The same draws give the same means as scoring step by step, for rows with missing values as well."""
    rows = table.limit(150).withColumn("b", F.when(F.col("product_id") > 0, F.col("b")))
    trees = ranker.trees[: ranker.best_round]
    want = A.mean_absolute(A.sampled_attributions(rows, table, ranker.features, IDS, ranker.score, permutations=3, n_background=20)).toPandas()
    got = A.mean_absolute_of_trees(rows, table, ranker.features, IDS, trees, ranker.learning_rate, permutations=3, n_background=20).toPandas()
    assert got["feature"].tolist() == want["feature"].tolist()
    np.testing.assert_allclose(got["mean_abs_attribution"], want["mean_abs_attribution"], atol=1e-12)


def test_mean_attribution_query_looks_at_all_validation_rows(spark, table, ranker, tmp_path, monkeypatch):
    """The number of rows that are explained one by one does not cut the means."""
    monkeypatch.setattr(S, "EXPLAINED", 5)
    for name, value in (("_ranker", ranker), ("_classified", table), ("_validation", table)):
        monkeypatch.setattr(S, name, lambda *_, value=value: value)
    want = A.mean_absolute(A.sampled_attributions(table, table, ranker.features, IDS, ranker.score, permutations=4, n_background=S.BACKGROUND)).toPandas()
    S._explain.cache_clear()
    got = QUERIES["k07_mean_absolute_attribution"](spark, str(tmp_path)).toPandas()
    S._explain.cache_clear()
    assert got["feature"].tolist() == want["feature"].tolist()
    np.testing.assert_allclose(got["mean_abs_attribution"], want["mean_abs_attribution"], atol=1e-6)


def test_platt_targets(spark):
    """The line is that of a logistic regression on Platt's targets, not on 0 and 1."""
    rng = np.random.default_rng(3)
    z = rng.normal(0, 2, 40)
    y = (rng.random(40) < 1 / (1 + np.exp(-z))).astype(float)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (40 - y.sum() + 2))
    x, w = np.c_[z, np.ones(40)], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (target - p))
    rows = spark.createDataFrame(pd.DataFrame({"z": z, "y": y})).unionByName(spark.sql("SELECT CAST(NULL AS DOUBLE) AS z, 1.0D AS y UNION ALL SELECT 1.0D, NULL"))
    assert B.platt_line(rows, "z", "y") == pytest.approx(tuple(w), abs=1e-4)


@pytest.mark.parametrize(("column", "broken"), [("isotonic", "isotonic_rises"), ("platt", "platt_inside"), (None, None)])
def test_recalibration_properties_see_falls_anywhere(spark, tmp_path, monkeypatch, column, broken):
    """A map that falls between scores that lie far apart, or has no value, breaks its property."""
    p = np.linspace(0.05, 0.95, 19)
    rows = pd.DataFrame({"user_id": range(19), "order_id": range(19), "product_id": range(19), "label": 0.0, "qda_p_score": p, "qda_logit": np.log(p / (1 - p)), "platt": p / 2, "isotonic": p / 3})
    if column:
        rows.loc[9, column] = 0.9
    df = spark.createDataFrame(rows)
    monkeypatch.setattr(S, "_recalibrated", lambda i: df)
    monkeypatch.setattr(S, "_classified", lambda i, split: df)
    got = {r.property: (r.n, r.n_wrong) for r in QUERIES["x08_recalibration_properties"](spark, str(tmp_path)).collect()}
    for name in ("platt_inside", "isotonic_rises"):
        assert got[name] == (19, 9 if name == broken else 0)
