"""Exact quantiles and positions, on values that equal-width slices handle badly."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.functions import positions as P

PROBS = {"q0": 0.0, "q25": 0.25, "median": 0.5, "q75": 0.75, "q999": 0.999, "q1": 1.0}


def frame(kind, n=20_000):
    rng = np.random.default_rng(5)
    if kind == "outlier":
        return np.append(rng.normal(size=n - 1), 1e18)
    if kind == "ties":
        return rng.integers(0, 3, n).astype(float)
    if kind == "heavy":
        return np.exp(rng.normal(0, 8, n))
    return np.full(n, 2.5)


@pytest.mark.parametrize("counted", [P.COUNTED, 3000])
@pytest.mark.parametrize("kind", ["outlier", "ties", "heavy", "constant"])
def test_quantiles_equal_numpy(spark, monkeypatch, kind, counted):
    monkeypatch.setattr(P, "COUNTED", counted)
    values = frame(kind)
    df = spark.createDataFrame(pd.DataFrame({"v": values, "g": np.arange(len(values)) % 3})).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = P.quantiles(df, "v", PROBS).first()
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12), name
    for r in P.quantiles(df, "v", PROBS, ["g"]).collect():
        part = values[np.arange(len(values)) % 3 == (r["g"] or 0)]
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(part, p), rel=1e-12), (r["g"], name)


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_quantiles_of_few_values(spark, n):
    values = np.arange(n) ** 2.0
    df = spark.createDataFrame(pd.DataFrame({"v": values})).union(spark.sql("SELECT CAST(NULL AS DOUBLE)"))
    got = P.quantiles(df, "v", PROBS).first()
    assert [got[k] for k in PROBS] == pytest.approx([np.quantile(values, p) for p in PROBS.values()])
    assert P.quantiles(df.where("v IS NULL"), "v", PROBS, []).where("median IS NOT NULL").count() == 0


def test_only_brackets_are_moved(spark):
    """Of 200,000 different values with an outlier, the counted ones are far fewer than a tenth."""
    df = spark.createDataFrame(pd.DataFrame({"v": frame("outlier", 200_000)}))
    inside, totals = P.brackets(df, "v", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    assert totals.first()["_total"] == 200_000
    assert 0 < inside.agg(F.sum("n")).first()[0] < 2_000


def test_positions_in_even_ranges(spark):
    """A group of a million rows with scores below 1e-6, next to small groups and a null one."""
    score = F.when(F.col("id") < 1_000_000, F.col("id") * 1e-13).otherwise(F.col("id") % 7 / 7)
    group = F.when(F.col("id") < 1_000_000, 1).otherwise(F.when(F.col("id") % 5 > 0, F.col("id") % 5 + 1))
    rows = spark.range(1_000_400).select("id", group.alias("g"), score.alias("s"))
    order = [F.col("s").desc(), F.col("id")]
    sizes = [r["count"] for r in P.in_ranges(rows, [F.col("g").asc_nulls_first(), *order]).where("g = 1").groupBy("_slice").count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    placed = P.ranged_position(rows, ["g"], order, "p")
    assert placed.where("g = 1 AND p <> 1000000 - id").count() == 0
    small = {(r["g"], r["id"]): r["p"] for r in placed.where("g IS NULL OR g > 1").collect()}
    plain = rows.where("g IS NULL OR g > 1").toPandas()
    want = plain.sort_values(["s", "id"], ascending=[False, True])
    want["p"] = want.groupby("g", dropna=False).cumcount() + 1
    assert small == {(None if r.g != r.g else int(r.g), int(r.id)): r.p for r in want.itertuples()}


def test_dense_index_of_ids_far_apart(spark):
    ids = [5, -3, 1 << 60, 12345678901234, -(1 << 61), 5]
    df = spark.createDataFrame([(v,) for v in ids] + [(None,)], "k long")
    assert {r["k"]: r["at"] for r in P.dense_index(df, "k", "at").collect()} == {v: n for n, v in enumerate(sorted(set(ids)))}
