"""The vector searches against brute force."""

import numpy as np
import pytest

from basketry.llm import ann, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(3)
    x = draw.standard_normal((700, 24)).astype(np.float32) / 5
    x[50:120] = x[50]  # a large group of ties
    rows = [(k, [float(v) for v in x[k]], 0) for k in range(700)]
    odd = [(700, None, 0), (701, [], 0), (702, [0.0] * 24, 0), (703, [float("nan")] + [0.1] * 23, 0), (704, [None] + [0.1] * 23, 0), (None, [0.1] * 24, 0), (705, [0.5] * 7, 0), (3, rows[3][1], 1)]
    return x.astype(float), spark.createDataFrame(rows + odd, SCHEMA)


def best(score, ids, own, k):
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != own]
    return [(int(ids[i]), score[i]) for i in order[:k]]


def test_top_k_is_exact(table):
    x, df = table
    x = np.vstack([x, np.zeros((3, 24))])  # 702 takes part, as a vector of zeros
    ids = np.array([*range(700), 702, -1, -2])
    whole = np.floor(256 * x)
    found = vectors.valid_vectors(df).selectExpr("vec_id", "transform(x, v -> CAST(floor(v * 256) AS DOUBLE)) AS x")
    got = topk.search(found, found.where("vec_id % 50 = 0"), 5, shard_rows=100, block_queries=4).toPandas()
    assert sorted(got.query_id.unique()) == list(range(0, 700, 50))
    for q, rows in got.groupby("query_id"):
        score = whole[:701] @ whole[q]
        want = best(score, ids[:701], q, 5)
        assert [(v, float(s)) for v, s in zip(rows.sort_values("rank").vec_id, rows.sort_values("rank").score)] == want


def test_adaptive_scan_recall_and_scores(table):
    x, df = table
    found = vectors.valid_vectors(df).where("exists(x, v -> v != 0)")
    got = ann.search(found, found.where("vec_id % 20 = 0"), 20, list_rows=60).toPandas()
    hits = total = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert list(rows["rank"]) == list(range(1, len(rows) + 1))
        np.testing.assert_allclose(rows.score, x[rows.vec_id] @ x[q], atol=1e-9)
        want = {v for v, _ in best(x @ x[q], np.arange(700), q, 20)}
        hits, total = hits + len(want & set(rows.vec_id)), total + 20
    assert got.query_id.nunique() == 35 and hits / total >= 0.9


def test_empty_and_few(spark):
    none = spark.createDataFrame([], SCHEMA)
    for search in (topk.search, ann.search):
        found = vectors.valid_vectors(none)
        assert search(found, found, 5).count() == 0
        two = vectors.valid_vectors(spark.createDataFrame([(0, [1.0, 2.0], 0), (20, [2.0, 1.0], 0)], SCHEMA))
        assert [tuple(r)[:3] for r in search(two, two, 5).orderBy("query_id").collect()] == [(0, 1, 20), (20, 1, 0)]
