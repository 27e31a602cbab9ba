"""Queries against their SQL on tables where one order and one user hold a third of all rows."""

import duckdb
import pytest
from check import TABLES, connect, difference
from pyspark.sql import functions as F

import basketry.functions.positions as positions
from basketry.functions import skew
from basketry.operators import candidates as C
from basketry.plans import ORACLES, QUERIES
from basketry.sources import star

NAMES = [
    "s01_orders",
    "s01_order_products",
    "s01_order_products_folded",
    "a01_a07_user_features",
    "a08_product_features",
    "a09_a11_user_product_features",
    "a12_history_lists",
    "a16_basket_summary",
    "a20_numeric_profile",
    "j04_attach_label",
    "j06_train_candidates",
    "j08_w04_dense_indexes",
    "j17_co_purchases",
    "w03_top_neighbors",
    "j09_j11_a17_a18_m07_pair_similarity",
    "r01_neighbors_of_recent",
    "r04_similar_to_cart",
    "r06_cart_department_fallback",
    "r07_popular_department_fallback",
    "r08_same_department_fallback",
    "e01_auc",
    "e07_calibration_curve",
    "e09_e14_ranking_metrics",
    "x01_x02_purchase_rank_and_span",
    "x07_reciprocal_rank_and_top1",
    "w01_rank_in_group",
]


@pytest.fixture(scope="module")
def skewed(data, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES[:9]:
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM '{data}/{t}.parquet'")
    con.execute("UPDATE orders SET o_custkey = 7 WHERE o_orderkey % 3 = 0")
    # A prior order of the busy user takes every third line, with line numbers that run on.
    con.execute("UPDATE lineitem SET l_orderkey = 300, l_linenumber = l_suppkey * 40 + l_partkey WHERE l_partkey % 3 = 0")
    for t in ("orders", "lineitem", "part", "customer", "supplier", "nation", "region"):
        con.execute(f"COPY {t} TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def small_groups():
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(star, "GROUP_LIMIT", 20)
        patch.setattr(positions, "GROUP_LIMIT", 20)
        patch.setattr(skew, "HEAVY_ROWS", 20)
        yield


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables(spark, skewed, small_groups, name):
    assert difference(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name]) == ""


@pytest.fixture
def hot(spark, monkeypatch):
    """60,000 rows of which one user has a third, and the limit from which a key is split."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", 2_000)
    user = F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 501)
    rows = spark.range(60_000).select(user.cast("long").alias("user_id"), F.col("id").alias("product_id"), F.when(F.col("id") % 11 == 0, 1.0).alias("v"))
    return rows.unionByName(spark.createDataFrame([(None, 1, 2.0), (99, 1, 3.0)], "user_id long, product_id long, v double"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_gives_the_same_rows(spark, hot, how):
    small = spark.createDataFrame([(7, "a"), (7, "b"), (101, "c"), (None, "d"), (5, "e")], "user_id long, w string")
    plain = hot.join(small, "user_id", how).groupBy("user_id", "w").agg(F.count("*").alias("n"), F.sum("product_id").alias("s"), F.count("v").alias("v"))
    split = skew.split_join(hot, small, "user_id", how).groupBy("user_id", "w").agg(F.count("*").alias("n"), F.sum("product_id").alias("s"), F.count("v").alias("v"))
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)


def task_rows(spark, df):
    """Rows of each task of the last stage, without the help of adaptive skew splitting and coalescing."""
    with pytest.MonkeyPatch.context():
        old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            found = df().groupBy(F.spark_partition_id().alias("p")).count().collect()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
    return sorted(r["count"] for r in found)


def test_no_task_has_the_hot_user(spark, hot):
    orders = [F.lit(1).alias(c) for c in C.ORDER_COLUMNS]
    targets = hot.select("user_id").distinct().where("user_id IS NOT NULL").select("user_id", F.col("user_id").alias("order_id"), *orders)
    plain = task_rows(spark, lambda: targets.join(hot, "user_id"))
    split = task_rows(spark, lambda: C.expand_candidates(targets, hot.where("user_id IS NOT NULL")))
    assert sum(plain) == sum(split)
    middle = split[len(split) // 2]
    assert max(plain) > 3 * plain[len(plain) // 2] and max(split) < 3 * middle


def test_few_keys_are_heavy(spark, hot, monkeypatch):
    assert [r["user_id"] for r in skew.heavy_keys(hot, "user_id").collect()] == [7]
    monkeypatch.setattr(skew, "HEAVY_ROWS", 1)
    monkeypatch.setattr(skew, "MOST_KEYS", 10)
    assert skew.heavy_keys(hot, "user_id").count() <= 10
