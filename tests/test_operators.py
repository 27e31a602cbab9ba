"""Similarity, features, recommendation lists, sources and sinks on small made tables."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from basketry import load_star
from basketry.operators import explore as P
from basketry.operators import features as X
from basketry.operators import quality as V
from basketry.operators import recommend as R
from basketry.operators import similarity as S
from basketry.session import scratch_path
from basketry.sources import star
from basketry.sources import tables as T


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def brute_pairs(baskets):
    counts = {}
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            counts[a, b] = counts.get((a, b), 0) + 1
    return sorted((a, b, n) for (a, b), n in counts.items())


def as_baskets(spark, baskets):
    return spark.createDataFrame([(o, p) for o, items in baskets.items() for p in items], "order_id long, product_id long")


def test_cosine_golden(spark):
    baskets = as_baskets(spark, {1: [1, 2], 2: [1, 2], 3: [1], 4: [2, 3]})
    got = {(a, b): s for a, b, s in rows(S.cosine_scores(S.co_purchases(baskets), S.product_support(baskets)), "product_id", "neighbor_product_id", "score")}
    assert got == pytest.approx({(1, 2): 2 / 3, (2, 1): 2 / 3, (2, 3): 1 / math.sqrt(3), (3, 2): 1 / math.sqrt(3)})


@pytest.mark.parametrize("pair_limit", [2, 5, 64])
def test_large_orders_are_counted_exactly(spark, pair_limit):
    """One order holds a third of all rows and spans several blocks of ids."""
    rng = random.Random(4)
    baskets = {o: rng.sample(range(1500), rng.randint(1, 9)) for o in range(60)}
    baskets[99] = rng.sample(range(1500), 150)
    assert rows(S.co_purchases(as_baskets(spark, baskets), pair_limit=pair_limit), "product_a", "product_b", "n_both") == brute_pairs(baskets)


def test_neighbor_ranks(spark):
    rng = random.Random(5)
    baskets = {o: rng.sample(range(30), rng.randint(2, 6)) for o in range(80)}
    support = {}
    for items in baskets.values():
        for p in items:
            support[p] = support.get(p, 0) + 1
    both = {(a, b): n for a, b, n in brute_pairs(baskets)}
    want = []
    for p in support:
        near = [(both.get((min(p, q), max(p, q)), 0), q) for q in support if q != p]
        near = sorted([(-n * n / support[q], q) for n, q in near if n])[:10]
        want += [(p, q, i + 1) for i, (_, q) in enumerate(near)]
    assert rows(S.top_neighbors(as_baskets(spark, baskets)), "product_id", "neighbor_product_id", "rank") == sorted(want)


@pytest.mark.parametrize("hot", [S.HOT_ORDERS, 1])
def test_neighbors_of_lists_equal_those_of_pairs(spark, hot, monkeypatch):
    """Lists in place of pairs: the same neighbors, also of hot products and of baskets that repeat a product, without a join or a table of pairs."""
    monkeypatch.setattr(S, "HOT_ORDERS", hot)
    rng = random.Random(5)
    lines = [(o, p) for o in range(300) for p in rng.choices(range(40), k=rng.randint(1, 8))] + [(1, None), (2, None)]
    baskets = spark.createDataFrame(lines, "order_id long, product_id long")
    columns = ("product_id", "neighbor_product_id", "rank", "score")
    packed = S.top_neighbors(baskets, largest=9)
    assert rows(packed, *columns) == rows(S.top_neighbors(baskets), *columns)
    support = spark.createDataFrame(S.product_support(baskets).collect(), "product_id long, n_orders long")
    plan = S._top_of_lists(baskets, support, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == (1 if hot > 1 else 2)


def test_pair_similarity_equals_literal_expansion(spark):
    rng = random.Random(6)
    history = [(u, p) for u in range(12) for p in rng.sample(range(40), 14)]
    edges = {(a, b): rng.random() for a in range(40) for b in rng.sample(range(40), 10) if a != b}
    h = spark.createDataFrame(history, "user_id long, product_id long")
    e = spark.createDataFrame([(a, b, s) for (a, b), s in edges.items()], "product_id long, neighbor_product_id long, score double")
    got = {(r.user_id, r.product_id): (r.sim_max, r.sim_mean, r.sim_topk_mean_10, r.sim_nonzero_cnt) for r in S.pair_similarity(h, h, e).collect()}
    for u, p in history:
        found = sorted((edges[q, p] for v, q in history if v == u and (q, p) in edges), reverse=True)
        want = (found[0], sum(found) / len(found), sum(found[:10]) / len(found[:10]), len(found)) if found else (0, 0, 0, 0)
        assert got[u, p] == pytest.approx(want)


def test_neighbors_that_are_no_candidates_are_not_moved(spark):
    """Every candidate has its mark; few others do, so that few of the reached products are shuffled."""
    pairs = spark.range(3000).select((F.col("id") % 100).alias("user_id"), (F.col("id") * 7919 % 5003 - 9).alias("product_id"))
    word, bit = S._word_and_bit("product_id")
    marks = S.candidate_marks(pairs)
    hit = F.get("marks", word).bitwiseAND(bit) != 0
    assert pairs.join(marks, "user_id").where(~hit).isEmpty()
    others = spark.range(10_000, 20_000).withColumnRenamed("id", "product_id").crossJoin(marks)
    assert others.where(hit).count() < 0.2 * others.count()


def test_more_than_ten_edges_use_the_best_ten(spark):
    h = spark.createDataFrame([(1, p) for p in range(13)], "user_id long, product_id long")
    e = spark.createDataFrame([(p, 0, p / 20) for p in range(1, 13)], "product_id long, neighbor_product_id long, score double")
    got = S.pair_similarity(h, h, e).where("product_id = 0").first()
    assert got.sim_topk_mean_10 == pytest.approx(sum(p / 20 for p in range(3, 13)) / 10) and got.sim_nonzero_cnt == 12


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_adapter_paths_agree(spark, data, limit, monkeypatch):
    """The paths for small and for large groups give the same tables."""
    monkeypatch.setattr(star, "GROUP_LIMIT", limit)
    import basketry.functions.positions as positions

    monkeypatch.setattr(positions, "GROUP_LIMIT", limit)
    facts = load_star(spark, data, 100).line_facts
    got = facts.agg(*[F.sum(F.xxhash64(*facts.columns) % 1_000_003).alias("h"), F.count("*").alias("n")]).first()
    staged = load_star(spark, data, 100, staged=True).line_facts.select(*facts.columns)
    assert got == staged.agg(F.sum(F.xxhash64(*facts.columns) % 1_000_003).alias("h"), F.count("*").alias("n")).first()


def test_history_of_candidates(spark, data):
    t = load_star(spark, data, 100)
    lines = X.split(t.line_facts, "prior")
    totals = X.pair_totals(lines)
    for build in (X.user_features, X.product_features, X.pair_features):
        assert rows(build(lines), *build(lines).columns) == rows(build(lines, totals=totals), *build(lines).columns)


@pytest.fixture
def shop(spark):
    catalog = spark.createDataFrame([(p, f"Item {p}", "ABC"[p % 3], p % 2) for p in range(30)], "product_id long, product_name string, department string, aisle_id long")
    carts = spark.createDataFrame([(1, 0), (1, 3), (1, 1), (2, 5)], "cart_id long, product_id long")
    return catalog, carts


def test_fallbacks(spark, shop):
    catalog, carts = shop
    every = spark.createDataFrame([(1,), (2,), (3,)], "cart_id long")
    got = rows(R.fallback_by_cart_departments(carts, catalog, 3, every), "cart_id", "rank", "product_id")
    assert got == [(1, 1, 4), (1, 2, 6), (1, 3, 7), (2, 1, 2), (2, 2, 8), (2, 3, 11), (3, 1, 0), (3, 2, 1), (3, 3, 2)]
    popular = rows(R.fallback_by_popular_departments(carts, catalog, 3), "cart_id", "rank", "product_id")
    assert popular == [(1, 1, 6), (1, 2, 9), (1, 3, 12), (2, 1, 0), (2, 2, 3), (2, 3, 6)]
    same = rows(R.fallback_same_department(spark.createDataFrame([(1, 0), (2, 2)], "cart_id long, product_id long"), carts, catalog, 2), "cart_id", "product_id", "rank", "similar_product_id")
    assert same == [(1, 0, 1, 6), (1, 0, 2, 9), (2, 2, 1, 8), (2, 2, 2, 11)]


def test_large_cart_fallback(spark):
    """A cart with thousands of products still gets its list."""
    catalog = spark.range(5000).select(F.col("id").alias("product_id"), F.lit("A").alias("department"))
    carts = spark.range(3000).select(F.lit(1).cast("long").alias("cart_id"), F.col("id").alias("product_id"))
    assert rows(R.fallback_by_cart_departments(carts, catalog, 2), "rank", "product_id") == [(1, 3000), (2, 3001)]


def test_blended_lists_do_not_repeat(spark):
    def a_list(*items):
        return spark.createDataFrame([(1, p, 1.0 / (i + 1), i + 1) for i, p in enumerate(items)], "user_id long, product_id long, score double, rank long")

    got = rows(R.blended([("a", a_list(1, 2, 3), 2), ("b", a_list(2, 4, 5), 2), ("c", a_list(1, 4, 3, 9), 3)]), "source", "rank", "product_id")
    assert got == [("a", 1, 1), ("a", 2, 2), ("b", 1, 4), ("b", 2, 5), ("c", 1, 3), ("c", 2, 9)]


def test_recent_ties_sort_ids_as_text(spark):
    edges = spark.createDataFrame([(1, 10, 0.5), (1, 9, 0.5), (1, 2, 0.4), (2, 2, 0.4), (2, 10, 0.1)], "product_id long, neighbor_product_id long, score double")
    recent = spark.createDataFrame([(7, 1)], "user_id long, product_id long")
    assert rows(R.neighbors_of_recent(recent, edges, 3), "rank", "product_id") == [(1, 10), (2, 9), (3, 2)]
    with pytest.raises(ValueError):
        R.neighbors_of_recent(recent, edges, agg="min")


def test_catalog_search_and_pages(spark, shop):
    catalog, _ = shop
    cleaned = R.clean_catalog(catalog.unionByName(spark.createDataFrame([(99, None, None, None)], catalog.schema)))
    assert cleaned.where("product_id = 99").first().department == "missing"
    assert cleaned.where("product_id = 99").first().title == "Product 99"
    assert R.search_catalog(cleaned, "ITEM 2").count() == 11
    assert R.search_catalog(cleaned, "item .").count() == 30 and R.search_catalog(cleaned, "item .", literal=True).count() == 0
    page, number, pages = R.page_of(cleaned, [F.col("product_id")], 4, 10)
    assert (number, pages, [r.product_id for r in page.collect()]) == (4, 4, [99])
    assert R.page_of(cleaned, [F.col("product_id")], 9, 10)[1] == 1


def test_typed_csv_tables(spark, data):
    folder = scratch_path(spark, "csv")
    tables = load_star(spark, data, 100).as_dict()
    for ours, name in zip(tables, T.CSV_TABLES):
        T.write_table(tables[ours], f"{folder}/{name}.csv", "csv")
    loaded = T.load_csv_tables(spark, folder)
    assert loaded["orders"].schema["order_number"].dataType.simpleString() == "smallint"
    assert rows(P.cardinalities(load_star(spark, data, 100).baskets, loaded["products"]), "column_name", "n_distinct")
    for ours, name in zip(tables, T.CSV_TABLES):
        assert loaded[name].count() == tables[ours].count()
        assert loaded[name].exceptAll(tables[ours].select(*[F.col(f.name).cast(f.dataType) for f in loaded[name].schema])).count() == 0


def test_sources_refuse_bad_tables(spark):
    df = spark.createDataFrame([(1, 2)], "product_id long, other long")
    with pytest.raises(V.SchemaError):
        T.resolve_similarity(df)
    with pytest.raises(V.SchemaError):
        V.require_columns(df, ["user_id"])
    with pytest.raises(V.SchemaError):
        V.require_features([])
    with pytest.raises(FileNotFoundError):
        T.load_preferred(spark, scratch_path(spark, "none"))
    with pytest.raises(ValueError):
        T.load_candidates(spark, [])


def test_sorted_sink_and_group_sizes(spark):
    df = spark.createDataFrame([(u, 10 * u, p) for u in range(20) for p in (3, 1, 2)], "user_id long, order_id long, product_id long")
    back = spark.read.parquet(T.write_candidates(df, scratch_path(spark, "sorted"), 4))
    parts = back.withColumn("f", F.input_file_name()).groupBy("user_id").agg(F.countDistinct("f").alias("n"))
    assert back.count() == 60 and parts.where("n > 1").count() == 0
    from basketry.operators.candidates import group_sizes

    path = T.write_group_sizes(group_sizes(df), scratch_path(spark, "sizes"))
    assert [r.value for r in spark.read.text(path).collect()] == ["3"] * 20
    with pytest.raises(Exception, match="(?i)exists"):
        T.write_table(df, path)


def test_integrity_rules(spark):
    orders = spark.createDataFrame([(1, 1, 1, 5.0), (2, 1, 2, None), (3, 2, 1, None)], "order_id long, user_id long, order_number long, days_since_prior_order double")
    got = V.first_order_gap_violations(orders).first()
    assert (got.n_first_with_gap, got.n_later_without_gap) == (1, 1)
    lines = spark.createDataFrame([(1, "prior"), (9, "prior"), (3, "train")], "order_id long, eval_set string")
    assert rows(V.orphan_counts(lines, orders, "order_id"), "eval_set", "n_rows", "n_orphans") == [("prior", 2, 1), ("train", 1, 0)]
    labels = spark.createDataFrame([(0,), (1,), (2,), (None,)], "label long")
    assert V.label_domain(labels).first().n_bad_labels == 2
