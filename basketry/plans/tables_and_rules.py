"""Queries: base tables, sources and sinks, integrity rules, filters, joins, set operations."""

from __future__ import annotations

import json
from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import scalars as E
from basketry.functions.positions import dense_index, ranged_position
from basketry.operators import candidates as C
from basketry.operators import explore as P
from basketry.operators import features as X
from basketry.operators import metrics as M
from basketry.operators import quality as V
from basketry.operators import recommend as R
from basketry.plans.registry import Inputs, query
from basketry.session import Buckets, scratch_path
from basketry.sources import tables as T

# Images of the departments that have one.
IMAGES = {
    "economy": "assets/economy.jpg",
    "large": "assets/large.jpg",
    "medium": "assets/medium.jpg",
    "promo": "assets/promo.jpg",
    "missing": "assets/missing.jpg",
}
# End of the fixed values.

_IMAGE_SQL = """CASE lower(trim(coalesce(department, 'missing'))) WHEN 'economy' THEN 'assets/economy.jpg' WHEN 'large' THEN 'assets/large.jpg'
  WHEN 'medium' THEN 'assets/medium.jpg' WHEN 'promo' THEN 'assets/promo.jpg' ELSE 'assets/missing.jpg' END"""


@query("s01_orders", "SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order FROM b_orders")
def _(i: Inputs):
    return i.natural.orders


@query("s01_order_products", "SELECT order_id, product_id, add_to_cart_order, reordered, eval_set FROM b_facts")
def _(i: Inputs):
    return i.natural.order_products


@query("s01_order_products_folded", "SELECT order_id, product_id, add_to_cart_order, reordered, eval_set FROM f_facts")
def _(i: Inputs):
    return i.folded.order_products


@query("s01_products", "SELECT product_id, product_name, aisle_id, department_id FROM b_products")
def _(i: Inputs):
    return i.natural.products


@query("s01_products_folded", "SELECT product_id, product_name, aisle_id, department_id FROM f_products")
def _(i: Inputs):
    return i.folded.products


@query("s01_aisles", "SELECT aisle_id, aisle FROM b_aisles")
def _(i: Inputs):
    return i.natural.aisles


@query("s01_departments", "SELECT department_id, department FROM b_departments")
def _(i: Inputs):
    return i.natural.departments


MALFORMED = 97  # one order in so many is written a second time with a value that its column can't hold


@lru_cache(maxsize=4)
def _csv_tables(i: Inputs):
    """The base tables, written as CSV with malformed lines among the orders, and loaded again with their counts."""
    folder, tables = scratch_path(i.spark, "csv"), i.natural
    lines = tables.order_products
    orders = tables.orders.select(*[F.col(c).cast("string").alias(c) for c in tables.orders.columns])
    wrong = F.when(F.pmod(F.col("order_id").cast("long"), F.lit(2 * MALFORMED)) == 0, "40000").otherwise("many")
    again = orders.where(F.pmod(F.col("order_id").cast("long"), F.lit(MALFORMED)) == 0).withColumn("order_number", wrong)
    written = {
        "orders": orders.unionByName(again),
        "order_products__prior": X.split(lines, "prior"),
        "order_products__train": X.split(lines, "train"),
        "products": tables.products,
        "aisles": tables.aisles,
        "departments": tables.departments,
    }
    for name, df in written.items():
        T.write_csv_table(df, folder, name)
    return {name: T.load_checked_csv(i.spark, folder, name) for name in written}


@query("s01_csv_orders", "SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, days_since_prior_order FROM b_orders")
def _(i: Inputs):
    table, _ = _csv_tables(i)["orders"]
    return table.where(F.col(T.CORRUPT).isNull()).drop(T.CORRUPT)


@query("s01_csv_order_products", "SELECT order_id, product_id, add_to_cart_order, reordered FROM b_facts WHERE eval_set = 'prior'")
def _(i: Inputs):
    return _csv_tables(i)["order_products__prior"][0].drop(T.CORRUPT)


@query(
    "s01_csv_counts",
    f"""SELECT 'orders' AS table_name, count(*) + count(*) FILTER (WHERE order_id % {MALFORMED} = 0) AS n_rows, count(*) FILTER (WHERE order_id % {MALFORMED} = 0) AS n_corrupt FROM b_orders
    UNION ALL SELECT 'order_products__prior', count(*), 0 FROM b_facts WHERE eval_set = 'prior'
    UNION ALL SELECT 'order_products__train', count(*), 0 FROM b_facts WHERE eval_set = 'train'
    UNION ALL SELECT 'products', count(*), 0 FROM b_products UNION ALL SELECT 'aisles', count(*), 0 FROM b_aisles
    UNION ALL SELECT 'departments', count(*), 0 FROM b_departments""",
)
def _(i: Inputs):
    return reduce(DataFrame.unionByName, [counts for _, counts in _csv_tables(i).values()])


@query(
    "s02_table_shapes",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(7 AS BIGINT) AS n_columns FROM b_orders
    UNION ALL SELECT 'order_products_prior', count(*), 4 FROM b_facts WHERE eval_set = 'prior'
    UNION ALL SELECT 'order_products_train', count(*), 4 FROM b_facts WHERE eval_set = 'train'
    UNION ALL SELECT 'products', count(*), 4 FROM b_products UNION ALL SELECT 'aisles', count(*), 2 FROM b_aisles
    UNION ALL SELECT 'departments', count(*), 2 FROM b_departments""",
)
def _(i: Inputs):
    return V.table_shapes(i.natural.as_dict())


@query("s03_pruned_scan", "SELECT order_id, product_id FROM b_lines")
def _(i: Inputs):
    return i.natural.basket_lines.select("order_id", "product_id")


@query(
    "s04_s05_candidate_files",
    """SELECT user_id, order_id, product_id, order_number, order_dow, order_hour_of_day, round(days_since_prior_order, 6) AS days_since_prior_order,
      CASE WHEN eval_set = 'train' THEN label END AS label FROM f_cand""",
)
def _(i: Inputs):
    stem = scratch_path(i.spark, "candidates")
    T.write_table(i.base("train"), f"{stem}-train.parquet")
    T.write_table(i.base("test"), f"{stem}-test.csv", "csv")
    test = T.load_preferred(i.spark, f"{stem}-test")
    return T.load_candidates(i.spark, f"{stem}-train.parquet").unionByName(test, allowMissingColumns=True)


@query("s06_similarity_aliases", "SELECT product_id, neighbor_product_id, round(score, 6) AS score, rank FROM f_edges")
def _(i: Inputs):
    renamed = i.edges(i.folded).withColumnsRenamed({"product_id": "product_id_1", "neighbor_product_id": "product_id_2", "score": "similarity_score"})
    return T.resolve_similarity(renamed)


@query("s07_json_lookup", f"SELECT department_id, department, {_IMAGE_SQL} AS image_path FROM b_departments")
def _(i: Inputs):
    path = scratch_path(i.spark, "images")
    i.spark.createDataFrame([(json.dumps(IMAGES),)], "value string").coalesce(1).write.text(path)
    images = T.load_lookup(i.spark, path)
    return i.natural.departments.withColumn("image_path", E.lookup(E.normalized_key(F.col("department")), images))


@query("s08_s09_table_sinks", "SELECT user_id, product_id, count(*) AS count FROM b_facts WHERE eval_set = 'prior' GROUP BY 1, 2")
def _(i: Inputs):
    return i.spark.read.parquet(T.write_table(X.interactions(i.prior_baskets(i.natural)), scratch_path(i.spark, "interactions")))


@query("s10_sorted_candidates", "SELECT user_id, order_id, product_id, label FROM f_cand WHERE eval_set = 'train'")
def _(i: Inputs):
    path = T.write_candidates(i.base("train"), scratch_path(i.spark, "sorted"))
    return i.spark.read.parquet(path).select("user_id", "order_id", "product_id", "label")


@query("s11_group_sizes", "SELECT order_id, count(*) AS n_candidates FROM f_cand WHERE eval_set = 'train' GROUP BY order_id")
def _(i: Inputs):
    return C.group_sizes(i.base("train"))


@query(
    "s15_export_top_k",
    """SELECT user_id, order_id, product_id, round(score, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY round(score, 9) DESC, product_id) AS rank FROM f_scored WHERE eval_set = 'test'
        AND user_id = (SELECT user_id FROM f_scored WHERE eval_set = 'test' GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)) WHERE rank <= 10""",
)
def _(i: Inputs):
    # The user with most candidates; the export itself is a point filter on user and order.
    scored = i.scored("test")
    busiest = scored.groupBy("user_id", "order_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "user_id").limit(1)
    one = scored.where(
        (F.col("user_id") == busiest.select("user_id").scalar()) & (F.col("order_id") == busiest.select("order_id").scalar())
    )
    top = M.top_k_per_group(one, ["order_id"], [F.round("score", 9).desc(), F.col("product_id")], 10)
    path = T.write_table(top.select("user_id", "order_id", "product_id", "score", "rank"), scratch_path(i.spark, "export"), "csv")
    return i.spark.read.schema("user_id bigint, order_id bigint, product_id bigint, score double, rank bigint").option("header", True).csv(path)


@query(
    "v01_orphan_orders",
    """SELECT 'all' AS eval_set, count(*) AS n_rows, count(*) FILTER (WHERE o.o_orderkey IS NULL) AS n_orphans
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""",
)
def _(i: Inputs):
    lines = i.natural._scan("lineitem").select(F.col("l_orderkey").alias("order_id"), F.lit("all").alias("eval_set"))
    return V.orphan_counts(lines, i.natural.orders, "order_id")


@query(
    "v02_orphan_products",
    """SELECT eval_set, count(*) AS n_rows, count(*) FILTER (WHERE p.product_id IS NULL) AS n_orphans
    FROM b_facts f LEFT JOIN b_products p ON p.product_id = f.product_id GROUP BY 1""",
)
def _(i: Inputs):
    return V.orphan_counts(i.natural.baskets, i.natural.products, "product_id")


@query(
    "v03_first_order_gap",
    """SELECT count(*) AS n_orders, count(*) FILTER (WHERE order_number = 1) AS n_first_orders,
      count(*) FILTER (WHERE order_number = 1 AND days_since_prior_order IS NOT NULL) AS n_first_with_gap,
      count(*) FILTER (WHERE order_number <> 1 AND days_since_prior_order IS NULL) AS n_later_without_gap FROM b_orders""",
)
def _(i: Inputs):
    return V.first_order_gap_violations(i.natural.orders)


@query(
    "v04_key_types",
    "SELECT user_id, count(*) AS n, CAST(min(order_id) AS BIGINT) AS first_order FROM b_orders GROUP BY 1",
)
def _(i: Inputs):
    narrow = i.natural.orders.select(F.col("order_id").cast("string").alias("order_id"), F.col("user_id").cast("string").alias("user_id"))
    keyed = V.with_bigint_keys(narrow, ["order_id", "user_id", "product_id"])
    return keyed.groupBy("user_id").agg(F.count("*").alias("n"), F.min("order_id").alias("first_order"))


@query("v05_duplicate_keys", "SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(i: Inputs):
    lines = i.natural._scan("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"))
    return V.duplicate_keys(lines, ["order_id", "line_number"])


@query(
    "v05_candidate_keys_unique",
    "SELECT user_id, order_id, product_id, count(*) AS n FROM f_cand WHERE eval_set = 'train' GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def _(i: Inputs):
    return V.duplicate_keys(i.base("train"), C.ID_COLUMNS)


@query("v06_users_with_many_orders", "SELECT user_id, count(DISTINCT order_id) AS n_orders FROM b_facts GROUP BY 1 HAVING count(DISTINCT order_id) > 1")
def _(i: Inputs):
    return V.users_with_many_orders(i.natural.baskets)


@query(
    "v07_label_domain",
    "SELECT count(*) AS n_rows, count(*) FILTER (WHERE label IS NULL OR label NOT IN (0, 1)) AS n_bad_labels FROM f_cand WHERE eval_set = 'train'",
)
def _(i: Inputs):
    return V.label_domain(i.base("train"))


@query("v08_required_columns", "SELECT column_name FROM (VALUES ('order_number'), ('order_dow'), ('order_hour_of_day'), ('days_since_prior_order')) t(column_name), (SELECT count(*) AS n FROM f_cand) c WHERE c.n > 0")
def _(i: Inputs):
    base = V.require_columns(i.base("train"), [*C.ID_COLUMNS, "label"], "candidates")
    names = V.require_features(V.numeric_features(base))
    seen = base.agg(F.count("*").alias("n")).where("n > 0")
    return seen.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("column_name"))


@query(
    "v09_id_overlap",
    """SELECT (SELECT count(DISTINCT product_id) FROM b_facts WHERE eval_set = 'prior') AS n_left, (SELECT count(DISTINCT product_id) FROM b_products) AS n_right,
    (SELECT count(*) FROM (SELECT product_id FROM b_facts WHERE eval_set = 'prior' INTERSECT SELECT product_id FROM b_products)) AS n_shared""",
)
def _(i: Inputs):
    return V.id_overlap(i.prior_baskets(i.natural), i.natural.products, "product_id")


_TABLE_COLUMNS = {
    "orders": ("b_orders", ["order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]),
    "order_products": ("b_facts", ["order_id", "product_id", "add_to_cart_order", "reordered", "eval_set"]),
    "products": ("b_products", ["product_id", "product_name", "aisle_id", "department_id"]),
}


@query(
    "v10_null_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM {block}"
        for t, (block, cs) in _TABLE_COLUMNS.items()
        for c in cs
    ),
)
def _(i: Inputs):
    t = i.natural
    return V.null_counts({"orders": t.orders, "order_products": t.order_products, "products": t.products})


@query(
    "v11_pairs_with_factors",
    """SELECT count(*) AS n_total, count(*) FILTER (WHERE user_id IN (SELECT user_id FROM b_facts WHERE eval_set = 'prior')
      AND product_id IN (SELECT product_id FROM b_facts WHERE eval_set = 'prior')) AS n_kept FROM b_facts""",
)
def _(i: Inputs):
    prior = i.prior_baskets(i.natural)
    return V.pairs_with_factors(i.natural.baskets, prior.select("user_id"), prior.select("product_id"))


@query(
    "f01_split_orders",
    "SELECT eval_set, count(*) AS n_orders, count(DISTINCT user_id) AS n_users FROM b_orders GROUP BY 1",
)
def _(i: Inputs):
    parts = [X.split(i.natural.orders, s).groupBy("eval_set").agg(F.count("*").alias("n_orders"), F.countDistinct("user_id").alias("n_users")) for s in ("prior", "train", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f02_feature_projection", "SELECT order_number, order_dow, order_hour_of_day, days_since_prior_order FROM f_cand WHERE eval_set = 'train'")
def _(i: Inputs):
    base = i.base("train")
    return base.select(*V.numeric_features(base))


@query(
    "f03_membership_keep",
    "SELECT order_id, user_id FROM b_orders WHERE user_id IN (SELECT user_id FROM b_orders WHERE eval_set = 'test')",
)
def _(i: Inputs):
    users = X.split(i.natural.orders, "test").select("user_id")
    return i.natural.orders.select("order_id", "user_id").join(users, "user_id", "left_semi").select("order_id", "user_id")


@query(
    "f04_membership_exclude",
    """SELECT user_id, product_id FROM f_scored c WHERE eval_set = 'train'
    AND NOT EXISTS (SELECT 1 FROM f_carts k WHERE k.cart_id = c.order_id AND k.product_id = c.product_id)""",
)
def _(i: Inputs):
    carts = i.carts(i.folded).withColumnRenamed("cart_id", "order_id")
    return R.without(i.scored("train"), carts, keys=("order_id", "product_id")).select("user_id", "product_id")


@query(
    "f05_point_filter",
    """SELECT user_id, order_id, order_number FROM b_orders WHERE user_id = (SELECT user_id FROM b_orders GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)
    AND order_id = (SELECT max(order_id) FROM b_orders WHERE user_id = (SELECT user_id FROM b_orders GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1))""",
)
def _(i: Inputs):
    per_user = i.natural.orders.groupBy("user_id").agg(F.count("*").alias("n"), F.max("order_id").alias("order_id"))
    busiest = per_user.orderBy(F.col("n").desc(), "user_id").limit(1)
    keep = (F.col("user_id") == busiest.select("user_id").scalar()) & (F.col("order_id") == busiest.select("order_id").scalar())
    return i.natural.orders.where(keep).select("user_id", "order_id", "order_number")


@query("f06_department_aisle_filter", "SELECT product_id, product_name, department, aisle_id FROM b_catalog WHERE department = 'PROMO' AND aisle_id IN (3, 7, 11)")
def _(i: Inputs):
    catalog = i.catalog(i.natural).where((F.col("department") == "PROMO") & F.col("aisle_id").isin(3, 7, 11))
    return catalog.select("product_id", "product_name", "department", "aisle_id")


@query("f07_title_search", "SELECT product_id, product_name AS title FROM b_catalog WHERE regexp_matches(product_name, '(?i)RED|gear')")
def _(i: Inputs):
    return R.search_catalog(R.clean_catalog(i.catalog(i.natural)), "RED|gear").select("product_id", "title")


@query("f07_title_search_literal", "SELECT product_id, product_name AS title FROM b_catalog WHERE contains(lower(product_name), 'widget')")
def _(i: Inputs):
    return R.search_catalog(R.clean_catalog(i.catalog(i.natural)), "Widget", literal=True).select("product_id", "title")


@query("f08_drop_nulls", "SELECT order_id, days_since_prior_order FROM b_orders WHERE days_since_prior_order IS NOT NULL")
def _(i: Inputs):
    return i.natural.orders.dropna(subset=["days_since_prior_order"]).select("order_id", "days_since_prior_order")


@query(
    "f10_f11_fill_missing",
    """SELECT order_id, order_number, order_dow, order_hour_of_day, coalesce(days_since_prior_order, 0.0) AS days_since_prior_order FROM f_cand WHERE eval_set = 'test'""",
)
def _(i: Inputs):
    base = i.base("test")
    numeric = V.numeric_features(base)
    return base.na.fill(0, numeric).withColumn("order_dow", F.col("order_dow").cast("tinyint")).select("order_id", *numeric)


@query("f12_rename_and_order", "SELECT product_id AS id, 'demo' AS source, product_name AS title FROM b_products")
def _(i: Inputs):
    named = i.natural.products.withColumnsRenamed({"product_id": "id", "product_name": "title"})
    return named.withColumn("source", F.lit("demo")).select("id", "source", "title")


_DEMO = "SELECT user_id FROM b_orders WHERE eval_set = 'test' UNION SELECT max(user_id) + 1 FROM b_orders"


@query(
    "f14_demo_subset",
    f"""SELECT (SELECT count(*) FROM ({_DEMO})) AS n_wanted, count(DISTINCT f.user_id) FILTER (WHERE d.user_id IS NOT NULL) AS n_found,
      (SELECT count(*) FROM ({_DEMO})) - count(DISTINCT f.user_id) FILTER (WHERE d.user_id IS NOT NULL) AS n_missing,
      count(*) AS n_rows, count(d.user_id) AS n_kept, round(100.0 * (1 - count(d.user_id)::DOUBLE / count(*)), 6) AS reduction_pct,
      round(count(d.user_id)::DOUBLE / count(DISTINCT f.user_id) FILTER (WHERE d.user_id IS NOT NULL), 6) AS rows_per_user
    FROM b_facts f LEFT JOIN ({_DEMO}) d ON d.user_id = f.user_id""",
)
def _(i: Inputs):
    orders = i.natural.orders
    unknown = orders.agg((F.max("user_id") + 1).alias("user_id"))
    return P.subset_statistics(i.natural.baskets, X.split(orders, "test").select("user_id").unionByName(unknown))


@query(
    "j01_lines_with_order",
    """SELECT order_id, product_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order FROM b_facts WHERE eval_set IN ('prior', 'train')""",
)
def _(i: Inputs):
    orders = i.natural.orders
    joined = X.attach_order(i.natural.basket_lines.select("order_id", "product_id"), orders)
    return joined.where("eval_set in ('prior', 'train')").drop("eval_set")


@query("j02_prior_lines_with_user", "SELECT order_id, product_id, user_id FROM b_facts WHERE eval_set = 'prior'")
def _(i: Inputs):
    prior = X.split(i.natural.orders, "prior").select("order_id", "user_id")
    return X.attach_order(i.natural.basket_lines.select("order_id", "product_id"), prior, "inner")


@query("j03_expand_candidates", "SELECT user_id, order_id, product_id, order_number FROM f_cand WHERE eval_set = 'test'")
def _(i: Inputs):
    return i.base("test").select("user_id", "order_id", "product_id", "order_number")


@query("j04_attach_label", "SELECT user_id, order_id, product_id, label FROM f_cand WHERE eval_set = 'train'")
def _(i: Inputs):
    return i.base("train").select("user_id", "order_id", "product_id", "label")


@query(
    "j05_attach_similarity",
    """SELECT c.user_id, c.order_id, c.product_id, round(coalesce(als_score, 0.0), 6) AS als_score, round(coalesce(sim_max, 0.0), 6) AS sim_max,
      round(coalesce(sim_mean, 0.0), 6) AS sim_mean, round(coalesce(sim_topk_mean_10, 0.0), 6) AS sim_topk_mean_10, coalesce(sim_nonzero_cnt, 0) AS sim_nonzero_cnt
    FROM f_cand c LEFT JOIN f_scores s ON s.user_id = c.user_id AND s.product_id = c.product_id WHERE eval_set = 'test'""",
)
def _(i: Inputs):
    return C.attach_similarity(i.base("test"), i.written_pair_scores).select(*C.ID_COLUMNS, *C.SIMILARITY_COLUMNS)


@query(
    "s10_j05_bucketed_similarity",
    """SELECT c.user_id, c.order_id, c.product_id, round(coalesce(als_score, 0.0), 6) AS als_score, round(coalesce(sim_max, 0.0), 6) AS sim_max,
      round(coalesce(sim_mean, 0.0), 6) AS sim_mean, round(coalesce(sim_topk_mean_10, 0.0), 6) AS sim_topk_mean_10, coalesce(sim_nonzero_cnt, 0) AS sim_nonzero_cnt
    FROM f_cand c LEFT JOIN f_scores s ON s.user_id = c.user_id AND s.product_id = c.product_id WHERE eval_set = 'train'""",
)
def _(i: Inputs):
    """Candidates and pair scores as tables bucketed and sorted by user and product: joining them moves no row."""
    layout = Buckets(i.spark, ["user_id", "product_id"], int(i.spark.conf.get("spark.sql.shuffle.partitions")))
    candidates = layout.write(i.base("train").select(*C.ID_COLUMNS), "candidates")
    scores = layout.write(i.written_pair_scores, "pair-scores")
    return C.attach_similarity(candidates, scores).select(*C.ID_COLUMNS, *C.SIMILARITY_COLUMNS)


_ROUNDED = {
    "days_since_prior_order", "als_score", "sim_max", "sim_mean", "sim_topk_mean_10", "u_avg_basket_size", "u_reorder_ratio", "u_mean_days_between",
    "u_std_days_between", "p_avg_add_to_cart", "p_reorder_prob", "up_avg_add_to_cart", "up_rate_in_user_history",
}


def full_columns(names) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in _ROUNDED else c for c in names)


@query("j06_train_candidates", f"SELECT {full_columns([*C.ID_COLUMNS, 'label', *C.FEATURE_COLUMNS])} FROM f_full WHERE eval_set = 'train'")
def _(i: Inputs):
    return i.full("train")


@query("j06_test_candidates", f"SELECT {full_columns([*C.ID_COLUMNS, *C.FEATURE_COLUMNS])} FROM f_full WHERE eval_set = 'test'")
def _(i: Inputs):
    return i.full("test")


@query(
    "j07_scalar_lookup",
    "SELECT order_id, product_id, days_since_prior_order FROM b_facts",
)
def _(i: Inputs):
    gaps = i.natural.orders.select("order_id", "days_since_prior_order")
    return i.natural.basket_lines.select("order_id", "product_id").join(gaps, "order_id", "left")


@query(
    "j08_w04_dense_indexes",
    """SELECT user_id, product_id, dense_rank() OVER (ORDER BY user_id) - 1 AS user_index, dense_rank() OVER (ORDER BY product_id) - 1 AS product_index, count(*) AS count
    FROM b_facts WHERE eval_set = 'prior' GROUP BY user_id, product_id""",
)
def _(i: Inputs):
    pairs = X.interactions(i.prior_baskets(i.natural))
    users, products = dense_index(pairs, "user_id", "user_index"), dense_index(pairs, "product_id", "product_index")
    return pairs.join(users, "user_id").join(products, "product_id")


@query(
    "j12_dimension_chain",
    """SELECT l.order_id, l.product_id, p.product_name, a.aisle, d.department FROM b_lines l LEFT JOIN b_products p ON p.product_id = l.product_id
    LEFT JOIN b_aisles a ON a.aisle_id = p.aisle_id LEFT JOIN b_departments d ON d.department_id = p.department_id""",
)
def _(i: Inputs):
    t = i.natural
    names = t.products.join(t.aisles, "aisle_id", "left").join(t.departments, "department_id", "left")
    joined = t.basket_lines.join(names, "product_id", "left")
    return joined.select("order_id", "product_id", "product_name", "aisle", "department")


@query(
    "j13_attach_catalog",
    """SELECT c.user_id, c.order_id, c.product_id, k.product_name, k.department FROM f_cand c LEFT JOIN f_catalog k ON k.product_id = c.product_id WHERE eval_set = 'test'""",
)
def _(i: Inputs):
    catalog = i.catalog(i.folded)
    twice = catalog.unionByName(catalog)
    return R.with_catalog(i.base("test"), twice).select(*C.ID_COLUMNS, "product_name", "department")


@query(
    "j15_restrict_catalog",
    "SELECT product_id, product_name FROM b_products WHERE product_id IN (SELECT neighbor_product_id FROM b_edges)",
)
def _(i: Inputs):
    wanted = i.edges(i.natural).select(F.col("neighbor_product_id").alias("product_id"))
    return i.natural.products.join(wanted, "product_id", "left_semi").select("product_id", "product_name")


@query("u01_concatenate", "SELECT order_id, product_id, eval_set FROM b_facts WHERE eval_set = 'prior' UNION ALL SELECT order_id, product_id, eval_set FROM b_facts WHERE eval_set = 'train'")
def _(i: Inputs):
    b = i.natural.baskets.select("order_id", "product_id", "eval_set")
    return X.split(b, "prior").unionByName(X.split(b, "train"))


@query("u02_intersection", "SELECT product_id FROM b_facts WHERE eval_set = 'prior' INTERSECT SELECT product_id FROM b_facts WHERE eval_set = 'test'")
def _(i: Inputs):
    b = i.natural.baskets
    return X.split(b, "prior").select("product_id").intersect(X.split(b, "test").select("product_id"))


@query("u03_difference", "SELECT product_id FROM b_facts WHERE eval_set = 'prior' EXCEPT SELECT product_id FROM b_facts WHERE eval_set = 'test'")
def _(i: Inputs):
    b = i.natural.baskets
    return X.split(b, "prior").select("product_id").subtract(X.split(b, "test").select("product_id"))


@query("u04_distinct", "SELECT DISTINCT user_id, product_id FROM b_facts")
def _(i: Inputs):
    return X.history_pairs(i.natural.baskets)


@query(
    "l01_mixed_sort",
    "SELECT user_id, product_id, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, user_id, product_id) AS place FROM f_facts WHERE eval_set = 'prior' GROUP BY 1, 2",
)
def _(i: Inputs):
    pairs = X.interactions(i.prior_baskets(i.folded))
    order = [F.col("count").desc(), F.col("user_id"), F.col("product_id")]
    return ranged_position(pairs, [], order, "place").orderBy(*order)


@query("l02_global_top", "SELECT user_id, product_id, round(score, 6) AS score FROM f_scored WHERE eval_set = 'test' ORDER BY round(f_scored.score, 9) DESC, user_id, product_id LIMIT 25")
def _(i: Inputs):
    top = i.scored("test").orderBy(F.round("score", 9).desc(), "user_id", "product_id").limit(25)
    return top.select("user_id", "product_id", "score")


@query("l03_head", "SELECT product_id, product_name FROM b_products ORDER BY product_id LIMIT 20")
def _(i: Inputs):
    return i.natural.products.orderBy("product_id").limit(20).select("product_id", "product_name")


@query(
    "l04_catalog_page",
    """SELECT product_id, title, page, n_pages FROM (
      SELECT product_id, product_name AS title, row_number() OVER (ORDER BY product_id) AS place, n_pages, CASE WHEN n_pages >= 2 THEN 2 ELSE 1 END AS page
      FROM b_catalog, (SELECT CAST(greatest(1, ceil(count(*) / 50.0)) AS BIGINT) AS n_pages FROM b_catalog WHERE department = 'SMALL') WHERE department = 'SMALL')
    WHERE place > 50 * (page - 1) AND place <= 50 * page""",
)
def _(i: Inputs):
    small = R.clean_catalog(i.catalog(i.natural)).where("department = 'small'")
    rows, page, pages = R.page_of(small, [F.col("product_id")], 2)
    return rows.select("product_id", "title", F.lit(page).cast("bigint").alias("page"), F.lit(pages).cast("bigint").alias("n_pages"))


@query("l05_newest_first", "SELECT user_id, order_id, row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC) AS place FROM b_orders")
def _(i: Inputs):
    last = i.natural.orders.groupBy("user_id").agg(F.max("order_number").alias("n"))
    return i.natural.orders.join(last, "user_id").select("user_id", "order_id", (F.col("n") - F.col("order_number") + 1).alias("place"))


@query("l05_distinct_sorted", "SELECT DISTINCT department, aisle_id FROM b_catalog ORDER BY 1, 2")
def _(i: Inputs):
    return i.catalog(i.natural).select("department", "aisle_id").distinct().orderBy("department", "aisle_id")


@query(
    "w07_order_sequence",
    "SELECT user_id, order_id, order_number, days_since_prior_order, CASE WHEN eval_set <> 'prior' THEN 1 ELSE 0 END AS is_target FROM b_orders",
)
def _(i: Inputs):
    return i.natural.orders.select("user_id", "order_id", "order_number", "days_since_prior_order", (F.col("eval_set") != "prior").alias("is_target"))
