"""Queries: features, profiles, distributions, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import scalars as E
from basketry.functions.positions import running_totals
from basketry.operators import explore as P
from basketry.operators import features as X
from basketry.operators import metrics as M
from basketry.operators import recommend as R
from basketry.operators.preprocess import median_filled
from basketry.plans.registry import Inputs, query
from basketry.plans.tables_and_rules import full_columns

PRIOR = "b_facts WHERE eval_set = 'prior'"


@query(
    "a01_a07_user_features",
    f"SELECT {full_columns(['user_id', *X.USER_FEATURES])} FROM f_user",
)
def _(i: Inputs):
    return X.user_features(i.prior(i.folded))


@query(
    "a06_user_gaps_order_grain",
    """SELECT user_id, round(avg(days_since_prior_order), 6) AS u_mean_days_between, round(stddev_samp(days_since_prior_order), 6) AS u_std_days_between
    FROM (SELECT DISTINCT user_id, order_id, days_since_prior_order FROM f_facts WHERE eval_set = 'prior') GROUP BY 1""",
)
def _(i: Inputs):
    return X.user_features(i.prior(i.folded), order_grain=True).select("user_id", "u_mean_days_between", "u_std_days_between")


@query("a08_product_features", f"SELECT {full_columns(['product_id', *X.PRODUCT_FEATURES])} FROM f_product")
def _(i: Inputs):
    return X.product_features(i.prior(i.folded))


@query("a09_a11_user_product_features", f"SELECT {full_columns(['user_id', 'product_id', *X.PAIR_FEATURES])} FROM f_pair")
def _(i: Inputs):
    return X.pair_features(i.prior(i.folded))


@query(
    "a12_history_lists",
    """SELECT user_id, CAST(0 AS BIGINT) AS list_no, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS products, count(*) AS n
    FROM (SELECT DISTINCT user_id, product_id FROM f_facts WHERE eval_set = 'prior') GROUP BY 1""",
)
def _(i: Inputs):
    lists = X.history_lists(i.prior_baskets(i.folded))
    return lists.select("user_id", "list_no", F.array_join(F.transform("products", lambda p: p.cast("string")), ",").alias("products"), F.size("products").alias("n"))


@query(
    "a13_collapse_duplicates",
    """SELECT user_id, product_id, round(avg(s), 6) AS als_score, round(max(s), 6) AS sim_max, round(avg(s), 6) AS sim_mean,
      round(avg(s), 6) AS sim_topk_mean_10, count(*) AS sim_nonzero_cnt FROM (SELECT user_id, product_id, 1.0 / add_to_cart_order AS s FROM f_facts) GROUP BY 1, 2""",
)
def _(i: Inputs):
    s = 1.0 / F.col("add_to_cart_order")
    rows = i.folded.line_facts.select("user_id", "product_id", *[s.alias(c) for c in ("als_score", "sim_max", "sim_mean", "sim_topk_mean_10")], F.lit(1).alias("sim_nonzero_cnt"))
    return X.collapse_duplicates(rows)


@query("a14_interactions", f"SELECT user_id, product_id, count(*) AS count FROM {PRIOR} GROUP BY 1, 2")
def _(i: Inputs):
    return X.interactions(i.prior_baskets(i.natural))


@query("a15_product_counts", f"SELECT product_id, count(*) AS n_orders FROM {PRIOR} GROUP BY 1 ORDER BY 2 DESC, 1")
def _(i: Inputs):
    from basketry.operators.similarity import product_support

    return product_support(i.prior_baskets(i.natural)).orderBy(F.col("n_orders").desc(), "product_id")


@query(
    "a16_basket_summary",
    f"""SELECT count(*) AS n_rows, count(DISTINCT order_id) AS n_orders, count(DISTINCT user_id) AS n_users, count(DISTINCT product_id) AS n_products,
    count(DISTINCT (user_id, product_id)) AS n_pairs FROM {PRIOR}""",
)
def _(i: Inputs):
    return P.basket_summary(i.prior_baskets(i.natural))


@query("a19_value_counts", "SELECT eval_set, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM b_orders), 6) AS share FROM b_orders GROUP BY 1")
def _(i: Inputs):
    return P.value_counts(i.natural.orders, "eval_set")


_PROFILED = ["order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]


@query(
    "a20_numeric_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM b_orders"""
        for c in _PROFILED
    ),
)
def _(i: Inputs):
    return P.numeric_profile(i.natural.orders, _PROFILED)


@query(
    "a21_cardinalities",
    """SELECT 'user_id' AS column_name, count(DISTINCT user_id) AS n_distinct FROM b_facts UNION ALL SELECT 'product_id', count(DISTINCT product_id) FROM b_facts
    UNION ALL SELECT 'aisle_id', count(DISTINCT aisle_id) FROM b_products UNION ALL SELECT 'department_id', count(DISTINCT department_id) FROM b_products""",
)
def _(i: Inputs):
    return P.cardinalities(i.natural.baskets, i.natural.products)


_DAY = "CASE order_dow " + " ".join(f"WHEN {n} THEN '{d}'" for n, d in enumerate(E.DAY_NAMES)) + " END"
_DAY_SHORT = "CASE order_dow " + " ".join(f"WHEN {n} THEN '{d}'" for n, d in enumerate(E.DAY_SHORT)) + " END"


@query(
    "a22_w06_orders_by_day",
    f"SELECT order_dow, {_DAY} AS day_name, count(*) AS n_orders, round(100.0 * count(*) / (SELECT count(*) FROM b_orders), 6) AS pct FROM b_orders GROUP BY order_dow",
)
def _(i: Inputs):
    return P.orders_by_day(i.natural.orders)


@query("a23_orders_by_hour", "SELECT order_hour_of_day, count(*) AS n_orders, round(100.0 * count(*) / (SELECT count(*) FROM b_orders), 6) AS pct FROM b_orders GROUP BY 1")
def _(i: Inputs):
    return P.orders_by(i.natural.orders, "order_hour_of_day")


def histogram_sql(values: str, n: int) -> str:
    """Equal-width histogram of the column ``v`` of ``values``."""
    return f"""WITH v AS ({values}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
    SELECT g.bin, round(lo + g.bin * (hi - lo) / {n}, 6) AS bin_low, round(lo + (g.bin + 1) * (hi - lo) / {n}, 6) AS bin_high, coalesce(c.n, 0) AS n
    FROM e, (SELECT range AS bin FROM range({n})) g LEFT JOIN (
      SELECT CAST(least(floor((v - lo) * {n} / (hi - lo)), {n - 1}) AS BIGINT) AS bin, count(*) AS n FROM v, e GROUP BY 1) c ON c.bin = g.bin"""


@query("a24_gap_histogram", f"SELECT * FROM ({histogram_sql('SELECT days_since_prior_order AS v FROM b_orders WHERE days_since_prior_order IS NOT NULL', 30)})")
def _(i: Inputs):
    return P.equal_width_histogram(i.natural.orders, "days_since_prior_order", 30)


@query(
    "a25_w05_orders_per_user",
    """SELECT g.bin, g.bin * 5 AS bin_low, g.bin * 5 + 5 AS bin_high, coalesce(n, 0) AS n_users,
      round(100.0 * sum(coalesce(n, 0)) OVER (ORDER BY g.bin) / (SELECT count(DISTINCT user_id) FROM b_orders), 6) AS cum_pct
    FROM (SELECT range AS bin FROM range(20)) g LEFT JOIN (SELECT least(total // 5, 19) AS bin, count(*) AS n FROM
      (SELECT user_id, max(order_number) AS total FROM b_orders GROUP BY 1) WHERE total <= 100 GROUP BY 1) c ON c.bin = g.bin""",
)
def _(i: Inputs):
    return P.orders_per_user_histogram(i.natural.orders)


def _top_sql(name: str, join: str) -> str:
    return f"""SELECT {name}, n_lines, round(100.0 * n_lines / sum(n_lines) OVER (), 6) AS pct_of_top FROM (
      SELECT {name}, count(*) AS n_lines FROM b_facts f LEFT JOIN b_products p ON p.product_id = f.product_id {join}
      WHERE eval_set = 'prior' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)"""


@query("a26_top_departments", _top_sql("department", "LEFT JOIN b_departments d ON d.department_id = p.department_id"))
def _(i: Inputs):
    t = i.natural
    return P.top_groups(i.prior_baskets(t), t.products.join(t.departments, "department_id", "left").select("product_id", "department"), "product_id", ["department"])


@query("a26_top_aisles", _top_sql("aisle", "LEFT JOIN b_aisles a ON a.aisle_id = p.aisle_id"))
def _(i: Inputs):
    t = i.natural
    return P.top_groups(i.prior_baskets(t), t.products.join(t.aisles, "aisle_id", "left").select("product_id", "aisle"), "product_id", ["aisle"])


@query("a26_c05_top_products", f"SELECT *, CASE WHEN length(product_name) > 8 THEN concat(product_name[1:7], '...') ELSE product_name END AS short_name FROM ({_top_sql('product_name', '')})")
def _(i: Inputs):
    t = i.natural
    top = P.top_groups(i.prior_baskets(t), t.products.select("product_id", "product_name"), "product_id", ["product_name"])
    return top.withColumn("short_name", E.ellipsis(F.col("product_name"), 8, 7))


@query("a27_reorder_rate_by_day", f"SELECT order_dow, {_DAY_SHORT} AS day_name, count(*) AS n_lines, round(avg(reordered), 6) AS reorder_rate FROM {PRIOR} GROUP BY order_dow")
def _(i: Inputs):
    return P.reorder_rate_by_day(i.prior(i.natural))


@query("a28_reorder_rate_by_hour", f"SELECT order_hour_of_day, count(*) AS n_lines, round(avg(reordered), 6) AS reorder_rate FROM {PRIOR} GROUP BY 1")
def _(i: Inputs):
    return P.reorder_rate_by(i.prior(i.natural), "order_hour_of_day", "order_hour_of_day")


_GAP = "CASE " + " ".join(f"WHEN days_since_prior_order > {lo} AND days_since_prior_order <= {hi} THEN '{n}'" for lo, hi, n in E.GAP_BINS) + " END"
_BINS = ", ".join(f"({k}, '{n}')" for k, (_, _, n) in enumerate(E.GAP_BINS))


@query(
    "a29_c08_reorder_rate_by_gap",
    f"""SELECT CAST(b.no AS BIGINT) AS bin_no, b.name AS gap_bin, coalesce(n, 0) AS n_lines, round(rate, 6) AS reorder_rate FROM (VALUES {_BINS}) b(no, name)
    LEFT JOIN (SELECT {_GAP} AS name, count(*) AS n, avg(reordered) AS rate FROM f_facts WHERE eval_set = 'prior' GROUP BY 1) r ON r.name = b.name""",
)
def _(i: Inputs):
    return P.reorder_rate_by_gap(i.prior(i.folded))


@query("a30_reorder_rate_by_sequence", f"SELECT order_number, count(*) AS n_lines, round(avg(reordered), 6) AS reorder_rate FROM {PRIOR} GROUP BY 1")
def _(i: Inputs):
    return P.reorder_rate_by(i.prior(i.natural), "order_number", "order_number")


@query(
    "a31_f09_product_popularity",
    """SELECT s.product_id, n_purchases, round(rate, 6) AS reorder_rate, product_name FROM (
      SELECT product_id, count(*) AS n_purchases, avg(reordered) AS rate FROM f_facts WHERE eval_set = 'prior' GROUP BY 1 HAVING count(*) >= 200) s
    LEFT JOIN f_products p ON p.product_id = s.product_id""",
)
def _(i: Inputs):
    return P.product_popularity(i.prior(i.folded), i.folded.products)


@query("a32_log_frequency_histogram", f"SELECT * FROM ({histogram_sql('SELECT ln(1 + count(*)) AS v FROM b_facts WHERE eval_set = ' + repr('prior') + ' GROUP BY product_id', 50)})")
def _(i: Inputs):
    return P.log_frequency_histogram(i.prior_baskets(i.natural))


@query(
    "a33_j14_purchase_history",
    "SELECT h.user_id, h.product_id, purchase_count, reordered, product_name FROM b_history h LEFT JOIN b_products p ON p.product_id = h.product_id",
)
def _(i: Inputs):
    return P.purchase_history(i.prior(i.natural), i.natural.products)


@query(
    "a34_cart_departments",
    """SELECT cart_id, department, n_inside, rank FROM (SELECT *, row_number() OVER (PARTITION BY cart_id ORDER BY n_inside DESC, department) AS rank FROM
      (SELECT cart_id, department, count(*) AS n_inside FROM b_carts k JOIN b_catalog c ON c.product_id = k.product_id GROUP BY 1, 2)) WHERE rank <= 3""",
)
def _(i: Inputs):
    counts = R.cart_departments(i.carts(i.natural), i.catalog(i.natural))
    return M.top_k_per_group(counts, ["cart_id"], [F.col("n_inside").desc(), F.col("department")], 3)


@query("a35_department_ranks", "SELECT department, count(*) AS n_products, row_number() OVER (ORDER BY count(*) DESC, department) AS department_rank FROM b_catalog GROUP BY 1")
def _(i: Inputs):
    return R.department_ranks(i.catalog(i.natural))


@query("a38_candidate_counts", "SELECT user_id, order_id, count(*) AS n_candidates FROM f_cand WHERE eval_set = 'train' GROUP BY 1, 2")
def _(i: Inputs):
    return i.base("train").groupBy("user_id", "order_id").agg(F.count("*").alias("n_candidates"))


@query("w05_running_share", "SELECT order_number, count(*) AS n, round(100.0 * sum(count(*)) OVER (ORDER BY order_number) / (SELECT count(*) FROM b_orders), 6) AS cum_pct FROM b_orders GROUP BY 1")
def _(i: Inputs):
    counts = i.natural.orders.groupBy("order_number").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return running_totals(counts, "order_number", ["n"], F.floor(F.col("order_number") / 1000)).select("order_number", "n", (100.0 * F.col("cum_n") / total).alias("cum_pct"))


@query(
    "c01_c02_c03_department_images",
    "SELECT DISTINCT department_id, CASE WHEN department_id IN (1, 4) THEN 'missing' ELSE lower(department) END AS key, 'a/' || CASE WHEN department_id IN (1, 4, 6) THEN 'none' ELSE 'some' END AS image FROM b_departments",
)
def _(i: Inputs):
    padded = F.when(~F.col("department_id").isin(1, 4), F.concat(F.lit("  "), "department", F.lit(" ")))
    key = E.normalized_key(padded)
    names = {"large": "a\\some", "medium": "a\\some", "small": "a\\some", "missing": "a\\none"}
    return i.natural.departments.select("department_id", key.alias("key"), E.forward_slashes(E.lookup(key, names)).alias("image"))


@query("c04_c05_titles", "SELECT product_id, 'Product ' || product_id AS made_title, CASE WHEN length(t) > 45 THEN t[1:45] || '...' ELSE t END AS short_title FROM (SELECT *, product_name || ' ' || product_name || ' ' || product_name || ' ' || product_name || ' x' || product_id AS t FROM b_products)")
def _(i: Inputs):
    title = F.concat(F.concat_ws(" ", *["product_name"] * 4), F.lit(" x"), F.col("product_id").cast("string"))
    return i.natural.products.select("product_id", E.synthetic_title(None, F.col("product_id")).alias("made_title"), E.ellipsis(title).alias("short_title"))


_BADGE = """CASE WHEN purchase_count >= 3 THEN '⭐ Bought ' || purchase_count || 'x before' WHEN purchase_count > 1 THEN '✓ Bought ' || purchase_count || 'x before'
  WHEN purchase_count IS NOT NULL THEN '✓ Bought before' END"""


@query("c06_purchase_badges", f"SELECT user_id, product_id, {_BADGE} AS badge FROM f_history")
def _(i: Inputs):
    history = P.purchase_history(i.prior(i.folded), i.folded.products)
    return history.select("user_id", "product_id", E.purchase_badge(F.col("purchase_count")).alias("badge"))


@query(
    "c07_day_names",
    f"SELECT order_id, {_DAY} AS long_name, {_DAY_SHORT} AS short_name FROM b_orders",
)
def _(i: Inputs):
    return i.natural.orders.select("order_id", E.day_name(F.col("order_dow")).alias("long_name"), E.day_name(F.col("order_dow"), E.DAY_SHORT).alias("short_name"))


@query(
    "c09_c10_c11_numeric",
    """SELECT user_id, product_id, round(ln(1 + greatest(n - 2, 0)), 6) AS log_n, 1.0 + 40.0 * n AS confidence, round(ln(s / (1 - s)), 6) AS logit,
      round(ln(least(greatest(s, 1e-8), 1 - s)), 6) AS logit_compat FROM (SELECT user_id, product_id, count(*) AS n, count(*) / (1.0 + count(*)) AS s FROM f_facts GROUP BY 1, 2)""",
)
def _(i: Inputs):
    n = F.col("count")
    pairs = X.interactions(i.folded.baskets).withColumn("s", n / (1.0 + n))
    return pairs.select(
        "user_id",
        "product_id",
        E.log1p_floor0(n - 2).alias("log_n"),
        E.confidence(n).alias("confidence"),
        E.logit(F.col("s")).alias("logit"),
        E.logit(F.col("s"), compat=True).alias("logit_compat"),
    )


@query("c12_parse_id_list", "SELECT cart_id, count(*) AS n_ids, CAST(sum(product_id) AS BIGINT) AS id_sum FROM b_carts GROUP BY 1")
def _(i: Inputs):
    ids = i.carts(i.natural).groupBy("cart_id", F.floor(F.col("product_id") / 10_000).alias("part")).agg(F.collect_list(F.col("product_id").cast("string")).alias("ids"))
    parsed = ids.select("cart_id", E.parse_id_list(F.concat(F.array_join("ids", " , "), F.lit(",x7, ,-3"))).alias("ids"))
    each = parsed.select("cart_id", F.size("ids").alias("n"), F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("s"))
    return each.groupBy("cart_id").agg(F.sum("n").alias("n_ids"), F.sum("s").alias("id_sum"))


@query(
    "c13_dot_and_cosine",
    """SELECT order_id, order_dow * order_hour_of_day + order_number * 2.0 AS dot,
      round(CASE WHEN (order_dow * order_dow + order_number * order_number) > 0 THEN (order_dow * order_hour_of_day + order_number * 2.0)
        / (sqrt(order_dow * order_dow + order_number * order_number) * sqrt(order_hour_of_day * order_hour_of_day + 4.0)) ELSE 0.0 END, 6) AS cosine FROM b_orders""",
)
def _(i: Inputs):
    u = F.array(F.col("order_dow").cast("double"), F.col("order_number").cast("double"))
    v = F.array(F.col("order_hour_of_day").cast("double"), F.lit(2.0))
    return i.natural.orders.select("order_id", E.dot(u, v).alias("dot"), E.cosine(u, v).alias("cosine"))


@query("c14_rounding", "SELECT user_id, product_id, round(n / 7.0, 4) AS four, round(n / 7.0, 5) AS five FROM (SELECT user_id, product_id, count(*) AS n FROM b_facts GROUP BY 1, 2)")
def _(i: Inputs):
    x = F.col("count") / 7.0
    return X.interactions(i.natural.baskets).select("user_id", "product_id", F.round(x, 4).alias("four"), F.round(x, 5).alias("five"))


@query(
    "x01_x02_purchase_rank_and_span",
    """SELECT user_id, product_id, dense_rank() OVER (PARTITION BY user_id ORDER BY up_times_bought DESC) AS purchase_rank,
      up_last_order_number - up_first_order_number AS span FROM f_pair""",
)
def _(i: Inputs):
    pairs = X.pair_features(i.prior_baskets(i.folded))
    return X.purchase_rank(pairs).select("user_id", "product_id", "purchase_rank", (F.col("up_last_order_number") - F.col("up_first_order_number")).alias("span"))


@query("x03_part_of_day", "SELECT order_id, CASE WHEN order_hour_of_day < 12 THEN 1 ELSE 0 END AS is_morning, CASE WHEN order_hour_of_day >= 18 THEN 1 ELSE 0 END AS is_evening FROM b_orders")
def _(i: Inputs):
    flags = X.part_of_day()
    return i.natural.orders.select("order_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "x04_gap_to_order_median",
    "SELECT order_id, product_id, round(score - median(score) OVER (PARTITION BY order_id), 6) AS above_median FROM f_scored WHERE eval_set = 'test'",
)
def _(i: Inputs):
    return X.minus_group_median(i.scored("test"), "order_id", "score", "above_median").select("order_id", "product_id", "above_median")


@query(
    "x05_missing_indicator",
    """SELECT order_id, CASE WHEN days_since_prior_order IS NULL THEN 1 ELSE 0 END AS days_since_prior_order_missing,
      round(coalesce(days_since_prior_order, (SELECT median(days_since_prior_order) FROM b_orders)), 6) AS days_since_prior_order_filled FROM b_orders""",
)
def _(i: Inputs):
    filled = median_filled(i.natural.orders, "days_since_prior_order")
    return filled.select("order_id", "days_since_prior_order_missing", "days_since_prior_order_filled")


@query(
    "x06_x09_score_mix_and_interaction",
    """SELECT c.user_id, c.product_id, round(2.0 / 3.0 * up_rate_in_user_history + 1.0 / 3.0 * p_reorder_prob, 6) AS mixed,
      round(up_rate_in_user_history * p_reorder_prob, 6) AS rate_x_reorder FROM f_cand c JOIN f_pair u ON u.user_id = c.user_id AND u.product_id = c.product_id
    JOIN f_product p ON p.product_id = c.product_id WHERE eval_set = 'train'""",
)
def _(i: Inputs):
    rows = i.scored("train").withColumnRenamed("score", "up_rate_in_user_history").join(X.product_features(i.prior(i.folded)), "product_id")
    mixed = E.weighted_ensemble({"up_rate_in_user_history": 2 / 3, "p_reorder_prob": 1 / 3})
    return rows.select("user_id", "product_id", mixed.alias("mixed"), (F.col("up_rate_in_user_history") * F.col("p_reorder_prob")).alias("rate_x_reorder"))
