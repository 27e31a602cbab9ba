"""SQL building blocks of the check queries, as named subqueries over the star tables.

``oracle(body)`` puts the blocks that ``body`` needs in front of it.
"""

from __future__ import annotations

import re

# Natural blocks keep part keys as products; folded ones (names with ``f_``) take the suppliers.
_ORDERS = """
SELECT order_id, user_id,
  CASE WHEN order_number < n_orders THEN 'prior' WHEN user_id % 5 < 3 THEN 'train' ELSE 'test' END AS eval_set,
  order_number, order_dow, order_hour_of_day, CAST(gap % 31 AS DOUBLE) AS days_since_prior_order
FROM (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
    row_number() OVER w AS order_number, count(*) OVER (PARTITION BY o_custkey) AS n_orders,
    CAST(dayofweek(o_orderdate) AS BIGINT) AS order_dow, o_orderkey % 24 AS order_hour_of_day,
    date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS gap
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)
"""

_LINES = """
SELECT order_id, product_id, row_number() OVER (PARTITION BY order_id ORDER BY first_line, product_id) AS add_to_cart_order
FROM (SELECT l_orderkey AS order_id, {product} AS product_id, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1, 2)
"""

_FACTS = """
SELECT l.order_id, l.product_id, l.add_to_cart_order,
  CAST(o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, l.product_id) AS BIGINT) AS reordered,
  o.user_id, o.eval_set, o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order
FROM {lines} l LEFT JOIN b_orders o ON l.order_id = o.order_id
"""

_PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS aisle_id,
  CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4
    WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS BIGINT) AS department_id
FROM part
"""

_SUPPLIERS = """
SELECT s_suppkey AS product_id, s_name AS product_name, CAST(s_nationkey AS BIGINT) AS aisle_id, CAST(n_regionkey AS BIGINT) AS department_id
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
"""

_USER_FEATURES = """
SELECT user_id, max(order_number) AS u_total_orders, count(product_id) AS u_total_items,
  count(DISTINCT product_id) AS u_distinct_products, count(*)::DOUBLE / count(DISTINCT order_id) AS u_avg_basket_size,
  coalesce(avg(reordered), 0.0) AS u_reorder_ratio, avg(days_since_prior_order) AS u_mean_days_between,
  stddev_samp(days_since_prior_order) AS u_std_days_between
FROM {facts} WHERE eval_set = 'prior' GROUP BY user_id
"""

_PRODUCT_FEATURES = """
SELECT product_id, count(*) AS p_total_purchases, count(DISTINCT user_id) AS p_distinct_users,
  avg(add_to_cart_order) AS p_avg_add_to_cart, avg(reordered) AS p_reorder_prob
FROM {facts} WHERE eval_set = 'prior' GROUP BY product_id
"""

_PAIR_FEATURES = """
SELECT user_id, product_id, up_times_bought, up_last_order_number, up_first_order_number, up_avg_add_to_cart,
  u_last_prior_order, u_last_prior_order - up_last_order_number AS up_recency, user_total_bought,
  up_times_bought::DOUBLE / user_total_bought AS up_rate_in_user_history
FROM (
  SELECT *, max(up_last_order_number) OVER (PARTITION BY user_id) AS u_last_prior_order,
    CAST(sum(up_times_bought) OVER (PARTITION BY user_id) AS BIGINT) AS user_total_bought
  FROM (SELECT user_id, product_id, count(*) AS up_times_bought, max(order_number) AS up_last_order_number,
      min(order_number) AS up_first_order_number, avg(add_to_cart_order) AS up_avg_add_to_cart
    FROM {facts} WHERE eval_set = 'prior' GROUP BY user_id, product_id))
"""

_EDGES = """
SELECT product_id, neighbor_product_id, n_both / sqrt(n_own * n_other) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY n_both::DOUBLE * n_both / n_other DESC, neighbor_product_id) AS rank
  FROM (
    SELECT a.product_id, b.product_id AS neighbor_product_id, count(*) AS n_both, any_value(s.n) AS n_own, any_value(t.n) AS n_other
    FROM {facts} a JOIN {facts} b ON a.order_id = b.order_id AND a.product_id <> b.product_id
    JOIN (SELECT product_id, count(*) AS n FROM {facts} WHERE eval_set = 'prior' GROUP BY 1) s ON s.product_id = a.product_id
    JOIN (SELECT product_id, count(*) AS n FROM {facts} WHERE eval_set = 'prior' GROUP BY 1) t ON t.product_id = b.product_id
    WHERE a.eval_set = 'prior' GROUP BY 1, 2)
) WHERE rank <= 10
"""

_PAIR_SCORES = """
SELECT p.user_id, p.product_id, p.n / (1.0 + p.n) AS als_score, coalesce(sim_max, 0.0) AS sim_max, coalesce(sim_mean, 0.0) AS sim_mean,
  coalesce(sim_topk_mean_10, 0.0) AS sim_topk_mean_10, coalesce(sim_nonzero_cnt, 0) AS sim_nonzero_cnt
FROM (SELECT user_id, product_id, count(*) AS n FROM f_facts WHERE eval_set = 'prior' GROUP BY 1, 2) p
LEFT JOIN (
  SELECT user_id, product_id, max(score) AS sim_max, avg(score) AS sim_mean, count(score) AS sim_nonzero_cnt,
    avg(score) FILTER (WHERE nth <= 10) AS sim_topk_mean_10
  FROM (
    SELECT c.user_id, c.product_id, e.score, row_number() OVER (PARTITION BY c.user_id, c.product_id ORDER BY e.score DESC) AS nth
    FROM (SELECT DISTINCT user_id, product_id FROM f_facts WHERE eval_set = 'prior') c
    JOIN (SELECT DISTINCT user_id, product_id FROM f_facts WHERE eval_set = 'prior') h ON h.user_id = c.user_id
    JOIN f_edges e ON e.product_id = h.product_id AND e.neighbor_product_id = c.product_id)
  GROUP BY 1, 2) s ON s.user_id = p.user_id AND s.product_id = p.product_id
"""

_CANDIDATES = """
SELECT o.user_id, o.order_id, h.product_id, o.order_number, o.order_dow, o.order_hour_of_day, o.days_since_prior_order, o.eval_set,
  CAST(coalesce(y.hit, 0) AS BIGINT) AS label
FROM b_orders o
LEFT JOIN (SELECT DISTINCT user_id, product_id FROM f_facts WHERE eval_set = 'prior') h ON h.user_id = o.user_id
LEFT JOIN (SELECT DISTINCT order_id, product_id, 1 AS hit FROM f_facts WHERE eval_set = 'train') y
  ON y.order_id = o.order_id AND y.product_id = h.product_id
WHERE o.eval_set <> 'prior'
"""

_FULL = """
SELECT c.user_id, c.order_id, c.product_id, c.eval_set, c.label, c.order_number, c.order_dow, c.order_hour_of_day,
  coalesce(c.days_since_prior_order, 0.0) AS days_since_prior_order,
  coalesce(s.als_score, 0.0) AS als_score, coalesce(s.sim_max, 0.0) AS sim_max, coalesce(s.sim_mean, 0.0) AS sim_mean,
  coalesce(s.sim_topk_mean_10, 0.0) AS sim_topk_mean_10, coalesce(s.sim_nonzero_cnt, 0) AS sim_nonzero_cnt,
  coalesce(u_total_orders, 0) AS u_total_orders, coalesce(u_total_items, 0) AS u_total_items,
  coalesce(u_distinct_products, 0) AS u_distinct_products, coalesce(u_avg_basket_size, 0.0) AS u_avg_basket_size,
  coalesce(u_reorder_ratio, 0.0) AS u_reorder_ratio, coalesce(u_mean_days_between, 0.0) AS u_mean_days_between,
  coalesce(u_std_days_between, 0.0) AS u_std_days_between, coalesce(p_total_purchases, 0) AS p_total_purchases,
  coalesce(p_distinct_users, 0) AS p_distinct_users, coalesce(p_avg_add_to_cart, 0.0) AS p_avg_add_to_cart,
  coalesce(p_reorder_prob, 0.0) AS p_reorder_prob, coalesce(up_times_bought, 0) AS up_times_bought,
  coalesce(up_last_order_number, 0) AS up_last_order_number, coalesce(up_first_order_number, 0) AS up_first_order_number,
  coalesce(up_avg_add_to_cart, 0.0) AS up_avg_add_to_cart, coalesce(u_last_prior_order, 0) AS u_last_prior_order,
  coalesce(up_recency, 0) AS up_recency, coalesce(user_total_bought, 0) AS user_total_bought,
  coalesce(up_rate_in_user_history, 0.0) AS up_rate_in_user_history
FROM f_cand c LEFT JOIN f_scores s ON s.user_id = c.user_id AND s.product_id = c.product_id
LEFT JOIN f_user u ON u.user_id = c.user_id LEFT JOIN f_product p ON p.product_id = c.product_id
LEFT JOIN f_pair up ON up.user_id = c.user_id AND up.product_id = c.product_id
"""

_SCORED = """
SELECT c.*, up.up_rate_in_user_history AS score FROM f_cand c
JOIN f_pair up ON up.user_id = c.user_id AND up.product_id = c.product_id
"""

# Train candidates as (label y, rounded score p), totals, and counts at or above each score.
_CURVE = """
SELECT p, pos, neg, n_pos, n_neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM (
  SELECT p, sum(y) AS pos, sum(1 - y) AS neg, (SELECT sum(y) FROM f_yp) AS n_pos, (SELECT sum(1 - y) FROM f_yp) AS n_neg FROM f_yp GROUP BY p)
WINDOW w AS (ORDER BY p DESC)
"""

_RANKED = """
SELECT order_id, product_id, y, r, n_rows, n_pos, sum(y) OVER (PARTITION BY order_id ORDER BY r) / r AS prec,
  row_number() OVER (PARTITION BY order_id ORDER BY y DESC, r) AS ideal
FROM (SELECT order_id, product_id, label AS y, count(*) OVER (PARTITION BY order_id) AS n_rows,
    sum(label) OVER (PARTITION BY order_id) AS n_pos,
    row_number() OVER (PARTITION BY order_id ORDER BY round(score, 9) DESC, product_id) AS r
  FROM f_scored WHERE eval_set = 'train')
"""


def _metrics(k: int) -> str:
    dcg = f"coalesce(sum((power(2, y) - 1) / log2(r + 1)) FILTER (WHERE r <= {k}), 0.0)"
    best = f"sum((power(2, y) - 1) / log2(ideal + 1)) FILTER (WHERE ideal <= {k})"
    hits = f"coalesce(sum(y) FILTER (WHERE r <= {k}), 0)"
    return f"""
  {dcg} AS dcg_{k}, CASE WHEN any_value(n_pos) > 0 THEN {dcg} / ({best}) ELSE 0.0 END AS ndcg_{k},
  coalesce(avg(prec) FILTER (WHERE r <= {k} AND y = 1), 0.0) AS map_{k},
  CASE WHEN {hits} > 0 THEN 1.0 ELSE 0.0 END AS recall_window_{k},
  CASE WHEN any_value(n_pos) > 0 THEN {hits}::DOUBLE / any_value(n_pos) ELSE 0.0 END AS recall_{k},
  CASE WHEN {hits} > 0 THEN 1.0 ELSE 0.0 END AS hitrate_{k}"""


_GROUP_METRICS = f"""
SELECT order_id, any_value(n_rows) AS n_rows, CAST(any_value(n_pos) AS BIGINT) AS n_pos, {", ".join(_metrics(k) for k in (5, 10, 20))}
FROM f_ranked GROUP BY order_id
"""

BLOCKS = {
    "b_orders": _ORDERS,
    "b_lines": _LINES.format(product="l_partkey"),
    "f_lines": _LINES.format(product="l_suppkey"),
    "b_facts": _FACTS.format(lines="b_lines"),
    "f_facts": _FACTS.format(lines="f_lines"),
    "b_products": _PRODUCTS,
    "f_products": _SUPPLIERS,
    "b_aisles": "SELECT DISTINCT CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS aisle_id, p_brand AS aisle FROM part",
    "b_departments": "SELECT DISTINCT department_id, p_type AS department FROM part JOIN b_products ON p_partkey = product_id",
    "f_departments": "SELECT CAST(r_regionkey AS BIGINT) AS department_id, r_name AS department FROM region",
    "b_edges": _EDGES.format(facts="b_facts"),
    "f_edges": _EDGES.format(facts="f_facts"),
    "f_user": _USER_FEATURES.format(facts="f_facts"),
    "f_product": _PRODUCT_FEATURES.format(facts="f_facts"),
    "f_pair": _PAIR_FEATURES.format(facts="f_facts"),
    "f_scores": _PAIR_SCORES,
    "f_cand": _CANDIDATES,
    "f_full": _FULL,
    "f_scored": _SCORED,
    "f_yp": "SELECT label AS y, round(score, 9) AS p FROM f_scored WHERE eval_set = 'train'",
    "f_curve": _CURVE,
    "f_ranked": _RANKED,
    "f_groups": _GROUP_METRICS,
    "b_carts": "SELECT order_id AS cart_id, product_id FROM b_facts WHERE eval_set <> 'prior'",
    "f_carts": "SELECT order_id AS cart_id, product_id FROM f_facts WHERE eval_set <> 'prior'",
    "b_recent": """SELECT user_id, product_id FROM (SELECT *, max(order_number) OVER (PARTITION BY user_id) AS last FROM
      (SELECT o.user_id, o.order_number, f.product_id FROM b_orders o LEFT JOIN b_facts f ON f.order_id = o.order_id WHERE o.eval_set = 'prior'))
      WHERE order_number = last AND product_id IS NOT NULL""",
    "b_catalog": "SELECT p.*, d.department FROM b_products p LEFT JOIN b_departments d ON d.department_id = p.department_id",
    "f_catalog": "SELECT p.*, d.department FROM f_products p LEFT JOIN f_departments d ON d.department_id = p.department_id",
    "b_history": """SELECT f.user_id, f.product_id, count(*) AS purchase_count, CAST(sum(f.reordered) AS BIGINT) AS reordered
      FROM b_facts f WHERE eval_set = 'prior' GROUP BY 1, 2""",
    "f_history": """SELECT f.user_id, f.product_id, count(*) AS purchase_count, CAST(sum(f.reordered) AS BIGINT) AS reordered
      FROM f_facts f WHERE eval_set = 'prior' GROUP BY 1, 2""",
}


def oracle(body: str) -> str:
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(BLOCKS[name])

    need(body)
    # A subquery used more than once is computed once.
    parts = [f"{name} AS MATERIALIZED ({BLOCKS[name].strip()})" for name in BLOCKS if name in needed]
    body = body.strip()
    if body.startswith("WITH "):
        parts.append(body.removeprefix("WITH "))
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
