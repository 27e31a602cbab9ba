"""Times the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from basketry import build_session
from basketry.plans import QUERIES

HEADLINE = [
    "s01_order_products",
    "a16_basket_summary",
    "a27_reorder_rate_by_day",
    "a09_a11_user_product_features",
    "j04_attach_label",
    "j06_train_candidates",
    "j17_co_purchases",
    "w03_top_neighbors",
    "j09_j11_a17_a18_m07_pair_similarity",
    "r01_neighbors_of_recent",
    "r04_similar_to_cart",
    "r06_cart_department_fallback",
    "e01_auc",
    "e07_calibration_curve",
    "e09_e14_ranking_metrics",
    "w02_k05_top_10",
    "q01_skewed_columns",
    "m03_s12_factors",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus)
    spark.read.parquet(f"{path}/lineitem.parquet").groupBy("l_linenumber").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(os.path.normpath(path)).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
