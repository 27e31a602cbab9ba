"""Typed CSV scans, candidate files, lookups, sinks and saved models."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.operators.candidates import FEATURE_COLUMNS, ID_COLUMNS
from basketry.operators.preprocess import Preprocessing
from basketry.operators.qda import QdaFit, QdaModel
from basketry.operators.quality import SchemaError, require_columns
from basketry.operators.ranker import Ranker, tree_rows
from basketry.operators.trees import Tree
from basketry.session import materialize, path_exists

# Schemas of the six base tables and their file names.
ORDER_PRODUCT_SCHEMA = "order_id int, product_id int, add_to_cart_order smallint, reordered tinyint"
CSV_TABLES = {
    "orders": "order_id int, user_id int, eval_set string, order_number smallint, order_dow tinyint, "
    "order_hour_of_day tinyint, days_since_prior_order float",
    "order_products__prior": ORDER_PRODUCT_SCHEMA,
    "order_products__train": ORDER_PRODUCT_SCHEMA,
    "products": "product_id bigint, product_name string, aisle_id bigint, department_id bigint",
    "aisles": "aisle_id bigint, aisle string",
    "departments": "department_id bigint, department string",
}
# Names under which similarity files may keep their columns, best first.
NEIGHBOR_NAMES = ["neighbor_product_id", "neighbor_id", "product_id_2"]
SCORE_NAMES = ["score", "similarity_score", "sim"]
# Features that are whole numbers.
WHOLE_FEATURES = [
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "sim_nonzero_cnt",
    "u_total_orders",
    "u_total_items",
    "u_distinct_products",
    "p_total_purchases",
    "p_distinct_users",
    "up_times_bought",
    "up_last_order_number",
    "up_first_order_number",
    "u_last_prior_order",
    "up_recency",
    "user_total_bought",
]
# End of the fixed values.


def load_csv_tables(spark: SparkSession, folder: str, names: Sequence[str] = tuple(CSV_TABLES)) -> dict[str, DataFrame]:
    """The base tables from CSV files with a header; no schema inference."""
    return {n: spark.read.schema(CSV_TABLES[n]).option("header", True).option("escape", '"').csv(f"{folder.rstrip('/')}/{n}.csv") for n in names}


CORRUPT = "_corrupt"


def load_checked_csv(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A base table from CSV, and ``(table_name, n_rows, n_corrupt)`` of it, both from one read.

    A line with too few or too many fields, or with a value that its column can't hold (text in a number, a number beyond
    SMALLINT), is corrupt: it is counted, kept as text in ``_corrupt`` of the first table, and its other columns are what could be read.
    The table is written once as Parquet, as a pruned read of the lines would not parse them whole.
    """
    schema = f"{CSV_TABLES[name]}, {CORRUPT} string"
    read = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT)
    seen = Observation()
    rows = read.csv(f"{folder.rstrip('/')}/{name}.csv").observe(seen, F.count("*").alias("n"), F.count(CORRUPT).alias("bad"))
    table = materialize(rows, f"csv-{name}")
    counts = spark.createDataFrame([(name, seen.get["n"], seen.get["bad"])], "table_name string, n_rows long, n_corrupt long")
    return table, counts


def write_csv_table(df: DataFrame, folder: str, name: str) -> str:
    """A base table as CSV with a header, with the columns and order of its schema."""
    path = f"{folder.rstrip('/')}/{name}.csv"
    columns = [c.split()[0] for c in CSV_TABLES[name].split(", ")]
    df.select(*columns).write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
    return path


def _typed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A candidate CSV with the types that its column names imply; only the header is looked at."""
    names = spark.read.option("header", True).csv(path).columns
    whole = [*ID_COLUMNS, "label", "rank", *[c for c in FEATURE_COLUMNS if c in WHOLE_FEATURES]]
    schema = ", ".join(f"`{n}` {'string' if n == 'eval_set' else 'bigint' if n in whole else 'double'}" for n in names)
    return spark.read.schema(schema).option("header", True).csv(path)


def load_candidates(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One table from one or many candidate files, CSV or Parquet; absent columns become null."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no candidate file given")
    read = [_typed_csv(spark, p) if p.rstrip("/").endswith(".csv") else spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def load_preferred(spark: SparkSession, stem: str, ids: Sequence[str] = ("user_id", "order_id", "product_id")) -> DataFrame:
    """``stem``.parquet if it exists, else ``stem``.csv; the id columns must be there."""
    for path in (f"{stem}.parquet", f"{stem}.csv"):
        if path_exists(spark, path):
            return require_columns(load_candidates(spark, path), ids, path)
    raise FileNotFoundError(f"neither {stem}.parquet nor {stem}.csv")


def resolve_similarity(df: DataFrame) -> DataFrame:
    """A similarity table with its columns under their standard names."""
    renamed = df
    if "product_id" not in df.columns and "product_id_1" in df.columns:
        renamed = renamed.withColumnRenamed("product_id_1", "product_id")
    for wanted, names in (("neighbor_product_id", NEIGHBOR_NAMES), ("score", SCORE_NAMES)):
        found = next((n for n in names if n in renamed.columns), None)
        if found is None:
            raise SchemaError(f"similarity table has no column out of {names}")
        renamed = renamed.withColumnRenamed(found, wanted)
    return require_columns(renamed, ["product_id", "neighbor_product_id", "score"], "similarity table")


def load_lookup(spark: SparkSession, path: str) -> dict[str, str]:
    """A small JSON object of strings, such as department images."""
    text = spark.read.option("wholetext", True).text(path).first()[0]
    table = json.loads(text)
    if not isinstance(table, dict) or not all(isinstance(v, str) for v in table.values()):
        raise ValueError(f"{path} is not a JSON object of strings")
    return table


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write to a path that does not exist yet; an existing one is left alone and raises."""
    writer = df.write.mode("errorifexists")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    return path


def write_candidates(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Candidates sorted by user, order and product; a user's rows lie next to each other."""
    keys = ["user_id", "order_id", "product_id"]
    ranged = df.repartitionByRange(*keys) if partitions is None else df.repartitionByRange(partitions, *keys)
    return write_table(ranged.sortWithinPartitions(*keys), path)


def write_group_sizes(sizes: DataFrame, path: str, group: str = "order_id", count: str = "n_candidates") -> str:
    """Group sizes as text, one number per line in group order."""
    sizes.orderBy(group).select(F.col(count).cast("string").alias("value")).write.mode("errorifexists").text(path)
    return path


def save_factors(users: DataFrame, products: DataFrame, path: str) -> str:
    """Both factor tables with their ids, so that rows can never be attributed to the wrong side."""
    write_table(users, f"{path}/users")
    write_table(products, f"{path}/products")
    return path


def load_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/products")


def _write_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.option("wholetext", False).text(path).first()[0])


def save_ranker(spark: SparkSession, ranker: Ranker, path: str, k: int = 10, ndcg_at: Sequence[int] = (5, 10, 20)) -> str:
    """Trees as a table; feature list and schema facts as JSON."""
    schema = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double"
    write_table(spark.createDataFrame(tree_rows(ranker), schema).coalesce(1), f"{path}/trees")
    facts = {
        "group_key": "order_id",
        "id_cols": ["user_id", "order_id", "product_id"],
        "k": k,
        "ndcg_eval_at": list(ndcg_at),
        "best_iteration": ranker.best_round,
        "learning_rate": ranker.learning_rate,
        "features": ranker.features,
    }
    _write_json(spark, facts, f"{path}/metadata")
    return path


def load_ranker(spark: SparkSession, path: str) -> Ranker:
    facts = _read_json(spark, f"{path}/metadata")
    nodes = spark.read.parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
    trees = [
        Tree(*[part[c].tolist() for c in ("feature", "threshold", "left", "right", "value", "gain")]) for _, part in nodes.groupby("tree", sort=True)
    ]
    return Ranker(facts["features"], trees, facts["learning_rate"], best_round=facts["best_iteration"])


def save_classifier(spark: SparkSession, fit: QdaFit, path: str) -> str:
    """Preprocessing, full model and search result as JSON; a few numbers per feature."""
    model = fit.model
    value = {
        "preprocessing": fit.preprocessing.as_dict(),
        "prior": list(model.prior),
        "mean": [m.tolist() for m in model.mean],
        "axes": [a.tolist() for a in model.axes],
        "variances": [v.tolist() for v in model.variances],
        "reg": fit.reg,
        "cv_auc": fit.cv_auc,
        "search": fit.search,
    }
    _write_json(spark, value, path)
    return path


def load_classifier(spark: SparkSession, path: str) -> QdaFit:
    """The saved fit; fold models are not kept, as they only serve the training rows."""
    v = _read_json(spark, path)
    arrays = [tuple(np.asarray(x) for x in v[name]) for name in ("mean", "axes", "variances")]
    return QdaFit(Preprocessing(**v["preprocessing"]), QdaModel(tuple(v["prior"]), *arrays), {}, v["reg"], v["cv_auc"], [tuple(s) for s in v["search"]])
