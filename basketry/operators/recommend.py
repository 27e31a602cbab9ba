"""Recommendation lists for all users or carts at once.

A cart is a set of rows ``(cart_id, product_id)``. Every list has a score or order and a ``rank``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.positions import ID_SLICE, grouped_position, rounded
from basketry.functions.scalars import MISSING, lookup, normalized_key, purchase_badge, synthetic_title
from basketry.operators.metrics import top_k_per_group
from basketry.operators.quality import require_columns

# Column names under which a catalog may keep its titles, best first.
TITLE_NAMES = ["title", "product_name"]
# End of the fixed values.

RUN = 1024


def neighbors_of_recent(recent: DataFrame, edges: DataFrame, n: int = 10, agg: str = "sum") -> DataFrame:
    """Candidates from each user's recent products: neighbor scores summed or maximised.

    Recent products are left out; equal scores go by the product id as text.
    """
    if agg not in ("sum", "max"):
        raise ValueError("agg is 'sum' or 'max'")
    recent = recent.select("user_id", "product_id").distinct()
    reached = recent.join(edges.select("product_id", "neighbor_product_id", "score"), "product_id").select(
        "user_id", F.col("neighbor_product_id").alias("product_id"), "score"
    )
    combine = F.sum if agg == "sum" else F.max
    scored = reached.groupBy("user_id", "product_id").agg(combine("score").alias("score")).join(recent, ["user_id", "product_id"], "left_anti")
    return top_k_per_group(scored, ["user_id"], [rounded("score").desc(), F.col("product_id").cast("string")], n)


def similar_to_product(views: DataFrame, carts: DataFrame, edges: DataFrame, k: int = 8) -> DataFrame:
    """For each viewed (cart, product): the first ``2k`` neighbors, without the cart, cut to ``k``."""
    in_cart = carts.select("cart_id", F.col("product_id").alias("neighbor_product_id")).distinct()
    listed = views.select("cart_id", "product_id").join(edges.where(F.col("rank") <= 2 * k).withColumnRenamed("rank", "_at"), "product_id")
    kept = listed.join(in_cart, ["cart_id", "neighbor_product_id"], "left_anti")
    top = top_k_per_group(kept, ["cart_id", "product_id"], [F.col("_at")], k)
    return top.select("cart_id", "product_id", "neighbor_product_id", "score", "rank")


def similar_to_cart(carts: DataFrame, edges: DataFrame, per_item: int = 4, cap: int = 16) -> DataFrame:
    """The best score of each neighbor over the cart's products, without the cart, cut to ``cap``."""
    items = carts.select("cart_id", "product_id").distinct()
    reached = items.join(edges.where(F.col("rank") <= 3 * per_item), "product_id").select("cart_id", F.col("neighbor_product_id").alias("product_id"), "score")
    best = reached.groupBy("cart_id", "product_id").agg(F.max("score").alias("score")).join(items, ["cart_id", "product_id"], "left_anti")
    return top_k_per_group(best, ["cart_id"], [rounded("score").desc(), F.col("product_id")], cap)


def without(df: DataFrame, *excluded: DataFrame, keys: Sequence[str] = ("user_id", "product_id")) -> DataFrame:
    """Rows whose keys are in none of the excluded tables."""
    return reduce(lambda kept, other: kept.join(other.select(*keys).distinct(), list(keys), "left_anti"), excluded, df)


def ranked_for_users(scored: DataFrame, catalog: DataFrame, *excluded: DataFrame, k: int = 12) -> DataFrame:
    """Best scored candidates per user without excluded products, with the catalog columns."""
    kept = without(scored.select("user_id", "product_id", "score"), *excluded)
    top = top_k_per_group(kept, ["user_id"], [rounded("score").desc(), F.col("product_id")], k)
    return with_catalog(top, catalog)


def with_catalog(df: DataFrame, catalog: DataFrame) -> DataFrame:
    return df.join(catalog.dropDuplicates(["product_id"]), "product_id", "left")


def filtered_ranking(
    scored: DataFrame, catalog: DataFrame, carts: DataFrame | None = None, department: str | None = None, aisles: Sequence[int] | None = None, k: int = 10
) -> DataFrame:
    """Ranking per (user, order) after the optional cart, department and aisle filters."""
    rows = with_catalog(scored, catalog)
    if carts is not None:
        rows = without(rows, carts.withColumnRenamed("cart_id", "order_id"), keys=("order_id", "product_id"))
    if department is not None:
        rows = rows.where(F.col("department") == department)
    if aisles:
        rows = rows.where(F.col("aisle_id").isin(list(aisles)))
    return top_k_per_group(rows, ["user_id", "order_id"], [rounded("score").desc(), F.col("product_id")], k)


def department_ranks(catalog: DataFrame) -> DataFrame:
    """Departments by number of products, largest first; equal ones by name. The window sees one row per department."""
    counts = catalog.groupBy("department").agg(F.count("*").alias("n_products"))
    window = Window.orderBy(F.col("n_products").desc(), F.col("department"))
    return counts.withColumn("department_rank", F.row_number().over(window).cast("bigint"))


def _places(catalog: DataFrame, group: Sequence[str]) -> DataFrame:
    """Position of each product in catalog order (by id) within its group."""
    keyed = catalog.select(*group, "product_id").distinct()
    return grouped_position(keyed, group, F.floor(F.col("product_id") / ID_SLICE), [F.col("product_id")], "place")


def _one_to(n: Column) -> Column:
    """Numbers 1..n in runs of ``RUN``, to be exploded twice, so that no array grows with ``n``."""
    return F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / RUN)), lambda r: F.struct((r * RUN + 1).alias("low"), F.least((r + 1) * RUN, n).alias("high")))


def _with_places(lists: DataFrame, n: Column) -> DataFrame:
    """Each list row once per place 1..n."""
    runs = lists.withColumn("_run", F.explode(_one_to(n)))
    return runs.withColumn("place", F.explode(F.sequence("_run.low", "_run.high"))).drop("_run")


def _first_outside(lists: DataFrame, placed: DataFrame, carts: DataFrame, on: Sequence[str], k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` products of each list that are not in its cart.

    ``lists`` holds (cart_id, on..., n_inside). At most ``n_inside`` places are taken by the cart, so
    the first ``k + n_inside`` places suffice; they are looked up by place, not by joining whole groups.
    """
    wanted = _with_places(lists, F.col("n_inside") + k).select("cart_id", *on, "place")
    found = wanted.join(placed, [*on, "place"])
    kept = found.join(carts.select("cart_id", "product_id").distinct(), ["cart_id", "product_id"], "left_anti")
    return top_k_per_group(kept, ["cart_id"], order, k)


def cart_departments(carts: DataFrame, catalog: DataFrame) -> DataFrame:
    items = carts.select("cart_id", "product_id").distinct().join(catalog.select("product_id", "department"), "product_id")
    return items.groupBy("cart_id", "department").agg(F.count("*").alias("n_inside"))


def fallback_by_cart_departments(carts: DataFrame, catalog: DataFrame, k: int = 8, all_carts: DataFrame | None = None) -> DataFrame:
    """First products, in catalog order, of the departments found in the cart.

    ``all_carts`` may list further cart ids; those without products get the head of the catalog.
    """
    placed = _places(catalog, ["department"])
    lists = _first_outside(cart_departments(carts, catalog), placed, carts, ["department"], k, [F.col("product_id")])
    lists = lists.select("cart_id", "product_id", "rank")
    if all_carts is None:
        return lists
    head = top_k_per_group(catalog.select(F.lit(0).alias("_all"), "product_id").distinct(), ["_all"], [F.col("product_id")], k)
    empty = all_carts.select("cart_id").distinct().join(carts.select("cart_id").distinct(), "cart_id", "left_anti")
    # The head is at most k rows, and it is attached as one array.
    array = head.agg(F.sort_array(F.collect_list(F.struct("rank", "product_id"))).alias("h")).scalar()
    heads = empty.withColumn("h", array).select("cart_id", F.inline("h")).select("cart_id", "product_id", "rank")
    return lists.unionByName(heads)


def fallback_by_popular_departments(carts: DataFrame, catalog: DataFrame, k: int = 8) -> DataFrame:
    """First products outside the cart, departments with most products first."""
    ranks = department_ranks(catalog)
    keyed = catalog.select("department", "product_id").distinct().join(ranks.select("department", "department_rank"), "department")
    slices = F.struct("department_rank", F.floor(F.col("product_id") / ID_SLICE))
    placed = grouped_position(keyed, [], slices, [F.col("department_rank"), F.col("product_id")], "place")
    lists = carts.select("cart_id", "product_id").distinct().groupBy("cart_id").agg(F.count("*").alias("n_inside"))
    found = _first_outside(lists, placed, carts, [], k, [F.col("place")])
    return found.select("cart_id", "product_id", "department", "rank")


def fallback_same_department(views: DataFrame, carts: DataFrame, catalog: DataFrame, k: int = 4) -> DataFrame:
    """For each viewed (cart, product): other products of its department that are not in the cart."""
    items = carts.select("cart_id", "product_id").distinct()
    seen = views.select("cart_id", "product_id").distinct().join(catalog.select("product_id", "department"), "product_id")
    inside = cart_departments(carts, catalog)
    shelves = seen.select("cart_id", "department").distinct().join(inside, ["cart_id", "department"], "left")
    # One place more than k, as the viewed product itself may come first.
    reach = F.coalesce("n_inside", F.lit(0)) + k + 1
    wanted = _with_places(shelves, reach).select("cart_id", "department", "place")
    found = wanted.join(_places(catalog, ["department"]), ["department", "place"]).join(items, ["cart_id", "product_id"], "left_anti")
    short = top_k_per_group(found, ["cart_id", "department"], [F.col("place")], k + 1, "_at").select(
        "cart_id", "department", F.col("product_id").alias("similar_product_id"), "place"
    )
    pairs = seen.join(short, ["cart_id", "department"]).where(F.col("similar_product_id") != F.col("product_id"))
    top = top_k_per_group(pairs, ["cart_id", "product_id"], [F.col("place")], k)
    return top.select("cart_id", "product_id", "similar_product_id", "rank")


def blended(lists: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """Lists in order of precedence: a product stays in the first list that shows it, and each list is cut to its length.

    Each entry is (source, rows of ``user_id, product_id, score, rank``, length).
    """
    shown: DataFrame | None = None
    for source, rows, length in lists:
        fresh = rows if shown is None else without(rows, shown)
        top = top_k_per_group(fresh.withColumnRenamed("rank", "_at"), ["user_id"], [F.col("_at"), F.col("product_id")], length)
        part = top.select("user_id", F.lit(source).alias("source"), "product_id", F.col("score").cast("double").alias("score"), "rank")
        shown = part if shown is None else shown.unionByName(part)
    if shown is None:
        raise ValueError("no list to blend")
    return shown


def with_purchase_stats(items: DataFrame, history: DataFrame) -> DataFrame:
    """Purchases of the user shown with each product, and the badge text."""
    stats = history.select("user_id", "product_id", "purchase_count", "reordered")
    return items.join(stats, ["user_id", "product_id"], "left").withColumn("badge", purchase_badge(F.col("purchase_count")))


def catalog_with_images(products: DataFrame, departments: DataFrame, images: dict[str, str], default: str = MISSING) -> DataFrame:
    """Products with their department name and the image path of the department."""
    joined = products.join(departments, "department_id", "left")
    return joined.withColumn("image_path", lookup(normalized_key(F.col("department")), images, default))


def clean_catalog(df: DataFrame) -> DataFrame:
    """Title from the first known title column, normalised department, complete rows only."""
    require_columns(df, ["product_id", "department"], "catalog")
    name = next((c for c in TITLE_NAMES if c in df.columns), None)
    title = synthetic_title(None if name is None else F.col(name), F.col("product_id"))
    cleaned = df.withColumns({"title": title, "department": normalized_key(F.col("department"))})
    extra = [c for c in ("aisle_id", "image_path") if c in df.columns]
    return cleaned.select("product_id", "title", "department", *extra).dropna(subset=["product_id", "title", "department"])


def search_catalog(catalog: DataFrame, text: str, literal: bool = False) -> DataFrame:
    """Case-insensitive title search, by regular expression or as literal text; null titles never match."""
    title = F.col("title")
    return catalog.where(F.contains(F.lower(title), F.lit(text.lower())) if literal else title.rlike(f"(?i){text}"))


def page_of(df: DataFrame, order: Sequence[Column], page: int, size: int = 50) -> tuple[DataFrame, int, int]:
    """One page, the page shown and the number of pages; a page out of range resets to the first."""
    pages = max(1, -(-df.count() // size))
    page = page if 1 <= page <= pages else 1
    return df.orderBy(*order).offset((page - 1) * size).limit(size), page, pages
