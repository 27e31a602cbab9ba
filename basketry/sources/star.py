"""Adapter: star-schema Parquet tables as basket tables.

``orders``, ``lineitem`` and ``part`` become the order history the operators work on. With ``by_supplier`` the products are
suppliers, their aisles nations and their departments regions: there are far fewer of them than parts, so that users buy
them again, and they grow with the data. Nothing is filtered.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.positions import GROUP_LIMIT, grouped_position, join_null_safe, largest_group
from basketry.session import materialize

# The department number of each part type.
DEPARTMENT_NUMBERS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}

# Positions in a cart are computed per run of this many line numbers.
LINE_SLICE = 64

# Orders of at most this many lines travel as one row, if no user has more orders than this. Groups are counted in that many parts
# to see it.
PACK_LIMIT = 100_000
COUNTED_PARTS = 1 << 16


@dataclass(frozen=True, eq=False)
class BasketTables:
    """The six base tables, built on first use.

    With ``staged`` the two derived fact tables are written to the shared folder when first needed, the
    lines by split, so that each later query scans just its columns and splits of them. The paths
    are listed in ``kept``.
    """

    spark: SparkSession
    path: str
    by_supplier: bool = False
    staged: bool = False
    kept: list[str] = field(default_factory=list)

    def _scan(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path.rstrip('/')}/{table}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        orders = self._derived_orders()
        return materialize(orders, "orders", kept=self.kept) if self.staged else orders

    def _derived_orders(self) -> DataFrame:
        """One row per order with its sequence number, split and gap to the previous order.

        Orders without a user count as those of one unknown user, and orders without a date come last. The
        calendar of each user (one row per user and day) carries the sequence offset and the
        previous day, so only the orders of a single day are sorted together.
        """
        raw = self._scan("orders").select(
            F.col("o_orderkey").cast("bigint").alias("order_id"),
            F.col("o_custkey").cast("bigint").alias("user_id"),
            F.col("o_orderdate").alias("placed"),
            F.to_date("o_orderdate").alias("day"),
        )
        if self.small_users:
            # One shuffle: the orders of a user are sorted by one task.
            listed = Window.partitionBy("user_id").orderBy(*[F.asc_nulls_last(c) for c in ("day", "placed", "order_id")])
            numbered = raw.withColumns(
                {
                    "number": F.row_number().over(listed).cast("bigint"),
                    "n_orders": F.count("*").over(Window.partitionBy("user_id")),
                    "gap": F.datediff("day", F.lag("day").over(listed)),
                }
            )
            return self._order_columns(numbered, F.col("number"), F.col("gap"))
        by_day = Window.partitionBy("user_id").orderBy(F.asc_nulls_last("day"))
        whole = Window.partitionBy("user_id")
        calendar = (
            raw.groupBy("user_id", "day")
            .agg(F.count("*").alias("n"))
            .select(
                "user_id",
                "day",
                F.coalesce(F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                F.sum("n").over(whole).alias("n_orders"),
                F.lag("day").over(by_day).alias("previous_day"),
            )
        )
        in_day = F.row_number().over(Window.partitionBy("user_id", "day").orderBy(F.asc_nulls_last("placed"), F.asc_nulls_last("order_id")))
        placed = join_null_safe(raw.withColumn("in_day", in_day), calendar, ["user_id", "day"])
        number = (F.col("before") + F.col("in_day")).cast("bigint")
        gap = F.when((F.col("in_day") > 1) & F.col("day").isNotNull(), F.lit(0)).otherwise(F.datediff("day", "previous_day"))
        return self._order_columns(placed, number, gap)

    @staticmethod
    def _order_columns(placed: DataFrame, number: Column, gap: Column) -> DataFrame:
        return placed.select(
            "order_id",
            "user_id",
            F.when(number < F.col("n_orders"), "prior").when(F.col("user_id") % 5 < 3, "train").otherwise("test").alias("eval_set"),
            number.alias("order_number"),
            (F.dayofweek("day") - 1).cast("bigint").alias("order_dow"),
            (F.col("order_id") % 24).alias("order_hour_of_day"),
            (gap % 31).cast("double").alias("days_since_prior_order"),
        )

    def _fullest_part(self, table: str, key: str) -> int:
        """Rows of the fullest part of the keys' hash, so at least those of the largest group. Only one count per part is moved."""
        part = F.pmod(F.xxhash64(key), F.lit(COUNTED_PARTS))
        return largest_group(self._scan(table).select(part.alias("part")), ["part"])

    @cached_property
    def small_orders(self) -> bool:
        limit = min(GROUP_LIMIT, PACK_LIMIT)
        return self._fullest_part("lineitem", "l_orderkey") <= limit or self._most_lines <= limit

    @cached_property
    def small_users(self) -> bool:
        limit = min(GROUP_LIMIT, PACK_LIMIT)
        return self._fullest_part("orders", "o_custkey") <= limit or self.largest_user <= limit

    @cached_property
    def largest_order(self) -> int:
        """At least the products of the largest order: as seen when the lines were written, else its line items."""
        seen = self._staged_lines[1].get if self.staged and self.small_orders and self.small_users else {}
        if seen.get("largest") is not None:
            return seen["largest"]
        return self._most_lines

    @cached_property
    def _most_lines(self) -> int:
        return largest_group(self._scan("lineitem").select("l_orderkey"), ["l_orderkey"])

    @cached_property
    def largest_user(self) -> int:
        """Orders of the user with most orders."""
        return largest_group(self._scan("orders").select("o_custkey"), ["o_custkey"])

    @cached_property
    def basket_lines(self) -> DataFrame:
        """Distinct (order, product)."""
        return (self.line_facts if self.staged else self._derived_lines()).select("order_id", "product_id")

    def _derived_lines(self) -> DataFrame:
        """Distinct (order, product) with the first line number.

        If all orders are small, lines are shuffled by order once, and the later steps by order find
        them in place; else by (order, product), which spreads large orders.
        """
        lines = self._scan("lineitem").select(
            F.col("l_orderkey").cast("bigint").alias("order_id"),
            F.col("l_suppkey" if self.by_supplier else "l_partkey").cast("bigint").alias("product_id"),
            "l_linenumber",
        )
        if self.small_orders or self._most_lines <= GROUP_LIMIT:
            lines = lines.repartition("order_id")
        return lines.groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("first_line"))

    @cached_property
    def baskets(self) -> DataFrame:
        """Distinct (order, user, product, split) without cart position and reorder flag."""
        if self.staged:
            return self.line_facts.select("order_id", "product_id", "user_id", "eval_set", "order_number")
        return self._derived_lines().select("order_id", "product_id").join(self._basket_keys(), "order_id", "left")

    def _basket_keys(self) -> DataFrame:
        return self.orders.select("order_id", "user_id", "eval_set", "order_number")

    @cached_property
    def line_facts(self) -> DataFrame:
        return self._staged_lines[0] if self.staged else self._derived_facts()

    @cached_property
    def _staged_lines(self) -> tuple[DataFrame, Observation]:
        """The written lines, and the products of the largest order as ``largest`` if orders were packed."""
        seen = Observation()
        return materialize(self._derived_facts(seen), "lines", split_by="eval_set", kept=self.kept), seen

    def _packed_facts(self, seen: Observation | None) -> DataFrame:
        """The same as ``_derived_facts``: an order and its products go to the user's task as one row."""
        lines = F.sort_array(F.collect_list(F.struct("first_line", "product_id")))
        packed = self._derived_lines().groupBy("order_id").agg(lines.alias("_lines")).select("order_id", F.col("_lines.product_id").alias("_items"))
        if seen is not None:
            packed = packed.observe(seen, F.max(F.size("_items")).alias("largest"))
        # Orders without a row in the orders table are spread, since all of them together may be a large group.
        unknown = F.when(F.col("user_id").isNull() & F.col("order_number").isNull(), F.col("order_id"))
        owned = packed.join(self.orders, "order_id", "left").withColumn("_unknown", unknown).repartition("user_id", "_unknown")
        rows = owned.select("*", F.posexplode("_items").alias("_at", "product_id")).drop("_items")
        first_number = F.min("order_number").over(Window.partitionBy("user_id", "_unknown", "product_id"))
        return self._fact_columns(rows.withColumns({"add_to_cart_order": (F.col("_at") + 1).cast("bigint"), "first_number": first_number}))

    def _derived_facts(self, seen: Observation | None = None) -> DataFrame:
        """Line items with the columns of their order, one row per (order, product); without an order, these are null."""
        if self.small_orders and self.small_users:
            return self._packed_facts(seen)
        placed = grouped_position(
            self._derived_lines(),
            ["order_id"],
            F.floor(F.col("first_line") / LINE_SLICE),
            [F.col("first_line"), F.col("product_id")],
            "add_to_cart_order",
            largest=self.largest_order,
        )
        joined = placed.drop("first_line").join(self.orders, "order_id", "left")
        if self.largest_user <= GROUP_LIMIT:
            # A user has a product at most once per order, which bounds the group.
            # Lines without a user are spread by their order, since all of them together may be a large group.
            unknown = F.when(F.col("user_id").isNull() & F.col("order_number").isNull(), F.col("order_id"))
            first_number = F.min("order_number").over(Window.partitionBy("user_id", "product_id", unknown))
            joined = joined.withColumn("first_number", first_number)
        else:
            owned = self._derived_lines().select("order_id", "product_id").join(self._basket_keys(), "order_id")
            first = owned.groupBy("user_id", "product_id").agg(F.min("order_number").alias("first_number"))
            joined = join_null_safe(joined, first, ["user_id", "product_id"], "left")
        return self._fact_columns(joined)

    @staticmethod
    def _fact_columns(joined: DataFrame) -> DataFrame:
        return joined.select(
            "order_id",
            "product_id",
            "add_to_cart_order",
            (F.col("order_number") > F.col("first_number")).cast("bigint").alias("reordered"),
            "user_id",
            "eval_set",
            "order_number",
            "order_dow",
            "order_hour_of_day",
            "days_since_prior_order",
        )

    @cached_property
    def order_products(self) -> DataFrame:
        return self.line_facts.select("order_id", "product_id", "add_to_cart_order", "reordered", "eval_set")

    @cached_property
    def products(self) -> DataFrame:
        """One row per product."""
        if self.by_supplier:
            nations = self._scan("nation").select(F.col("n_nationkey").cast("bigint").alias("aisle_id"), F.col("n_regionkey").cast("bigint").alias("department_id"))
            suppliers = self._scan("supplier").select(
                F.col("s_suppkey").cast("bigint").alias("product_id"), F.col("s_name").alias("product_name"), F.col("s_nationkey").cast("bigint").alias("aisle_id")
            )
            return suppliers.join(nations, "aisle_id", "left").select("product_id", "product_name", "aisle_id", "department_id")
        return self._scan("part").select(
            F.col("p_partkey").cast("bigint").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("aisle_id"),
            self._department("p_type").alias("department_id"),
        )

    @staticmethod
    def _department(column: str) -> Column:
        number = F.lit(None).cast("bigint")
        for name, value in DEPARTMENT_NUMBERS.items():
            number = F.when(F.col(column) == name, F.lit(value).cast("bigint")).otherwise(number)
        return number

    @cached_property
    def aisles(self) -> DataFrame:
        if self.by_supplier:
            return self._scan("nation").select(F.col("n_nationkey").cast("bigint").alias("aisle_id"), F.col("n_name").alias("aisle"))
        return (
            self._scan("part")
            .select(F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint").alias("aisle_id"), F.col("p_brand").alias("aisle"))
            .distinct()
        )

    @cached_property
    def departments(self) -> DataFrame:
        if self.by_supplier:
            return self._scan("region").select(F.col("r_regionkey").cast("bigint").alias("department_id"), F.col("r_name").alias("department"))
        return self._scan("part").select(self._department("p_type").alias("department_id"), F.col("p_type").alias("department")).distinct()

    def as_dict(self) -> dict[str, DataFrame]:
        lines = self.order_products
        return {
            "orders": self.orders,
            "order_products_prior": lines.where("eval_set = 'prior'").drop("eval_set"),
            "order_products_train": lines.where("eval_set = 'train'").drop("eval_set"),
            "products": self.products,
            "aisles": self.aisles,
            "departments": self.departments,
        }


def load_star(spark: SparkSession, path: str, by_supplier: bool = False, staged: bool = False, kept: list[str] | None = None) -> BasketTables:
    return BasketTables(spark, path, by_supplier, staged, [] if kept is None else kept)
