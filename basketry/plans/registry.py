"""The registered queries and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators import candidates as C
from basketry.operators import features as X
from basketry.operators import similarity as S
from basketry.plans.oracle import oracle
from basketry.session import materialize, path_exists, scale_shuffles, source_state
from basketry.sources.star import BasketTables, load_star

DECIMALS = 6


@dataclass(frozen=True, eq=False)
class Inputs:
    """Tables with parts as products (``natural``), and with parts folded onto their suppliers (``folded``), which users buy again."""

    spark: SparkSession
    path: str
    kept: list[str] = field(default_factory=list)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write a table that several queries use."""
        return materialize(df, label, kept=self.kept)

    @cached_property
    def natural(self) -> BasketTables:
        return load_star(self.spark, self.path, staged=True, kept=self.kept)

    @cached_property
    def folded(self) -> BasketTables:
        return load_star(self.spark, self.path, by_supplier=True, staged=True, kept=self.kept)

    def catalog(self, tables: BasketTables) -> DataFrame:
        return tables.products.join(tables.departments, "department_id", "left")

    def carts(self, tables: BasketTables) -> DataFrame:
        """The target orders as carts."""
        return tables.baskets.where("eval_set <> 'prior'").select(F.col("order_id").alias("cart_id"), "product_id")

    def prior(self, tables: BasketTables) -> DataFrame:
        return X.split(tables.line_facts, "prior")

    def prior_baskets(self, tables: BasketTables) -> DataFrame:
        return X.split(tables.baskets, "prior")

    def neighbors(self, tables: BasketTables, decimals: int | None = None) -> DataFrame:
        """Similarity edges, computed anew from the prior baskets."""
        baskets = self.prior_baskets(tables)
        support = materialize(S.product_support(baskets), "support")
        return S.top_neighbors(baskets, decimals=decimals, support=support, largest=tables.largest_order)

    @cached_property
    def natural_edges(self) -> DataFrame:
        return self.keep(self.neighbors(self.natural), "edges")

    @cached_property
    def folded_edges(self) -> DataFrame:
        return self.keep(self.neighbors(self.folded), "edges")

    def edges(self, tables: BasketTables) -> DataFrame:
        """The written similarity table."""
        return self.natural_edges if tables is self.natural else self.folded_edges

    @cached_property
    def totals(self) -> DataFrame:
        """The written totals per (user, product) of the folded prior lines."""
        return self.keep(X.pair_totals(self.prior(self.folded)), "pair-totals")

    @cached_property
    def written_pair_scores(self) -> DataFrame:
        return self.keep(self.pair_scores(), "pair-scores")

    def recent(self) -> DataFrame:
        """Products of each user's last prior order."""
        last = X.split(self.natural.orders, "prior").groupBy("user_id").agg(F.max_by("order_id", "order_number").alias("order_id"))
        return last.join(self.natural.basket_lines, "order_id").select("user_id", "product_id")

    def pair_scores(self) -> DataFrame:
        """Similarity aggregates of the history pairs; purchases / (1 + purchases) stands for the factor score."""
        scored = self.totals.select("user_id", "product_id", (F.col("n") / (1.0 + F.col("n"))).alias("als_score"))
        return S.pair_similarity(scored, self.totals, self.edges(self.folded))

    def base(self, split: str) -> DataFrame:
        return C.candidate_base(self.folded.orders, self.folded.baskets, split)

    def scored(self, split: str) -> DataFrame:
        """Candidates scored by the product's share in the user's history."""
        rates = X.pair_features(self.prior(self.folded), self.totals).select("user_id", "product_id", F.col("up_rate_in_user_history").alias("score"))
        orders = X.split(self.folded.orders, split).select("user_id", "order_id", *C.ORDER_COLUMNS)
        candidates = orders.join(rates.where(F.col("product_id").isNotNull()), "user_id")
        return C.attach_labels(candidates, X.split(self.folded.baskets, "train")) if split == "train" else candidates

    def full(self, split: str) -> DataFrame:
        """The candidate table with all features.

        Every feature reads the columns it needs of the totals per (user, product). Features of that
        grain are joined to the history, those of users to the target orders, before one is expanded to the other.
        """
        lines = self.prior(self.folded)
        history = X.pair_features(lines, self.totals).join(self.written_pair_scores, ["user_id", "product_id"])
        targets = X.split(self.folded.orders, split).join(X.user_features(lines, totals=self.totals), "user_id", "left")
        candidates = C.expand_candidates(targets, history, self.totals, X.USER_FEATURES)
        joined = C.attach_features(candidates, None, X.product_features(lines, self.totals))
        if split == "train":
            joined = C.attach_labels(joined, X.split(self.folded.baskets, "train"))
        return C.ordered_columns(joined)


SOURCES = ("orders", "lineitem", "part", "supplier", "nation", "region")
_INPUTS: dict[tuple[str, str], tuple[tuple, Inputs]] = {}


def inputs(spark: SparkSession, path: str) -> Inputs:
    """The inputs of a data folder; built anew if a source table has changed or one of their written tables is gone."""
    key = (spark.sparkContext.applicationId, path)
    state = source_state(spark, [p for t in SOURCES if path_exists(spark, p := f"{path.rstrip('/')}/{t}.parquet")])
    scale_shuffles(spark, sum(size for _, _, size, _ in state))
    known = _INPUTS.get(key)
    if known is None or known[0] != state or not all(path_exists(spark, p) for p in known[1].kept):
        _INPUTS[key] = known = (state, Inputs(spark, path))
    return known[1]


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers and flags as bigint, floats rounded: the types and precision that are compared."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), DECIMALS)
        columns.append(c.alias(f.name))
    return df.select(*columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query on ``Inputs``; ``sql`` is its check in DuckDB."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, path: plain_types(build(inputs(spark, path)))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register
