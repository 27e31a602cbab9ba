"""Tables with null keys, orphan lines and changed files."""

import datetime as dt

import duckdb
import pytest
from check import difference

from basketry import session
from basketry.functions import positions
from basketry.functions.scalars import parse_id_list
from basketry.operators.explore import basket_summary
from basketry.plans import QUERIES
from basketry.plans.oracle import oracle
from basketry.sources import star
from basketry.sources import tables as T
from pyspark.sql import functions as F


def write(spark, folder, orders, lines):
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "a", "Brand#12", "PROMO")], "p_partkey long, p_name string, p_brand string, p_type string").write.mode("overwrite").parquet(f"{folder}/part.parquet")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


ORDERS = [(1, 7, day(0)), (2, 7, day(3)), (3, None, day(1)), (4, None, day(9)), (5, 7, None), (6, 8, None), (3_000_000_000, 8, day(2))]
LINES = [(1, 1, 1, 1), (1, 2, 1, 2), (2, 1, 1, 1), (3, 1, 1, 1), (4, 1, 1, 1), (5, None, 1, 1), (5, 1, 1, 2), (99, 1, 1, 1), (98, 1, 1, 1), (None, 1, 1, 1)]


@pytest.fixture
def folder(spark, tmp_path):
    write(spark, tmp_path, ORDERS, LINES)
    return str(tmp_path)


@pytest.mark.parametrize("limit", [positions.GROUP_LIMIT, 0])
def test_no_row_is_lost(spark, folder, monkeypatch, limit):
    """Both sides of the size switches return all rows, as SQL does."""
    monkeypatch.setattr(star, "GROUP_LIMIT", limit)
    monkeypatch.setattr(positions, "GROUP_LIMIT", limit)
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    tables = star.load_star(spark, folder)
    assert tables.orders.count() == len(ORDERS) and tables.line_facts.count() == len(LINES)
    assert difference(tables.orders, con, oracle("SELECT * FROM b_orders")) == ""
    assert tables.line_facts.where("user_id IS NULL AND order_number IS NULL").count() == 3
    assert tables.baskets.count() == len(LINES)


def test_positions_keep_null_groups(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (None, 2.0), (1, None)], "g long, v double")
    plain = positions.grouped_position(df, ["g"], F.floor("v"), [F.col("v")], "p", largest=4)
    sliced = positions.grouped_position(df, ["g"], F.floor("v"), [F.col("v")], "p")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, sliced.collect()), key=str)


def test_changed_tables_are_read_anew(spark, folder):
    assert QUERIES["s01_orders"](spark, folder).count() == len(ORDERS)
    write(spark, folder, [*ORDERS, (11, 5, day(4))], LINES)
    assert QUERIES["s01_orders"](spark, folder).count() == len(ORDERS) + 1


def test_too_long_ids_are_skipped(spark):
    row = spark.range(1).select(parse_id_list(F.lit("7, x,99999999999999999999999, 8")).alias("ids")).first()
    assert row["ids"] == [7, 8]


def test_basket_summary_copies_no_rows(spark):
    rows = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (2, 1, 1), (3, None, 1), (None, 2, None)], "order_id long, user_id long, product_id long")
    summary = basket_summary(rows)
    assert tuple(summary.first()) == (5, 3, 2, 2, 2)
    assert "Expand" not in summary._jdf.queryExecution().executedPlan().toString()
    assert tuple(basket_summary(rows, 0.01).first()) == (5, 3, 2, 2, 2)


CSV = """order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order
1,7,prior,1,2,8,
2,7,prior,40000,2,8,3.0
3,7,train,two,2,8,3.0
4,7,train,3
5,8,prior,1,2,8,1.5,extra
6,,prior,2,2,8,4.0
"""


def test_corrupt_csv_lines_are_counted_in_the_same_read(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(CSV)
    table, counts = T.load_checked_csv(spark, str(tmp_path), "orders")
    assert [tuple(r) for r in counts.collect()] == [("orders", 6, 4)]
    good = [tuple(r) for r in table.where(F.col(T.CORRUPT).isNull()).drop(T.CORRUPT).orderBy("order_id").collect()]
    assert good == [(1, 7, "prior", 1, 2, 8, None), (6, None, "prior", 2, 2, 8, 4.0)]
    assert {r[T.CORRUPT].split(",")[0] for r in table.where(F.col(T.CORRUPT).isNotNull()).collect()} == {"2", "3", "4", "5"}
    assert dict(table.dtypes)["order_number"] == "smallint"


def test_an_empty_csv_table(spark, tmp_path):
    (tmp_path / "aisles.csv").write_text("aisle_id,aisle\n")
    table, counts = T.load_checked_csv(spark, str(tmp_path), "aisles")
    assert table.count() == 0 and counts.first()["n_rows"] == 0


def test_bucketed_join_has_no_exchange(spark, data):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = QUERIES["s10_j05_bucketed_similarity"](spark, data)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_small_users_and_orders_travel_once(spark, folder):
    """The orders of a user are shuffled once, and lines reach the user's task packed by order."""
    tables = star.load_star(spark, folder)
    assert exchanges(tables.orders) == 1
    plan = tables._derived_facts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression [user_id") > plan.index("Generate posexplode")


@pytest.mark.parametrize("limit", [star.GROUP_LIMIT, 0])
def test_repeated_orders_repeat_their_lines(spark, tmp_path, monkeypatch, limit):
    """Packed or not, a line comes once per row of its order; the largest order counts its products."""
    monkeypatch.setattr(star, "GROUP_LIMIT", limit)
    monkeypatch.setattr(positions, "GROUP_LIMIT", limit)
    write(spark, tmp_path, [*ORDERS, ORDERS[0]], [*LINES, LINES[0], (2, 9, 3, None)])
    tables = star.load_star(spark, str(tmp_path), staged=True)
    got = sorted(tuple(r) for r in tables.line_facts.where("order_id < 3").select("order_id", "product_id", "add_to_cart_order").collect())
    assert got == [(1, 1, 1), (1, 1, 1), (1, 2, 2), (1, 2, 2), (2, 1, 2), (2, 9, 1)]
    assert tables.largest_order >= 2


def test_no_lines_at_all(spark, tmp_path):
    write(spark, tmp_path, ORDERS, [])
    tables = star.load_star(spark, str(tmp_path), staged=True)
    assert tables.line_facts.count() == 0 and tables.largest_order == 0


def test_partitions_grow_with_the_sources(spark):
    keys = (session.INITIAL_KEY, session.MERGED_KEY)
    old = [spark.conf.get(k, None) for k in keys]
    try:
        session.scale_shuffles(spark, 0)
        assert spark.conf.get(keys[0], None) == old[0]
        session.scale_shuffles(spark, 400 * session.SOURCE_BYTES)
        assert int(spark.conf.get(keys[0])) == 401 and spark.conf.get(keys[1]).startswith(str(session.MERGED_BYTES))
    finally:
        for k, v in zip(keys, old):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
