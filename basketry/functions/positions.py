"""Positions, running totals and quantiles that never put a whole group or table into one task.

A plain window over a hot group sorts that group in a single task. Here rows are cut into *slices*
that follow the sort order: one small aggregate counts the rows per slice, a window over those counts
gives each slice its offset, and the detailed window runs per (group, slice) only. Where a check has shown
that no group holds more than ``GROUP_LIMIT`` rows, the plain window is safe and saves those shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize

# Scores are compared after rounding to this many decimals, so that the order does not depend on the
# order in which a sum was taken.
SCORE_DECIMALS = 9
# With 9 decimals a slice of width 1e-4 holds at most 100,000 distinct scores.
SCORE_SLICES_PER_UNIT = 10_000
ID_SLICE = 100_000
RANGE_SLICES = 4096
# Rank error of approximate percentiles: one in so many.
ACCURACY = 10_000
# Groups of so few values are counted value by value.
COUNTED = 50_000

# Rows of a range of a sorted table.
SLICE_ROWS = 50_000

# Groups up to this many rows may be handled whole by one task.
GROUP_LIMIT = 1_000_000

_SLICE = "_slice"


def rounded(score: str | Column) -> Column:
    return F.round(F.col(score) if isinstance(score, str) else score, SCORE_DECIMALS)


def score_slice(score: str) -> Column:
    return F.floor(F.col(score) * SCORE_SLICES_PER_UNIT)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null equals null; the keys come from the left side once. No row is lost to a null key."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group; a small aggregate that runs at once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0


def grouped_position(
    df: DataFrame,
    group: Sequence[str],
    slice_by: Column,
    order: Sequence[Column],
    out: str,
    descending: bool = False,
    largest: int | None = None,
) -> DataFrame:
    """1-based position of every row in its group.

    ``slice_by`` must never decrease along ``order`` (never increase if ``descending``). ``largest`` is
    the size of the largest group, if it is known.
    """
    if group and largest is not None and largest <= GROUP_LIMIT:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    sliced = df.withColumn(_SLICE, slice_by)
    keys = [*group, _SLICE]
    slice_order = F.col(_SLICE).desc() if descending else F.col(_SLICE)
    before = Window.partitionBy(*group).orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        join_null_safe(sliced.withColumn("_inside", inside), offsets, keys)
        .withColumn(out, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop(_SLICE, "_inside", "_before")
    )


def in_ranges(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """``df`` written in ranges of ``keys``: ``_slice`` numbers the ranges in order, ``_nth`` the rows of each. Spark samples the edges, so
    ranges are about even however the values lie."""
    rows = materialize(df, "rows")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // SLICE_ROWS + 1)
    number = {_SLICE: F.spark_partition_id(), "_nth": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    return materialize(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns(number), "ranges")


def ranged_position(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """1-based position of every row in its group, for groups of any size and values of any distribution.

    The whole table is sorted once by ranges of (group, order); a position is the place in the range plus the rows of the group
    in the ranges before. ``order`` should end with a column that tells the rows of a group apart. Runs at once.
    """
    placed = in_ranges(df, [*[F.col(g).asc_nulls_first() for g in group], *order])
    keys = [*group, _SLICE]
    before = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_nth").alias("_first"))
    shifts = counts.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    found = join_null_safe(placed, shifts, keys).withColumn(out, (F.col("_nth") + F.col("_shift") + 1).cast("bigint"))
    return found.drop(_SLICE, "_nth", "_shift")


def running_totals(
    df: DataFrame, key: str, values: Sequence[str], slice_by: Column, group: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``cum_<value>`` (sum up to and including ``key``) and ``all_<value>`` (sum of the group).

    Rows must be unique per (group, key).
    """
    sliced = df.withColumn(_SLICE, slice_by)
    keys = [*group, _SLICE]

    def way(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    before = Window.partitionBy(*group).orderBy(way(_SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(way(key)).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    per_slice = sliced.groupBy(*keys).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    offsets = per_slice.select(
        *keys,
        *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_b_{v}") for v in values],
        *[F.sum(f"_s_{v}").over(whole).alias(f"all_{v}") for v in values],
    )
    joined = join_null_safe(sliced.select("*", *[F.sum(v).over(upto).alias(f"_i_{v}") for v in values]), offsets, keys)
    for v in values:
        joined = joined.withColumn(f"cum_{v}", F.col(f"_b_{v}") + F.col(f"_i_{v}"))
    return joined.drop(_SLICE, *[f"_b_{v}" for v in values], *[f"_i_{v}" for v in values])


def dense_index(df: DataFrame, id_col: str, out: str) -> DataFrame:
    """0-based index of the sorted distinct ids, however far they are apart."""
    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    placed = ranged_position(ids, [], [F.col(id_col)], out)
    return placed.select(id_col, (F.col(out) - 1).alias(out))


def quantiles(df: DataFrame, value: str, probs: dict[str, float], group: Sequence[str] = (), slice_by: Column | None = None) -> DataFrame:
    """Exact interpolated quantiles, one row per group with one column per entry of ``probs``.

    With ``slice_by``, which suits values with few distinct ones, the counts of all distinct values ``_v`` are summed up.
    Without, values are selected in two passes: approximate percentiles with a bounded rank error give a bracket around each
    quantile, and only the values inside are counted one by one, next to the number of values below the bracket. An outlier
    changes neither the brackets nor what is moved.
    """
    if slice_by is not None:
        counts = df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v")).agg(F.count("*").alias("n"))
        cumulative = running_totals(counts, "_v", ["n"], slice_by, group)
        return cumulative.groupBy(*group).agg(*quantile_sums(probs)).select(*group, *quantile_values(probs))
    inside, totals = brackets(df, value, probs, group)
    place = F.try_divide((F.col("_v") - F.col("_low")) * RANGE_SLICES, F.col("_high") - F.col("_low"))
    placed = running_totals(inside, "_v", ["n"], F.coalesce(F.floor(place), F.lit(0)), [*group, "_prob"])
    below = totals.select(*group, F.posexplode(F.array(*[F.col(f"_below_{k}") for k in range(len(probs))])).alias("_prob", "_below"), "_total")
    found = join_null_safe(placed, below, [*group, "_prob"])
    picks = []
    for k, (name, p) in enumerate(probs.items()):
        at = (F.col("_total") - 1) * F.lit(float(p))
        upto = F.col("_below") + F.col("cum_n")
        for end, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("_prob") == k) & (upto > position) & (upto - F.col("n") <= position)
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{end}_{name}"))
    return found.groupBy(*group).agg(*picks, F.max("_total").alias("_total")).select(*group, *quantile_values(probs))


def brackets(df: DataFrame, value: str, probs: dict[str, float], group: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(group, _prob, _v, n, _low, _high)``: the distinct values of the bracket around each quantile; and per group the numbers of all
    values (``_total``) and of those below each bracket (``_below_k``).

    ``percentile_approx`` errs by about one in ``ACCURACY`` ranks, so edges ten such steps away hold the wanted ranks between them.
    Groups of at most ``COUNTED`` values, where a step is less than a few ranks, are counted whole.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))
    step = 10.0 / ACCURACY
    wanted = [min(max(p + side * step, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    approximate = F.percentile_approx("_v", [float(p) for p in wanted], ACCURACY)
    edges = rows.groupBy(*group).agg(F.struct(approximate.alias("at"), F.count("*").alias("n")).alias("_edges"))
    if group:
        known = join_null_safe(rows, edges, list(group))
    else:
        known = rows.withColumn("_edges", edges.scalar())
    # The first and the last bracket reach to the ends, where an edge may lie inside.
    large = F.col("_edges.n") > COUNTED
    below = [large & (F.col("_v") < F.col("_edges.at")[2 * k]) if p > step else F.lit(False) for k, p in enumerate(probs.values())]
    above = [large & (F.col("_v") > F.col("_edges.at")[2 * k + 1]) if p < 1 - step else F.lit(False) for k, p in enumerate(probs.values())]
    totals = known.groupBy(*group).agg(F.count("*").alias("_total"), *[F.count_if(b).alias(f"_below_{k}") for k, b in enumerate(below)])
    held = F.array(*[F.struct(F.lit(k).alias("_prob"), (~b & ~a).alias("_in")) for k, (b, a) in enumerate(zip(below, above))])
    chosen = known.where(F.exists(held, lambda e: e["_in"])).select(*group, "_v", F.inline(held)).where("_in")
    counts = chosen.groupBy(*group, "_prob", "_v").agg(F.count("*").alias("n"))
    ends = counts.groupBy(*group, "_prob").agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    return join_null_safe(counts, ends, [*group, "_prob"]), totals


def quantile_sums(probs: dict[str, float]) -> list[Column]:
    """Aggregates over distinct values ``_v`` with ``n``, ``cum_n`` and ``all_n``; see ``quantile_values``."""
    picks = []
    for name, p in probs.items():
        place = (F.col("all_n") - 1) * F.lit(float(p))
        for end, position in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("cum_n") > position) & (F.col("cum_n") - F.col("n") <= position)
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{end}_{name}"))
    return [*picks, F.max("all_n").alias("_total")]


def quantile_values(probs: dict[str, float]) -> list[Column]:
    """Interpolation between the two values that ``quantile_sums`` picked."""
    values = []
    for name, p in probs.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        values.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return values
