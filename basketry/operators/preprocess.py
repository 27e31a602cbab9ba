"""Feature preprocessing: log of skewed columns, median imputation, standardisation, folds, samples."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from basketry.functions.positions import grouped_position
from basketry.functions.scalars import log1p_floor0
from basketry.session import materialize

# Columns that are never log-transformed.
UNLOGGED = [
    "als_score",
    "sim_mean",
    "sim_topk_mean_10",
    "sim_max",
    "sim_nonzero_cnt",
    "u_reorder_ratio",
    "p_reorder_prob",
    "up_rate_in_user_history",
]
# End of the fixed values.

HASH_BITS = 44


DIGIT = 16  # bits of a key that one pass over the values settles
CHUNK = 1 << 17  # rows that a task looks at together
PARTIAL = {"column_name": "string", "n_rows": "long", "n_bad": "long", "n": "long", "mean": "double", "m2": "double", "m3": "double"}


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches put together to about so many rows, so that what is done once a batch is done seldom."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_rows, n_bad, n, mean, m2, m3``: per column the number of rows, of missing or infinite values and of values, the mean of
    these and the sums of squared and cubed deviations from it.

    Each batch of rows gives one row per column, and one small aggregate combines them, so no cell is moved.
    """
    columns = list(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for name, column in zip(columns, batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                finite = np.isfinite(x)
                found = {"column_name": name, "n_rows": len(column), "n_bad": len(column) - int(finite.sum()), "n": len(x)}
                if len(x):
                    # Deviations from one of the values, so that a constant has no spread at all.
                    near = x[finite.argmax()] if finite.any() else 0.0
                    with np.errstate(invalid="ignore", over="ignore"):
                        found["mean"] = near + (x - near).mean()
                        off = x - found["mean"]
                        found |= {"m2": (off * off).sum(), "m3": (off * off * off).sum()}
                rows.append(found)
            if batch.num_rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    kinds = [(name, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[kind]) for name, kind in PARTIAL.items()]
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(partial, ", ".join(f"{name} {kind}" for name, kind in PARTIAL.items()))
    whole = Window.partitionBy("column_name")
    near = F.coalesce(F.min(F.when(F.abs("mean") < float("inf"), F.col("mean"))).over(whole), F.lit(0.0))
    mean = F.col("_near") + F.sum(F.col("n") * (F.col("mean") - F.col("_near"))).over(whole) / F.sum("n").over(whole)
    parts = parts.withColumn("_near", near).withColumn("_mean", F.when(F.sum("n").over(whole) > 0, mean))
    off = F.col("mean") - F.col("_mean")
    return parts.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_bad", "n")],
        F.max("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
        F.sum(F.col("m3") + 3 * off * F.col("m2") + F.col("n") * off * off * off).alias("m3"),
    )


def skewed_columns(df: DataFrame, columns: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Bias-adjusted skewness of each column and whether it is to be logged.

    Columns with a missing or infinite value or without spread are not selected.
    """
    return skewness(moments(df, columns), threshold).select("column_name", "skew", "is_skewed")


def skewness(found: DataFrame, threshold: float) -> DataFrame:
    """``moments`` with ``skew`` and ``is_skewed``."""
    n = F.col("n_rows").cast("double")
    g1 = F.sqrt(n) * F.col("m3") / F.pow("m2", F.lit(1.5))
    adjusted = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    usable = (F.col("n_bad") == 0) & (F.col("m2") > 0) & (n > 2)
    skewed = found.withColumn("skew", F.when(usable, adjusted))
    return skewed.withColumn("is_skewed", F.coalesce(F.col("skew") > threshold, F.lit(False)))


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: log1p_floor0(F.col(c)) for c in columns if c in df.columns})


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(cells))


def ordered_keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers that sort as the floats do; both zeros are one, and NaN is the largest, as in Spark."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return (bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.uint64) ^ np.uint64(1 << 63)


def float_of(key: int) -> float:
    """The float of one of ``ordered_keys``."""
    bits = np.array([key ^ (1 << 63)], np.uint64).view(np.int64)
    return float((bits ^ ((bits >> 63) & np.int64(2**63 - 1))).view(np.float64)[0])


def digit_counts(df: DataFrame, known: dict[str, set[int]], digit: int) -> pd.DataFrame:
    """``column_name, prefix, cell, n, low, high``: how many values whose key starts with a known prefix go on with each ``cell``, and the
    smallest and the largest of them."""
    shift, cells = 64 - DIGIT * (digit + 1), 1 << DIGIT

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in chunks(batches):
            for (name, prefixes), column in zip(known.items(), batch.columns):
                keys = ordered_keys(column.drop_null().to_numpy(zero_copy_only=False))
                for prefix in prefixes:
                    inside = np.sort(keys[keys >> np.uint64(shift + DIGIT) == prefix] if digit else keys)
                    if not len(inside):
                        continue
                    cell = ((inside >> np.uint64(shift)) & np.uint64(cells - 1)).astype(np.int64)
                    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                    ends = np.r_[starts[1:], len(cell)]
                    if (name, prefix) not in sums:
                        sums[name, prefix] = np.zeros(cells, np.int64), np.full(cells, 2**64 - 1, np.uint64), np.zeros(cells, np.uint64)
                    n, low, high = sums[name, prefix]
                    at = cell[starts]
                    n[at] += ends - starts
                    low[at] = np.minimum(low[at], inside[starts])
                    high[at] = np.maximum(high[at], inside[ends - 1])
        for (name, prefix), (n, low, high) in sums.items():
            at = np.flatnonzero(n)
            # As signed numbers that sort alike.
            edges = [pa.array((side[at] ^ np.uint64(1 << 63)).view(np.int64)) for side in (low, high)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(np.full(len(at), prefix, np.int64)), pa.array(at), pa.array(n[at]), *edges], names)

    names = ["column_name", "prefix", "cell", "n", "low", "high"]
    counted = df.select(*[F.col(c).cast("double").alias(c) for c in known]).mapInArrow(count, "column_name string, prefix long, cell long, n long, low long, high long")
    return counted.groupBy(*names[:3]).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toPandas()


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column with a value, from at most as many passes over ``df`` as a float has digits of ``DIGIT`` bits.

    A pass counts how the keys of the values go on that share the digits of the median so far. What leaves the tasks, and what the
    driver sees, are at most two times ``2 ** DIGIT`` counts per column and pass, however the values lie. A column is done when all
    values that share these digits are equal, and later passes leave it out.
    """
    wanted: dict[str, list[tuple[int, int]]] = {}  # (prefix, rank below it) of both middle values that are still open
    middle: dict[str, list[int | None]] = {}  # keys of both middle values
    known = {c: {0} for c in columns}
    for digit in range(64 // DIGIT):
        if not known:
            break
        counts = digit_counts(df, known, digit)
        if digit == 0:
            sizes = counts.groupby("column_name")["n"].sum()
            wanted = {c: [(0, (int(n) - 1) // 2), (0, int(n) // 2)] for c, n in sizes.items()}
            middle = {c: [None, None] for c in wanted}
        parts = {key: part.sort_values("cell") for key, part in counts.groupby(["column_name", "prefix"])}
        for c in known:
            for k, (prefix, rank) in enumerate(wanted.get(c, ())):
                if middle[c][k] is not None:
                    continue
                part = parts[c, prefix]
                upto = part["n"].cumsum().to_numpy()
                at = int(np.searchsorted(upto, rank, side="right"))
                wanted[c][k] = ((prefix << DIGIT) | int(part["cell"].iloc[at]), rank - (int(upto[at - 1]) if at else 0))
                low, high = int(part["low"].iloc[at]), int(part["high"].iloc[at])
                if low == high:
                    middle[c][k] = low + (1 << 63)
        known = {c: prefixes for c, ends in wanted.items() if (prefixes := {prefix for (prefix, _), key in zip(ends, middle[c]) if key is None})}
    found = {c: [float_of(key) for key in keys] for c, keys in middle.items()}
    return {c: low if low == high else low + (high - low) * 0.5 for c, (low, high) in found.items()}


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, median``: exact median per column with a value. The columns are written once, as they are read several times."""
    columns = list(dict.fromkeys(columns))
    values = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "values")
    return df.sparkSession.createDataFrame(list(exact_medians(values, columns).items()), "column_name string, median double")


def scales(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population std and divisor per column; a constant column is divided by 1."""
    stats = moments(df, columns).select("column_name", "mean", F.sqrt(F.try_divide("m2", "n")).alias("std"))
    return stats.withColumn("scale", F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0)))


@dataclass(frozen=True)
class Preprocessing:
    """Fitted parameters, in the order of ``columns``."""

    columns: list[str]
    logged: list[str]
    median: list[float]
    mean: list[float]
    scale: list[float]

    def apply(self, df: DataFrame, out: str = "x") -> DataFrame:
        """Add the array of transformed features."""
        cells = []
        for c, median, mean, scale in zip(self.columns, self.median, self.mean, self.scale):
            value = log1p_floor0(F.col(c)) if c in self.logged else F.col(c).cast("double")
            cells.append((F.coalesce(value, F.lit(median)) - F.lit(mean)) / F.lit(scale))
        return df.withColumn(out, F.array(*cells))

    def as_dict(self) -> dict:
        return asdict(self)


def fit_preprocessing(df: DataFrame, columns: Sequence[str], threshold: float = 1.0, unlogged: Sequence[str] = UNLOGGED) -> Preprocessing:
    """The rows are read once for the moments, once more for those of logged columns and up to four times for the medians; see ``moments``
    and ``exact_medians``. Medians in place of missing values are added to the moments after."""
    columns = list(columns)

    def found(values: dict[str, Column]) -> dict[str, Row]:
        # NaN is filled as well, so it is missing here.
        rows = df.select(*[F.nanvl(v, F.lit(None).cast("double")).alias(c) for c, v in values.items()])
        return {r["column_name"]: r for r in skewness(moments(rows, rows.columns), threshold).collect()}

    known = found({c: F.col(c).cast("double") for c in columns})
    logged = [c for c in columns if c not in unlogged and c in known and known[c]["is_skewed"]]
    if logged:
        known |= found({c: log1p_floor0(F.col(c)) for c in logged})
    kept = df.select(*[(log1p_floor0(F.col(c)) if c in logged else F.col(c).cast("double")).alias(c) for c in columns])
    middle = exact_medians(kept, columns)
    median = [float(middle.get(c, 0.0)) for c in columns]
    spread = [filled_spread(known[c], m) for c, m in zip(columns, median)]
    return Preprocessing(columns, logged, median, [mean for mean, _ in spread], [scale for _, scale in spread])


def filled_spread(found: Row, median: float) -> tuple[float, float]:
    """Mean and divisor of a column, as ``scales`` has them, from its moments, once its missing values are ``median``."""
    n, missing = found["n"], found["n_rows"] - found["n"]
    near = found["mean"] if n else median
    off = median - near if missing else 0.0
    mean = near + off * missing / (n + missing)
    std = math.sqrt(((found["m2"] if n else 0.0) + off * off * n * missing / (n + missing)) / (n + missing))
    return float(mean), std if std > 0 else 1.0


def seeded_hash(ids: Sequence[str], seed: int) -> Column:
    """60 bits of the md5 of the ids and the seed, which SQL engines reproduce; nulls count as the word null."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ids]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stratified_folds(df: DataFrame, ids: Sequence[str], label: str = "label", k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled folds that split each label evenly: position by seeded hash within the label, modulo k."""
    hashed = df.withColumn("_h", seeded_hash(ids, seed))
    placed = grouped_position(hashed, [label], F.shiftright("_h", HASH_BITS), [F.col("_h"), *[F.col(c) for c in ids]], "_at")
    return placed.withColumn(out, ((F.col("_at") - 1) % k).cast("int")).drop("_h", "_at")


def user_split(df: DataFrame, valid_percent: int = 20, seed: int = 42, out: str = "is_valid") -> DataFrame:
    """Users, not rows, go to validation, by seeded hash."""
    return df.withColumn(out, F.pmod(seeded_hash(["user_id"], seed), F.lit(100)) < valid_percent)


def seeded_sample(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows without replacement; the same rows however the table is partitioned."""
    return df.withColumn("_h", seeded_hash(ids, seed)).orderBy("_h", *ids).limit(n).drop("_h")


def median_filled(df: DataFrame, column: str) -> DataFrame:
    """Missing indicator and median-filled copy of a column."""
    middle = medians(df, [column]).select("median").scalar()
    return df.withColumns({f"{column}_missing": F.col(column).isNull().cast("int"), f"{column}_filled": F.coalesce(F.col(column), middle)})
