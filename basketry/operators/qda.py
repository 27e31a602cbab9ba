"""Regularised quadratic discriminant analysis from sufficient statistics.

A single distributed pass sums count, vector and outer product per (fold, class); every
regularisation strength and every fold model follows from these few matrices on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.positions import SCORE_DECIMALS
from basketry.functions.scalars import logit
from basketry.operators.metrics import log_loss, roc_auc
from basketry.operators.preprocess import Preprocessing, fit_preprocessing, stratified_folds
from basketry.session import materialize

PACKED = 2_000_000  # scores that a task holds at a time
SLICES_PER_UNIT = 32  # of the log odds
COARSE = tuple(round(0.10 + 0.05 * i, 2) for i in range(7))


@dataclass(frozen=True)
class ClassStats:
    """Count, sum and outer-product sum of the rows of a class."""

    n: float
    total: np.ndarray
    outer: np.ndarray

    def __add__(self, other: ClassStats) -> ClassStats:
        return ClassStats(self.n + other.n, self.total + other.total, self.outer + other.outer)

    def __sub__(self, other: ClassStats) -> ClassStats:
        return ClassStats(self.n - other.n, self.total - other.total, self.outer - other.outer)


def matrix(x: pa.Array) -> np.ndarray:
    """Arrays of equal length as the rows of a matrix. A missing value is NaN."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def class_statistics(df: DataFrame, d: int, features: str = "x", label: str = "label", fold: str = "fold") -> dict[tuple[int, int], ClassStats]:
    """Statistics per (fold, class): partial sums per batch of rows, added up by a shuffle aggregate."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch["x"])
            ones = np.hstack([np.ones((len(x), 1)), x])
            keys = pd.DataFrame({"fold": batch["fold"].to_pandas(), "label": batch["label"].to_pandas()})
            for key, at in keys.groupby(["fold", "label"]).indices.items():
                rows = ones[at]
                sums[key] = sums.get(key, 0.0) + rows.T @ rows
        for (f, y), m in sums.items():
            columns = [pa.array(np.full(m.size, f), pa.int32()), pa.array(np.full(m.size, y), pa.int32()), pa.array(np.arange(m.size), pa.int32()), pa.array(m.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["fold", "label", "cell", "value"])

    source = df.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("int").alias("label"), F.col(features).alias("x"))
    cells = source.mapInArrow(partial, "fold int, label int, cell int, value double")
    found = cells.groupBy("fold", "label", "cell").agg(F.sum("value").alias("value")).toPandas()
    stats = {}
    for (f, y), part in found.groupby(["fold", "label"]):
        m = np.zeros((d + 1) ** 2)
        m[part["cell"].to_numpy()] = part["value"].to_numpy()
        m = m.reshape(d + 1, d + 1)
        stats[int(f), int(y)] = ClassStats(m[0, 0], m[0, 1:], m[1:, 1:])
    return stats


@dataclass(frozen=True)
class QdaModel:
    """Prior, mean, axes and axis variances per class; ``variances`` are not yet regularised."""

    prior: tuple[float, float]
    mean: tuple[np.ndarray, np.ndarray]
    axes: tuple[np.ndarray, np.ndarray]
    variances: tuple[np.ndarray, np.ndarray]

    @classmethod
    def from_stats(cls, negative: ClassStats, positive: ClassStats) -> QdaModel:
        total = negative.n + positive.n
        means, axes, variances = [], [], []
        for s in (negative, positive):
            if s.n < 2:
                raise ValueError("each class needs at least two rows")
            mean = s.total / s.n
            covariance = (s.outer - s.n * np.outer(mean, mean)) / (s.n - 1)
            values, vectors = np.linalg.eigh(covariance)
            means.append(mean)
            axes.append(vectors)
            variances.append(np.maximum(values, 0.0))
        return cls((negative.n / total, positive.n / total), tuple(means), tuple(axes), tuple(variances))

    def log_odds(self, x: np.ndarray, reg: float) -> np.ndarray:
        """Log odds of class 1 with covariance ``(1 - reg) S + reg I``."""
        return self.log_odds_of(x, [reg])[:, 0]

    def log_odds_of(self, x: np.ndarray, regs: Sequence[float]) -> np.ndarray:
        """A column of log odds for each strength; the rows are turned to the axes once."""
        sides = []
        for prior, mean, axes, variances in zip(self.prior, self.mean, self.axes, self.variances):
            squares = ((x - mean) @ axes) ** 2
            shrunk = [(1.0 - reg) * variances + reg for reg in regs]
            sides.append(np.stack([np.log(prior) - 0.5 * ((squares / s).sum(axis=1) + np.log(s).sum()) for s in shrunk], axis=1))
        return sides[1] - sides[0]


def fold_models(stats: dict[tuple[int, int], ClassStats], folds: Sequence[int]) -> tuple[QdaModel, dict[int, QdaModel]]:
    """The model of all rows, and for each fold the model of the rows outside it."""
    whole = {}
    for y in (0, 1):
        parts = [s for (_, label), s in stats.items() if label == y]
        if not parts:
            raise ValueError(f"no row with label {y}")
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        whole[y] = total
    held_out = {f: QdaModel.from_stats(*[whole[y] - stats[f, y] if (f, y) in stats else whole[y] for y in (0, 1)]) for f in folds}
    return QdaModel.from_stats(whole[0], whole[1]), held_out


def with_log_odds(df: DataFrame, model: QdaModel, reg: float, features: str = "x", out: str = "log_odds") -> DataFrame:
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.log_odds(matrix(x), reg) if len(x) else [], pa.float64())

    return df.withColumn(out, score(F.col(features)))


def with_fold_log_odds(df: DataFrame, models: dict[int, QdaModel], regs: Sequence[float], features: str = "x", out: str = "log_odds") -> DataFrame:
    """Each row scored by the model that did not see its fold, once per strength (an array)."""

    @F.arrow_udf("array<double>")
    def score(fold: pa.Array, x: pa.Array) -> pa.Array:
        values = fold_log_odds(fold.to_numpy(zero_copy_only=False), matrix(x), models, regs) if len(x) else np.empty((0, len(regs)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(regs), pa.int32()), pa.array(values.ravel()))

    return df.withColumn(out, score(F.col("fold"), F.col(features)))


def fold_log_odds(fold: np.ndarray, x: np.ndarray, models: dict[int, QdaModel], regs: Sequence[float]) -> np.ndarray:
    """A column of log odds for each strength, each row by the model that did not see its fold."""
    values = np.empty((len(x), len(regs)))
    for f in np.unique(fold):
        at = fold == f
        values[at] = models[int(f)].log_odds_of(x[at], regs)
    return values


def cross_validated_auc(df: DataFrame, models: dict[int, QdaModel], regs: Sequence[float]) -> DataFrame:
    """Mean AUC over the folds for every strength, from one scoring pass.

    Scores travel as packed arrays, one per strength, fold and slice of the log odds, and are sorted where a slice is whole; what
    is left of a slice are three numbers. A positive loses to the negatives of the slices above its own as well.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                fold, label = (batch[c].to_numpy(zero_copy_only=False) for c in ("fold", "label"))
                held.append((fold, label, np.round(fold_log_odds(fold, matrix(batch["x"]), models, regs), SCORE_DECIMALS)))
                size += batch.num_rows * len(regs)
            if size > PACKED:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        fold, label, scores = (np.concatenate([h[k] for h in held]) for k in range(3))
        rows = []
        for i in range(len(regs)):
            slices = np.floor(scores[:, i] * SLICES_PER_UNIT).astype(np.int64)
            order = np.lexsort((slices, fold))
            f, s, y, v = fold[order], slices[order], label[order].astype(np.int8), scores[order, i]
            starts = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])])
            for a, b in zip(starts, [*starts[1:], len(f)]):
                rows.append((i, int(f[a]), int(s[a]), v[a:b].tobytes(), y[a:b].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], list(kinds))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        group = rows.groupby(["i", "fold", "slice"]).ngroup().to_numpy()
        keys = rows.assign(group=group).drop_duplicates("group").sort_values("group")[["i", "fold", "slice"]]
        lengths = rows["labels"].str.len().to_numpy()
        v, y = np.frombuffer(b"".join(rows["scores"])), np.frombuffer(b"".join(rows["labels"]), np.int8)
        g = np.repeat(group, lengths)
        order = np.lexsort((-v, g))
        g, v, y = g[order], v[order], y[order].astype(np.int64)
        first = np.r_[True, g[1:] != g[:-1]]
        starts = np.flatnonzero(first | np.r_[True, v[1:] != v[:-1]])  # of the distinct scores
        pos, neg = np.add.reduceat(y, starts), np.add.reduceat(1 - y, starts)
        heads = np.flatnonzero(first[starts])
        upto = np.cumsum(neg)
        before = np.repeat(upto[heads] - neg[heads], np.diff([*heads, len(starts)]))
        losses = np.add.reduceat(pos * (upto - before - neg / 2), heads)
        yield keys.assign(pos=np.add.reduceat(pos, heads), neg=np.add.reduceat(neg, heads), losses=losses)

    kinds = {"i": pa.int32(), "fold": pa.int32(), "slice": pa.int64(), "scores": pa.binary(), "labels": pa.binary()}
    source = df.select(F.col("fold").cast("int").alias("fold"), F.col("label").cast("int").alias("label"), F.col("x"))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() * len(regs) // PACKED + 1)
    cells = source.mapInArrow(packed, "i int, fold int, slice long, scores binary, labels binary").repartition(parts, "i", "fold", "slice")
    slices = cells.mapInPandas(counted, "i int, fold int, slice long, pos long, neg long, losses double")
    above = Window.partitionBy("i", "fold").orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lost = F.sum(F.col("losses") + F.col("pos") * F.coalesce("above", F.lit(0)))
    aucs = slices.withColumn("above", F.sum("neg").over(above)).groupBy("i", "fold").agg((1 - F.try_divide(lost, F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))
    names = F.array(*[F.lit(float(r)) for r in regs])
    return aucs.groupBy("i").agg(F.avg("auc").alias("cv_auc")).select(F.element_at(names, F.col("i") + 1).alias("reg"), "cv_auc")


def refined(best: float) -> list[float]:
    low, high = max(best - 0.05, 0.05), min(best + 0.05, 0.50)
    return [round(low + 0.01 * i, 2) for i in range(int(round((high - low) / 0.01)) + 1)]


@dataclass(frozen=True)
class QdaFit:
    preprocessing: Preprocessing
    model: QdaModel
    held_out: dict[int, QdaModel]
    reg: float
    cv_auc: float
    search: list[tuple[str, float, float]]


def fit_qda(train: DataFrame, columns: Sequence[str], ids: Sequence[str], k: int = 5, seed: int = 42, coarse: Sequence[float] = COARSE, kept: list[str] | None = None) -> tuple[QdaFit, DataFrame]:
    """Preprocess, search the strength in two stages by cross-validated AUC, fit on all rows.

    Returns the fit and the training rows with their fold and feature array.
    """
    prep = fit_preprocessing(train, columns)
    rows = materialize(prep.apply(stratified_folds(train.select(*ids, "label", *columns), ids, k=k, seed=seed)).select(*ids, "label", "fold", "x"), "qda-rows", kept=kept)
    model, held_out = fold_models(class_statistics(rows, len(columns)), range(k))
    search: list[tuple[str, float, float]] = []

    def best_of(stage: str, regs: Sequence[float]) -> tuple[float, float]:
        found = sorted((r["reg"], r["cv_auc"]) for r in cross_validated_auc(rows, held_out, regs).collect())
        search.extend((stage, reg, auc) for reg, auc in found)
        return max(found, key=lambda pair: pair[1])

    reg, _ = best_of("coarse", coarse)
    reg, auc = best_of("fine", refined(reg))
    return QdaFit(prep, model, held_out, reg, auc, search), rows


def with_probability(df: DataFrame, compat_logit: bool = False) -> DataFrame:
    """``qda_p_score`` and ``qda_logit`` from the log odds."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("log_odds")))
    scored = df.withColumn("qda_p_score", p)
    return scored.withColumn("qda_logit", logit(F.col("qda_p_score"), compat=compat_logit)).drop("log_odds")


def score_new(df: DataFrame, fit: QdaFit, compat_logit: bool = False) -> DataFrame:
    """Replay the stored preprocessing on new rows and score them with the full model."""
    return with_probability(with_log_odds(fit.preprocessing.apply(df), fit.model, fit.reg), compat_logit).drop("x")


def score_training(rows: DataFrame, fit: QdaFit, in_sample: bool = False, compat_logit: bool = False) -> DataFrame:
    """Scores of the training rows: out of fold, or from the model that saw them if ``in_sample``."""
    if in_sample:
        scored = with_log_odds(rows, fit.model, fit.reg)
    else:
        scored = with_fold_log_odds(rows, fit.held_out, [fit.reg]).withColumn("log_odds", F.col("log_odds")[0])
    return with_probability(scored, compat_logit).drop("x", "fold")


def fit_report(scored: DataFrame) -> DataFrame:
    """AUC and log loss of scored training rows."""
    auc = roc_auc(scored, score="qda_p_score").scalar()
    return log_loss(scored, score="qda_p_score").select(auc.alias("auc"), "log_loss")
