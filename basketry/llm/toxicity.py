"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier is learned from confirmed toxic texts (P) and unlabelled ones (U), without any confirmed harmless
text. With the class prior ``pi`` its risk is ``pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])``: the unlabelled texts
count as harmless, corrected by the share of toxic ones among them, and the corrected part is kept non-negative by
stepping back whenever it falls below zero. ``pi`` is the share of toxic rows among the labelled training rows,
or less if the clearest features show that the unlabelled texts hold fewer.

Features are the distinct words of a text and the first letters of each, as far as they occur in ``MIN_ROWS`` toxic
texts of the sample and clearly more often there than in unlabelled ones. The sample is bounded (``positives`` and ``unlabelled`` rows, those with the smallest hash of
their id), and so is the vocabulary; hence the model, which is the only thing sent to the tasks, has at most
``vocabulary`` weights. Scoring reads every whole text where it is stored and shuffles nothing.

Defined results: null text is the empty text and scores like any text without known words; a null id stays null and is
never held out or sampled; repeated rows give one row each; without toxic training rows every score is the prior (0
without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import materialize

POSITIVES = 6_000  # toxic rows in the sample, at most
UNLABELLED = 12_000  # unlabelled rows in the sample, at most
VOCABULARY = 65_536
MIN_ROWS = 3
MIN_Z = 4.0  # standard errors by which a feature must be more frequent in toxic texts than in unlabelled ones
PREFIXES = (4, 5, 6)
CLEAREST = 20
THRESHOLD = 0.3
MEMO_ENTRIES = 500_000

# Words are runs of letters, digits and non-ASCII bytes, in lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> set[bytes]:
    return set(text.encode().translate(FOLD).split())


def features_of(word: bytes) -> list[str]:
    letters = word.decode()
    return [letters, *[letters[:n] + "*" for n in PREFIXES if len(letters) >= n]]


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


class Model:
    """Weights of features; scores are ``sigmoid(bias + sum over distinct words of their features' weights)``."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.memo: dict[bytes, float] = {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def score(self, text: str) -> float:
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        words, memo = words_of(text), self.memo
        for word in words.difference(memo):
            memo[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(sorted(map(memo.__getitem__, words))), -30, 30))))


def fit_nnpu(
    rows: list[np.ndarray], toxic: np.ndarray, prior: float, n_features: int, rounds: int = 400, rate: float = 0.05, decay: float = 3e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias from feature numbers per row (repeated ones count), by Adam on the non-negative risk."""
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows).astype(np.int64) if lengths.sum() else np.zeros(0, np.int64)
    row_of = np.repeat(np.arange(len(rows)), lengths)
    n_p, n_u = toxic.sum(), (~toxic).sum()
    theta = np.zeros(n_features + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        f = theta[-1] + np.bincount(row_of, theta[flat], len(rows))
        s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        softplus = np.logaddexp(0, f)  # the logistic loss of calling a row harmless
        corrected = softplus[~toxic].sum() / n_u - prior * softplus[toxic].sum() / n_p
        slope = np.where(toxic, -prior * s / n_p, s / n_u)  # of the corrected part
        if corrected >= 0:
            slope = slope + np.where(toxic, prior * (s - 1) / n_p, 0)
        else:  # step back from the negative part alone
            slope = -slope
        gradient = np.append(np.bincount(flat, slope[row_of], n_features), slope.sum())
        gradient[:-1] += decay * theta[:-1]
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, vocabulary: int = VOCABULARY) -> Model:
    """Learn from the rows that are not held out; ``docs`` has ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"))
    training = known.where(~held_out(F.col("doc_id")))
    prior = training.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    drawn = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = training.where("toxic = 1").join(ids, "doc_id", "left_semi").orderBy(*drawn).limit(positives)
    others = ids.where(~held_out(F.col("doc_id"))).join(known, "doc_id", "left_anti").orderBy(*drawn).limit(unlabelled)
    if others.isEmpty():  # every row has a label: the same rows without their labels, toxic ones among them, are the unlabelled ones
        others = training.select("doc_id").join(ids, "doc_id", "left_semi").orderBy(*drawn).limit(unlabelled)
    sample = toxic.select("doc_id", F.lit(True).alias("toxic")).unionByName(others.select("doc_id", F.lit(False).alias("toxic")))
    # At most positives + unlabelled rows of 9 bytes: small enough to broadcast at any size of the corpus.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [[f for w in sorted(words_of(t or "")) for f in features_of(w)] for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "features": words})

    rows = materialize(texts.mapInPandas(extract, "toxic boolean, features array<string>"), "toxicity-sample")
    sizes = rows.agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u")).first()
    n_p, n_u = max(1, sizes["p"] or 0), max(1, sizes["u"] or 0)
    one = F.explode(F.array_distinct("features")).alias("f")
    counts = rows.select("toxic", one).groupBy("f").agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u"))
    share = (F.col("p") + F.col("u") + 1) / F.lit(n_p + n_u + 2.0)
    z = (F.col("p") / F.lit(n_p) - F.col("u") / F.lit(n_u)) / F.sqrt(share * (1 - share) * F.lit(1 / n_p + 1 / n_u))
    chosen = counts.where((F.col("p") >= MIN_ROWS) & (z >= F.lit(MIN_Z))).orderBy(F.desc(z), "f").limit(vocabulary).collect()
    place = {r["f"]: k for k, r in enumerate(chosen)}
    # The clearest features hardly occur in harmless texts, so their share among unlabelled texts against their share
    # among toxic ones bounds the class prior of the unlabelled texts, which need not be that of the labelled ones.
    clear = chosen[:CLEAREST]
    if clear:
        prior = min(prior, (sum(r["u"] for r in clear) + 1) / n_u / ((sum(r["p"] for r in clear) + 1) / n_p))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "numbers": [[place[f] for f in fs if f in place] for fs in batch["features"]]})

    found = rows.mapInPandas(number, "toxic boolean, numbers array<int>").toPandas()
    is_toxic = found["toxic"].to_numpy(bool)
    if not is_toxic.any() or is_toxic.all() or not place:
        return Model({}, float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 30.0 if prior else -30.0)
    found = found.assign(key=found["numbers"].map(lambda x: tuple(x))).sort_values(["toxic", "key"])  # the order of tasks doesn't matter
    weights, bias = fit_nnpu([np.array(x, np.int64) for x in found["numbers"]], found["toxic"].to_numpy(bool), prior, len(place))
    return Model({f: float(weights[k]) for f, k in place.items() if weights[k]}, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` to every row of ``docs``, whatever its columns."""
    fields = [*docs.schema.fieldNames()]
    column = "score"
    rows = docs.select("*", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_whole"))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts])

    return rows.withColumn(column, scored(F.col("_whole"))).select(*[F.col(f"`{c}`") for c in fields if c != column], column)


def op6_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
