"""Language-model scores by context-tree weighting (CTW) over bytes.

A byte is eight binary decisions, each made at a node ``(context, bits so far)``. For every context of up to ``depth``
bytes a node counts zeros and ones, and the Krichevsky-Trofimov (KT) estimator gives the probability of its counts. CTW
mixes all depths: the weighted probability of a node is half its own KT probability plus half the product of the
weighted probabilities of the nodes with one more byte of context. Given the counts of the training texts, the
probability of the next bit is a weighted mean of the KT predictions along its path; a context that was never seen
predicts one half. The log of a text's probability includes its end, a byte that no text holds.

Nothing is sent whole to a task or the driver:

* texts are dealt by hash into batches of about ``BATCH_CHARS`` characters; a batch asks for its distinct n-grams and
  words only, so a request stands for all their places in it; requests travel sorted and compressed, dealt into parts;
* a part holds whole subtrees (all n-grams with the same last two bytes of context); it sums their counts, weighs its nodes
  from the longest contexts up, and after the few shorter contexts are weighed comes down again with the mixture;
* the log probability of each requested n-gram goes back to the batches that asked for it, where every place adds it.

The base score is that of smoothed word counts, which take the same way. Defined results: null text is the empty text; a
null id stays null and is training text; repeated rows count and score once each; without training text every bit costs
one bit and ``base_score`` is that of counts of zero.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from basketry.llm.hashing import LOWER, chunks, joined, mixed, span_hashes, word_spans
from basketry.llm.toxicity import held_out
from basketry.session import materialize

DEPTH = 5
TOP = 2  # shorter contexts are few and are handled apart
BATCH_CHARS = 24_000_000
PORTION = 2_000_000  # bytes looked at together
END = 255  # no byte of a UTF-8 text; also stands before its start
GRAM, WORD = 0, 1
SLOTS = 19


def grams_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram of every byte and of every end, and the place of each text's first.

    An n-gram holds its context first, last byte foremost, so that a shorter context is a prefix, and then the byte.
    """
    end = bytes([END])
    buffer = np.frombuffer(b"".join([t + end for t in texts]), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    key = np.zeros(len(buffer), np.int64)
    place = np.arange(len(buffer)) - np.repeat(starts, sizes)
    for back in range(1, depth + 1):
        before = np.full(len(buffer), END, np.int64)
        before[back:] = buffer[:-back] if len(buffer) > back else before[back:]
        before[place < back] = END
        key = key << 8 | before
    return key << 8 | buffer, starts


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of the text of each."""
    buffer, starts = joined(texts)
    first, last = word_spans(buffer)
    return span_hashes(buffer, first, last).view(np.int64), np.searchsorted(starts, first, side="right") - 1


def counted(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their weights; most keys are found by a hash table of one try."""
    slot = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)
    table = np.zeros(1 << SLOTS, np.int64)
    table[slot] = keys
    hit = table[slot] == keys
    total = np.bincount(slot[hit], weight[hit], 1 << SLOTS)
    used = np.flatnonzero(np.bincount(slot[hit], minlength=1 << SLOTS))
    rest, inverse = np.unique(keys[~hit], return_inverse=True)
    return np.concatenate([table[used], rest]), np.concatenate([total[used], np.bincount(inverse, weight[~hit], len(rest))])


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([w for _, w in parts]), len(keys))


class Lookup:
    """Values by key for many keys at once; keys that are not there give ``default``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float):
        self.table, self.value = np.zeros(1 << SLOTS, np.int64), np.full(1 << SLOTS, default)
        slot = self._slot(keys)
        self.table[slot], self.value[slot] = keys, values
        late = self.table[slot] != keys
        order = np.argsort(keys[late])
        self.keys, self.values, self.default = keys[late][order], values[late][order], default

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.value[slot]
        miss = np.flatnonzero(self.table[slot] != keys)
        if len(miss):
            out[miss] = self.default
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, keys[miss]), len(self.keys) - 1)
                out[miss] = np.where(self.keys[at] == keys[miss], self.values[at], self.default)
        return out


def lowered(texts: pd.Series) -> list[bytes]:
    return [t.encode().translate(LOWER) for t in texts]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as differences, compressed byte plane by byte plane."""
    steps = np.diff(values, prepend=0).astype("<i8")
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def part_of(kind: int, keys: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """N-grams with the same last two bytes of context belong to one part, words are dealt by their hash."""
    h = mixed((keys >> 8 * (depth - 1)).view(np.uint64)) if kind == GRAM else keys.view(np.uint64)
    return ((h >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def distinct_keys(texts: list[bytes], train: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct n-grams and words of texts, with their counts in the texts to learn from."""
    found: dict[int, list] = {GRAM: [], WORD: []}
    for part in chunks([len(t) for t in texts], PORTION):
        keys, starts = grams_of(texts[part], depth)
        sizes = np.diff(np.append(starts, len(keys)))
        found[GRAM].append(counted(keys, np.repeat(train[part], sizes).astype(float)))
        keys, owner = words_of(texts[part])
        found[WORD].append(counted(keys, train[part][owner].astype(float)))
    return {kind: merged(parts) for kind, parts in found.items()}


def requests(docs: DataFrame, depth: int, parts: int) -> DataFrame:
    """The distinct n-grams and words of every batch with their counts in its training texts, packed by part."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        texts, train = lowered(group["text"]), ~group["held_out"].to_numpy(bool)
        rows = []
        for kind, (keys, n) in distinct_keys(texts, train, depth).items():
            part = part_of(kind, keys, depth, parts)
            for p in np.unique(part).tolist():
                own = part == p
                rows.append((kind, p, group["batch"].iloc[0], packed(keys[own]), packed(n[own].astype(np.int64))))
        return pd.DataFrame(rows, columns=["kind", "part", "batch", "keys", "n"])

    return docs.groupBy("batch").applyInPandas(run, "kind int, part int, batch int, keys binary, n binary")


def totals(rows: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The keys of each row, and all distinct keys with their counts."""
    asked = [unpacked(k) for k in rows["keys"]]
    keys, n = merged([(k, unpacked(c).astype(float)) for k, c in zip(asked, rows["n"], strict=True)])
    return asked, keys, n


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: the recurrence up to 8, then Stirling's series."""
    shift = np.zeros(len(x))
    x = x.astype(float)
    for _ in range(8):
        small = x < 8
        shift = shift - np.where(small, np.log(np.where(small, x, 1.0)), 0.0)
        x = np.where(small, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the KT probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


@F.pandas_udf(DoubleType())
def kt_udf(zeros: pd.Series, ones: pd.Series) -> pd.Series:
    return pd.Series(kt_log(zeros.to_numpy(float), ones.to_numpy(float)))


class Subtrees:
    """The nodes of depth ``TOP`` and below of whole contexts, from the sorted n-grams of a part and their counts.

    N-grams are sorted, so the nodes of a depth and a number of known bits are runs of them. ``level[d][s]`` holds for each
    such node the counts, the log of its weighted probability, the share of its own estimate, and its node one context
    shorter. N-grams without counts are nodes too: they predict one half, as everything that was never seen.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int):
        self.keys, self.depth = keys, depth
        codes, self.level, self.rows = keys, {}, {}
        for d in range(depth, TOP - 1, -1):
            if d < depth:  # one byte of context less
                short = codes >> 16 << 8 | codes & 255
                codes, inverse = np.unique(short, return_inverse=True)
                n = np.bincount(inverse, n, len(codes))
            self.level[d], self.rows[d] = [], []
            for s in range(8):
                prefix = codes >> 8 - s
                new = np.ones(len(codes), bool)
                new[1:] = prefix[1:] != prefix[:-1]
                start = np.flatnonzero(new)
                one = (codes >> 7 - s & 1).astype(bool)
                zeros, ones = np.add.reduceat(np.where(one, 0.0, n), start), np.add.reduceat(np.where(one, n, 0.0), start)
                node = {"code": prefix[start], "zeros": zeros, "ones": ones, "own": kt_log(zeros, ones)}
                if d == depth:
                    node["weighted"], node["share"] = node["own"], np.ones(len(start))
                else:
                    below = self.level[d + 1][s]
                    above = below["code"] >> s + 8 << s | below["code"] & (1 << s) - 1
                    below["above"] = np.searchsorted(node["code"], above)
                    longer = np.bincount(below["above"], below["weighted"], len(start))
                    node["weighted"] = np.logaddexp(node["own"], longer) - np.log(2.0)
                    node["share"] = 1 / (1 + np.exp(np.clip(longer - node["own"], -700, 700)))
                self.level[d].append(node)
                self.rows[d].append(np.cumsum(new) - 1)

    def top(self) -> pd.DataFrame:
        """The nodes of depth ``TOP``."""
        parts = []
        for s, node in enumerate(self.level[TOP]):
            names = {"context": node["code"] >> s, "node": 1 << s | node["code"] & (1 << s) - 1}
            parts.append(pd.DataFrame(names | {c: node[c] for c in ("zeros", "ones", "weighted")}))
        return pd.concat(parts)

    def log_probabilities(self, above: pd.DataFrame) -> np.ndarray:
        """Log10 probability of the last byte of every n-gram, given what the shorter contexts predict: ``known`` is
        settled, ``open`` the weight that is left, by ``(context, node)``."""
        names = above["context"].to_numpy() << 8 | above["node"].to_numpy()
        order = np.argsort(names)
        names = names[order]
        shorter = {c: above[c].to_numpy()[order] for c in ("known", "open")}
        total = np.zeros(len(self.keys))
        for s in range(8):
            for d in range(TOP, self.depth + 1):
                node = self.level[d][s]
                if d == TOP:
                    at = np.searchsorted(names, node["code"] >> s << 8 | 1 << s | node["code"] & (1 << s) - 1)
                    known, rest = shorter["known"][at], shorter["open"][at]
                else:
                    known, rest = known[node["above"]], rest[node["above"]]
                one = (node["ones"] + 0.5) / (node["zeros"] + node["ones"] + 1.0)
                known, rest = known + rest * node["share"] * one, rest * (1 - node["share"])
            p = (known + rest / 2)[self.rows[self.depth][s]]
            total += np.log10(np.where(self.keys >> 7 - s & 1, p, 1 - p))
        return total


def predicted_above(top: DataFrame) -> DataFrame:
    """``(part, context, node, known, open)`` for the nodes of depth ``TOP``: what shorter contexts predict. These are at most
    255 nodes for each of 65,536 contexts, whatever the corpus."""
    own = kt_udf("zeros", "ones")
    levels = [top.select("context", "node", "zeros", "ones", "weighted")]
    for _ in range(TOP):
        below = levels[0].groupBy(F.shiftright("context", 8).alias("context"), "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("longer"))
        below = below.withColumn("own", own)
        # log(e^own / 2 + e^longer / 2), and the posterior share of this depth's own estimate
        most = F.greatest("own", "longer")
        weighted = most + F.log(F.exp(F.col("own") - most) + F.exp(F.col("longer") - most)) - F.log(F.lit(2.0))
        share = 1 / (1 + F.exp(F.least(F.col("longer") - F.col("own"), F.lit(700.0))))
        levels.insert(0, materialize(below.select("context", "node", "zeros", "ones", weighted.alias("weighted"), share.alias("share")), "ctw-level"))
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    mixed_in = levels[0].select("context", "node", (F.col("share") * one).alias("known"), (1 - F.col("share")).alias("open"))
    for level in levels[1:TOP]:
        above = mixed_in.select(F.col("context").alias("shorter"), "node", F.col("known").alias("known_above"), F.col("open").alias("open_above"))
        both = level.withColumn("shorter", F.shiftright("context", 8)).join(above, ["shorter", "node"])
        known = F.col("known_above") + F.col("open_above") * F.col("share") * one
        mixed_in = both.select("context", "node", known.alias("known"), (F.col("open_above") * (1 - F.col("share"))).alias("open"))
    above = mixed_in.select(F.col("context").alias("shorter"), "node", "known", "open")
    return top.withColumn("shorter", F.shiftright("context", 8)).join(above, ["shorter", "node"]).select("part", "context", "node", "known", "open")


ANSWERS = "kind int, part int, batch int, answers binary, n long, v long"


def gram_answers(asked: DataFrame, depth: int) -> DataFrame:
    """For every request for n-grams their log10 probabilities, in its order."""

    def up(rows: pd.DataFrame) -> pd.DataFrame:
        _, keys, n = totals(rows)
        return Subtrees(keys, n, depth).top().assign(part=rows["part"].iloc[0])[["part", "context", "node", "zeros", "ones", "weighted"]]

    def down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        each, keys, n = totals(rows)
        value = Subtrees(keys, n, depth).log_probabilities(above).astype("<f4")
        answers = [value[np.searchsorted(keys, k)].tobytes() for k in each]
        return pd.DataFrame({"kind": GRAM, "part": rows["part"], "batch": rows["batch"], "answers": answers, "n": 0, "v": 0})

    fields = "part int, context long, node long, zeros double, ones double, weighted double"
    top = materialize(asked.groupBy("part").applyInPandas(up, fields), "ctw-top")
    return asked.groupBy("part").cogroup(predicted_above(top).groupBy("part")).applyInPandas(down, ANSWERS)


def word_answers(asked: DataFrame) -> DataFrame:
    """For every request for words their counts, in its order; the first of a part brings how many words were learned."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        each, keys, n = totals(rows)
        first = np.arange(len(rows)) == 0
        answers = [packed(n[np.searchsorted(keys, k)].astype(np.int64)) for k in each]
        return pd.DataFrame({"kind": WORD, "part": rows["part"], "batch": rows["batch"], "answers": answers, "n": np.where(first, int(n.sum()), 0), "v": np.where(first, int((n > 0).sum()), 0)})

    return asked.groupBy("part").applyInPandas(run, ANSWERS)


def score(docs: DataFrame, depth: int = DEPTH, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """Scores of ``(doc_id, text, held_out)``; texts that are not held out are learned from."""
    if not TOP <= depth <= 7:
        raise ValueError(f"depth must be {TOP} to 7")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    batches = max(1, -(-size // batch_chars))
    parts = 2 * batches
    fields = ["doc_id", "text", "held_out", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch")]
    dealt = docs.select(*fields)
    asked = materialize(requests(dealt, depth, parts), "ctw-requests")
    words = materialize(word_answers(asked.where(F.col("kind") == WORD)), "ctw-words")
    facts = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    ends = docs.where(~F.col("held_out")).count()
    n_train, v_train = (facts["n"] or 0) + ends, (facts["v"] or 0) + (ends > 0)
    given = gram_answers(asked.where(F.col("kind") == GRAM), depth).unionByName(words).select("batch", "kind", "part", "answers")
    below = np.log10(n_train + v_train + 1.0)

    def run(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        raw = lowered(texts["text"])
        keys_of = distinct_keys(raw, np.zeros(len(raw), bool), depth)
        by_part = {(k, p): a for k, p, a in zip(answers["kind"], answers["part"], answers["answers"], strict=True)}
        lookups = []
        for kind in (GRAM, WORD):
            keys = keys_of[kind][0]
            part, value = part_of(kind, keys, depth, parts), np.zeros(len(keys))
            for p in np.unique(part).tolist():
                told = by_part[kind, p]
                value[part == p] = np.frombuffer(told, "<f4") if kind == GRAM else unpacked(told)
            lookups.append(Lookup(keys, value, 0.0))
        log_p, n_word = lookups
        out = {c: np.zeros(len(raw)) for c in ("n_tokens", "n_known", "base_score", "score", "bits_per_byte")}
        for part in chunks([len(t) for t in raw], PORTION):
            keys, starts = grams_of(raw[part], depth)
            n = part.stop - part.start
            out["score"][part] = np.add.reduceat(log_p(keys), starts)
            keys, owner = words_of(raw[part])
            known = n_word(keys)
            out["n_tokens"][part] = np.bincount(owner, minlength=n) + 1
            out["n_known"][part] = np.bincount(owner, known > 0, n) + (ends > 0)
            out["base_score"][part] = np.bincount(owner, np.log10(known + 1), n) + np.log10(ends + 1) - out["n_tokens"][part] * below
        sizes = np.array([len(t) + 1 for t in raw])
        out["bits_per_byte"] = -out["score"] * np.log2(10) / sizes
        frame = pd.DataFrame({"doc_id": texts["doc_id"], "held_out": texts["held_out"], "train_tokens": n_train, **out})
        return frame.astype({"n_tokens": "int64", "n_known": "int64"})

    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return dealt.groupBy("batch").cogroup(given.groupBy("batch")).applyInPandas(lambda a, b: run(a, b)[[c.split()[0] for c in result.split(", ")]], result)


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    doc_id = F.col("doc_id").cast("long")
    return score(docs.select(doc_id.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(doc_id, 7).alias("held_out")))
