"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct five-word shingles. Sets ``A`` and ``B`` link when
``100 * |A & B| >= 75 * |A | B|``, which is ``7 * |A ^ B| <= |A| + |B|``.

* Sketch: every shingle flips one bit of a long bit string, so the Hamming distance of two sketches is at most the
  symmetric difference ``|A ^ B|`` of the sets (shingles that both have cancel out).
* Size bands: sizes are cut at ratios of 4/3, so that sets which can link are in the same or in neighbouring bands. All
  pairs whose larger set is in a band differ by at most ``d`` shingles, ``d`` being a seventh of twice the largest size.
* Pigeonhole: the sketch is cut into ``d + 1`` blocks; sets that link agree on one at least. A block is kept as the XOR
  of random words, one per set bit, and its key is joined within the band. A block without set bits says nothing and
  gives no key. (A pair would be missed only if all blocks it agrees on were empty; small bands use more sketches of
  other seeds, so that the chance of that is below 1e-9 for any pair.)
* Equal sets are one node from the start. Keys travel packed: a row is what a portion of texts sends to one part, which
  holds about ``PART_KEYS`` keys.
* In a run of equal keys every member is compared with the run's first, never all with all. Members that are then in
  different components of a run are compared with a member of its largest component drawn anew; what still is
  apart is compared with all of the run, as far as sizes and the Hamming distance of 1024-bit sketches allow a link. So
  a large group of near copies costs a few comparisons a member, and no pair that shares a key is left undecided.
* Pairs are verified exactly on the shingles of the whole texts, in groups dealt by hash. Of the pairs of a step one for each member
  is verified first, and of the others those whose ends are still in different components; only components are asked for.

Set names and shingles are 64-bit hashes. Defined results: null, empty and blank texts have an empty set and are alone;
with fewer than five words the whole sequence is one shingle; rows with a null id take part, but a component is named
by its smallest id that is not null (null if there is none); repeated rows are linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.hashing import LOWER, chunks, combined, joined, mixed, span_hashes, word_spans
from basketry.session import Buckets, let_go, materialize, passing

WIDTH = 5
NUM, DEN = 3, 4  # links: |A & B| / |A | B| >= NUM / DEN
PORTION = 1_000_000  # bytes of text looked at together
PART_KEYS = 500_000
KEYS_PER_WORD = 0.8
LEAST_BLOCKS = 48  # of all sketches of a band together
HELD_KEYS = 1_000_000  # keys a task holds before it reduces runs to their first members
VERIFY_CHARS = 1_500_000  # characters of a group that verifies pairs, every copy of a text counted
PASS_CHARS = 8 * VERIFY_CHARS  # characters that are copied at a time, or as many as all texts have
CHUNK_CHARS = 250_000  # characters of the partners of one text that are verified in one group
SKETCH_WORDS = 16
DRAWS = 1
PARTS_PER_BUCKET = 4  # a bucket of texts holds about what this many parts of keys come from


class Sets:
    """Shingle sets of texts: ``items`` sorted within each text, ``starts`` and ``sizes`` by text."""

    def __init__(self, texts: list[bytes]):
        buffer, places = joined([t.translate(LOWER) for t in texts])
        first, last = word_spans(buffer)
        self._build(span_hashes(buffer, first, last), np.searchsorted(places, first, side="right") - 1, len(texts))

    @classmethod
    def of_words(cls, words: np.ndarray, owner: np.ndarray, n: int) -> Sets:
        """Sets of ``n`` sequences of word hashes that follow each other."""
        sets = cls.__new__(cls)
        sets._build(words, owner, n)
        return sets

    def _build(self, words: np.ndarray, owner: np.ndarray, n: int) -> None:
        count = np.bincount(owner, minlength=n)
        shingles, of = combined(words, WIDTH), owner[: max(0, len(words) - WIDTH + 1)]
        whole = of == owner[WIDTH - 1 :] if len(shingles) else np.zeros(0, bool)
        shingles, of = shingles[whole], of[whole]
        for size in range(1, WIDTH):  # too short for a shingle: the whole sequence is one
            short = np.flatnonzero(count == size)
            at = np.searchsorted(owner, short)
            total = np.full(len(short), size, np.uint64)
            for k in range(size):
                total = mixed(total * np.uint64(31) + words[at + k])
            shingles, of = np.concatenate([shingles, total]), np.concatenate([of, short])
        order = np.lexsort((shingles, of))
        shingles, of = shingles[order], of[order]
        new = np.ones(len(shingles), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
        self.items, self.owner = shingles[new], of[new]
        self.sizes = np.bincount(self.owner, minlength=n)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        # The name of a set: a hash of the sum of its mixed members; 0 for the empty set.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.items ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)])
        self.names = mixed(sums[self.starts + self.sizes] - sums[self.starts] + self.sizes.astype(np.uint64)).view(np.int64)
        self.names[self.sizes == 0] = 0

    def of(self, k: int) -> np.ndarray:
        return self.items[self.starts[k] : self.starts[k] + self.sizes[k]]

    def sketches(self) -> np.ndarray:
        """Parity sketches of ``64 * SKETCH_WORDS`` bits, a row per text."""
        spread = mixed(self.items + np.uint64(77))
        out = np.zeros((len(self.sizes), SKETCH_WORDS), np.uint64)
        word = (spread >> np.uint64(8)) % np.uint64(SKETCH_WORDS)
        np.bitwise_xor.at(out, (self.owner, word.astype(np.int64)), np.uint64(1) << (spread & np.uint64(63)))
        return out


def bounds() -> np.ndarray:
    """The smallest size of each band; a set that can link with a smaller one finds it in its own or the band below."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * DEN // NUM)))
    return np.array(out, np.int64)


BOUNDS = bounds()
# Blocks of a band's sketch, and how many sketches it has. Bands whose sets only link when equal need none.
BLOCKS = 2 * (np.append(BOUNDS[1:], BOUNDS[-1] * 2) - 1) * (DEN - NUM) // (DEN + NUM) + 1
SEEDS = np.where(BLOCKS > 1, -(-LEAST_BLOCKS // BLOCKS), 0)


def block_keys(sets: Sets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets ``rows``, and the row of each."""
    keys, of = [], []
    own = np.searchsorted(BOUNDS, sets.sizes, side="right") - 1
    for above in (0, 1):
        band = own + above
        # In the band above, only sets that are large enough to link with its smallest.
        fits = sets.sizes * DEN >= BOUNDS[band] * NUM if above else np.ones(len(own), bool)
        takes = np.zeros(len(own), bool)
        takes[rows] = True
        takes &= fits & (sets.sizes > 0)
        for seed in range(int(SEEDS[band[takes]].max(initial=0))):
            now = takes & (SEEDS[band] > seed)
            blocks = np.where(now, BLOCKS[band], 0)
            base = np.concatenate([[0], np.cumsum(blocks)])
            item = now[sets.owner]
            owner, h = sets.owner[item], mixed(sets.items[item] + np.uint64(0x51ED27 * (seed + 1)))
            block = ((h >> np.uint64(32)) * blocks[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            parity = np.zeros(base[-1], np.uint64)
            np.bitwise_xor.at(parity, base[owner] + block, mixed(h))
            text = np.repeat(np.arange(len(own)), blocks)
            place = np.arange(base[-1]) - base[text]
            name = mixed((band[text].astype(np.uint64) << np.uint64(40)) + (np.uint64(seed) << np.uint64(34)) + place.astype(np.uint64))
            some = parity != 0
            keys.append(mixed(parity[some] ^ name[some]))
            of.append(text[some])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(of)


def texts_of(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, text)``, null texts as empty ones; ``row`` names a row by its id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def named_sets(texts: DataFrame) -> DataFrame:
    """``(row, doc_id, n, name, sketch)`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            for part in chunks([len(t) for t in raw], PORTION):
                sets = Sets(raw[part])
                yield pd.DataFrame({"row": batch["row"][part], "doc_id": batch["doc_id"][part], "n": sets.sizes, "name": sets.names, "sketch": list(sets.sketches().view(np.int64))})

    return texts.mapInPandas(run, "row long, doc_id long, n long, name long, sketch array<long>")


def pack(keys: np.ndarray, of: np.ndarray, sets: Sets, parts: int) -> pd.DataFrame:
    """One row for each part: its keys of 32 bits and the name of the set of each, 12 bytes a key however many parts there are."""
    to = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    keys, of, to = keys[order].astype(np.uint32), of[order], to[order]
    rows = []
    edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        rows.append((int(to[a]), keys[a:b].tobytes(), sets.names[of[a:b]].tobytes()))
    return pd.DataFrame(rows, columns=["part", "keys", "names"])


PACKED = "part int, keys binary, names binary"


def packed_keys(texts: DataFrame, parts: int) -> DataFrame:
    """The keys of all different sets: what a portion of texts has for one part, as packed arrays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # names of 8 bytes, of this task's texts alone
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            for part in chunks([len(t) for t in raw], PORTION):
                sets = Sets(raw[part])
                fresh = [k for k, name in enumerate(sets.names.tolist()) if name and not (name in seen or seen.add(name))]
                keys, of = block_keys(sets, np.array(fresh, np.int64))
                yield pack(keys, of, sets, parts)

    return texts.select("text").mapInPandas(run, PACKED)


def runs_of(packed: DataFrame, parts: int) -> DataFrame:
    """``(run, lead, member)`` of every key that several sets have: its first set and each other one. Runs of two are not
    named, as no other pair is in them; their pair comes once a task."""

    def reduced(key: np.ndarray, name: np.ndarray, whole: bool) -> tuple[pd.DataFrame, tuple]:
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        key, name = key[new], name[new]
        lead = np.ones(len(key), bool)
        lead[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(lead)
        length = np.diff(np.append(start, len(key)))
        head = np.repeat(start, length)
        other = np.flatnonzero(~lead)
        out = pd.DataFrame({"run": key[other], "lead": name[head[other]], "member": name[other]})
        if whole:
            pair = np.repeat(length, length)[other] == 2
            once = out[pair].assign(run=-1).drop_duplicates()
            out = pd.concat([out[~pair], once])
        return out, (key[start], name[start])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total, whole = [], 0, True
        for batch in batches:
            for row in batch.itertuples(index=False):
                key = np.frombuffer(row.keys, np.uint32).astype(np.int64) | row.part << 32
                held.append((key, np.frombuffer(row.names, np.int64)))
                total += len(key)
            if total > HELD_KEYS:
                found, left = reduced(*map(np.concatenate, zip(*held, strict=True)), False)
                held, total, whole = [left], len(left[0]), False
                yield found
        if held:
            yield reduced(*map(np.concatenate, zip(*held, strict=True)), whole)[0]

    return packed.repartition(parts, "part").mapInPandas(run, "run long, lead long, member long")


def linked(size_a: int, size_b: int, common: int) -> bool:
    return DEN * common >= NUM * (size_a + size_b - common)


def plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that sizes and the Hamming distance of their sketches allow to link."""
    left = sketches.select(F.col("name").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(may_link()).select("a", "b")


def may_link():
    distance = F.lit(0)
    for k in range(SKETCH_WORDS):
        distance = distance + F.bit_count(F.col("sa")[k].bitwiseXOR(F.col("sb")[k]))
    sizes = DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb")
    return sizes & (distance * (DEN + NUM) <= (F.col("na") + F.col("nb")) * (DEN - NUM))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of set names that link; ``texts`` has ``(name, text)``. The partners of a text are cut into chunks, and
    the number of groups follows from the copies that the chunks need, not from the texts. Groups are looked at in passes, whose
    copies are about as many characters as the texts have, or one group: what is copied at a time does not grow with the pairs."""
    lengths = texts.select("name", F.length("text").cast("long").alias("n"))
    long = pairs.join(lengths.withColumnRenamed("name", "b"), "b")
    counts = long.groupBy("a").agg(F.sum("n").alias("partners"))
    counts = counts.join(lengths.withColumnRenamed("name", "a"), "a").select("a", "n", "partners", F.ceil(F.col("partners") / CHUNK_CHARS).cast("long").alias("chunks"))
    counts = materialize(counts.withColumn("chunks", F.greatest("chunks", F.lit(1))), "parity-chunks")
    copied = counts.agg(F.sum(F.col("partners") + F.col("n") * F.col("chunks"))).first()[0] or 0
    groups = max(1, -(-copied // VERIFY_CHARS))
    total = lengths.agg(F.sum("n")).first()[0] or 0
    passes = min(groups, max(1, -(-copied // max(PASS_CHARS, total))))
    dealt = pairs.join(counts.select("a", "chunks"), "a").select("a", "b", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), "chunks")), F.lit(groups)).alias("bucket"))
    dealt = materialize(dealt, "parity-pairs")
    def run(asked: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(given):
            sets = Sets([t.encode() for t in given["text"]])
            place = {name: k for k, name in enumerate(given["name"].tolist())}
            for a, b in zip(asked["a"].tolist(), asked["b"].tolist(), strict=True):
                i, j = place[a], place[b]
                if linked(int(sets.sizes[i]), int(sets.sizes[j]), len(np.intersect1d(sets.of(i), sets.of(j), assume_unique=True))):
                    out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    # Several passes read texts from buckets, so that no pass shuffles all of them.
    by_name = Buckets(pairs.sparkSession, ["name"], -(-total // PASS_CHARS))
    texts = by_name.write(texts, "parity-named", ordered=False) if passes > 1 else texts
    found = []
    for k in range(passes):
        now = dealt.where(F.pmod("bucket", F.lit(passes)) == k)
        wanted = now.select(F.col("bucket").alias("place"), F.explode(F.array("a", "b")).alias("name")).distinct()
        copies = texts.join(wanted.hint("shuffle_hash") if passes > 1 else wanted, "name")
        found.append(materialize(now.groupBy("bucket").cogroup(copies.groupBy("place")).applyInPandas(run, "a long, b long"), "parity-found"))
    by_name.discard_all()
    return reduce(DataFrame.unionByName, found)


def connected(pairs: DataFrame, links: DataFrame, groups: DataFrame, checked: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``links`` and components once no pair ``(a, b)`` that links has its ends in two components.

    First one pair for each component of a ``b``, then the pairs whose ends are still apart: within a group of near copies nearly
    all pairs are between members that the first step has joined, and their texts need not move.
    """
    spark = pairs.sparkSession
    pairs = materialize(pairs.distinct(), "parity-candidates")
    for first in (True, False):
        of = groups.withColumnRenamed("component", "c")
        sides = pairs.join(of.selectExpr("node AS a", "c AS ca"), "a", "left").join(of.selectExpr("node AS b", "c AS cb"), "b", "left")
        apart = sides.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).where("ca <> cb")
        if first:
            apart = apart.groupBy("cb").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
        tried = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        # Texts, chunks and pairs of this verification go when its links are written.
        with passing(spark) as stays:
            links = stays(materialize(links.unionByName(checked(materialize(tried, "parity-tried"))).distinct(), "parity-links"))
        groups = components(links)
    let_go(pairs)
    return links, groups


def clusters(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(row, doc_id, n, name)`` of all rows and ``(node, component)`` of the set names that link with another."""
    texts = texts_of(docs)
    named = materialize(named_sets(texts), "parity-sets")
    parts = max(1, int(-(-KEYS_PER_WORD * (named.agg(F.sum("n")).first()[0] or 0) // PART_KEYS)))
    runs = materialize(runs_of(packed_keys(texts, parts), parts), "parity-runs")

    sketches = materialize(named.where("n > 0").groupBy("name").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "parity-sketches")

    buckets = Buckets(named.sparkSession, ["row"], -(-parts // PARTS_PER_BUCKET))
    stored = buckets.write(texts.where(F.length("text") > 0).select("row", "text"), "parity-stored", ordered=False)

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs that link. Texts are fetched, one for each set, where sketches leave the question open."""
        pairs = materialize(plausible(pairs, sketches), "parity-plausible")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        place = named.join(wanted, "name").groupBy("name").agg(F.min("row").alias("row"))
        # Only the places move: texts stay in their buckets, unsorted, and no step shuffles the texts that it does not want.
        found = stored.join(place.hint("shuffle_hash"), "row").groupBy("row", "name").agg(F.first("text").alias("text"))
        shared = materialize(found.select("name", "text"), "parity-texts")
        return verified(pairs, shared)

    none = named.sparkSession.createDataFrame([], "a long, b long")
    links, groups = connected(runs.select(F.col("lead").alias("a"), F.col("member").alias("b")), none, none.selectExpr("a AS node", "b AS component"), checked)
    members = runs.where("run >= 0").select("run", F.col("member").alias("name"))
    for draw in range(DRAWS + 1):
        # Runs with members, other than the first, of several components.
        labelled = members.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
        several = labelled.groupBy("run").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("run")
        apart = materialize(labelled.join(several, "run"), "parity-apart")
        if apart.isEmpty():
            break
        members = apart.select("run", "name")
        if draw < DRAWS:
            drawn = F.xxhash64("name", F.lit(draw))
            per = apart.groupBy("run", "component").agg(F.count("*").alias("n"), F.min(F.struct(drawn.alias("d"), "name")).alias("drawn"))
            largest = per.where("n > 1").groupBy("run").agg(F.max(F.struct("n", "component", "drawn")).alias("m"))
            largest = largest.select("run", F.col("m.component").alias("largest"), F.col("m.drawn.name").alias("a"))
            tried = apart.join(largest, "run").where(F.col("component") != F.col("largest")).select("a", F.col("name").alias("b"))
        else:
            tried = undecided(apart, sketches)
        links, groups = connected(tried, links, groups, checked)
    buckets.discard_all()
    return named.drop("sketch"), groups


def undecided(apart: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of a run that are in different components and may link by size and sketch."""
    side = apart.join(sketches, "name")
    left = side.select("run", F.col("name").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = side.select(F.col("run").alias("other"), F.col("name").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return left.join(right, (F.col("run") == F.col("other")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & may_link()).select("a", "b")


def join_documents(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, n_shingles, component_id, component)`` of every row of ``docs``; ``component`` names a component also
    where no row of it has an id, and is null for empty sets."""
    named, groups = clusters(docs)
    per_set = named.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("least"))
    of = per_set.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    first = of.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = of.join(first, "component").select("name", "component", "component_id")
    out = named.join(by_set, "name", "left")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "component")


def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return join_documents(docs).select("doc_id", "n_shingles", "component_id")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws] ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY 1, 2
"""
