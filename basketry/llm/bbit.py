"""Near duplicates by b-bit MinHash.

A document's set holds the hashes of its distinct five-word shingles. Sets link when ``100 * |A & B| >= 85 * |A | B|``.

* Minima: ``HASHES`` hash functions, the least value of each over the set. ``ROWS`` of them together are the key of a band; two sets of
  similarity 0.85 agree on none of the ``BANDS`` keys with a chance of (1 - 0.85 ** 5) ** 25 = 4e-7.
* Signature: of each minimum only the lowest ``BITS`` bits stay, packed into ``SIGNATURE`` longs. Two of them agree in a slot with the
  chance ``J + (1 - J) / 2 ** BITS``; the slots that differ are counted by folding the XOR onto one bit a slot and counting bits, and
  the estimate of J takes the chance collisions out. Pairs estimated below ``FLOOR`` are dropped; for sets that link the chance of that
  is 5e-10.
* Equal sets are one node from the start, so copies cost one signature each and nothing more.
* In a band every set is compared with the first one of its key.
* Members of a key that are still in different components: a shingle that no other of all these sets holds is in no intersection. Sets
  with too many own shingles for any link are done. The rest are compared with the member of their key that has the smallest share of own
  shingles, as a text from which the others were made has. Those not linked with that centre are compared by their differences from it:
  two sets differ in ``|x ^ y| = dx + dy - 2 * |Dx & Dy|`` shingles, ``D`` being what differs from the centre, so a pair that links shares a
  stated part of its differences, at least one. The differences are sorted by how rare they are, and pairs that share one within the first
  places that this part leaves (a prefix filter, exact) are candidates. Near copies made independently differ from the centre in
  shingles of their own and meet nobody, so a large group costs each member what it differs in.
* Every pair that is kept is decided on the full sets: the shingles of the whole texts, made anew for candidates alone, joined to the
  pairs and intersected by Spark. A set with many partners is dealt in portions of ``CHUNK`` partners. Different texts are written once,
  bucketed by their hashes, so that fetching some of them moves none of the others.

Sets and texts are told apart by 128 bits, shingles by 64. Defined results: null, empty and blank texts have an empty set and are alone; with fewer
than five words the whole sequence is one shingle; rows with a null id take part, but a component is named by its smallest id that
is not null; ``kept`` is true for the rows whose id is the component's, nulls being equal to each other, so of repeated rows all stay or
none; an empty table has no rows. Columns other than ``doc_id`` and ``text`` play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.hashing import chunks, mixed
from basketry.llm.parity import Sets
from basketry.session import Buckets, materialize

PERCENT = 85  # links: 100 * |A & B| >= PERCENT * |A | B|
BITS, HASHES = 4, 128
SIGNATURE = HASHES * BITS // 64
ROWS, BANDS = 5, 25
FLOOR = 0.6
CHUNK = 256  # partners of a set that one task joins
PORTION = 500_000  # bytes of text looked at together

_draw = np.random.default_rng(20)
FACTORS = _draw.integers(0, 1 << 64, HASHES, np.uint64, endpoint=False) | np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 64, HASHES, np.uint64, endpoint=False)


def minima(sets: Sets) -> np.ndarray:
    """The least value of each hash function over each set that is not empty; a row a set."""
    starts = sets.starts[sets.sizes > 0]
    out = np.empty((len(starts), HASHES), np.uint64)
    if len(starts):
        values = np.empty_like(sets.items)
        for k in range(HASHES):
            np.multiply(sets.items, FACTORS[k], out=values)
            np.add(values, SHIFTS[k], out=values)
            out[:, k] = np.minimum.reduceat(values, starts)
    return mixed(out)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.empty((len(least), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(least), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
        keys[:, band] = key
    return keys


def packed(least: np.ndarray) -> np.ndarray:
    """The lowest bits of the minima, ``64 // BITS`` to a word."""
    each = 64 // BITS
    slots = (least & np.uint64((1 << BITS) - 1)).reshape(len(least), SIGNATURE, each)
    return np.bitwise_or.reduce(slots << (np.arange(each, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def names(sets: Sets) -> np.ndarray:
    """128 bits for each set: sums of two hashes of its members, mixed."""
    other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets.items + np.uint64(0x3C6EF372FE94F82B)), dtype=np.uint64)])
    second = mixed(other[sets.starts + sets.sizes] - other[sets.starts] + sets.sizes.astype(np.uint64) * np.uint64(3))
    return np.stack([sets.names.view(np.uint64), second], axis=1)


def _binaries(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1).view(np.int64)))


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Sets]]:
    for batch in batches:
        text = batch.column("text")
        sizes = pa.compute.binary_length(text).to_pylist()
        for part in chunks(sizes, PORTION):
            held = batch.slice(part.start, part.stop - part.start)
            yield held, Sets([t.encode() for t in held.column("text").to_pylist()])


def texts_of(docs: DataFrame) -> DataFrame:
    """``(doc_id, t1, t2, text)``, null texts as empty ones; two hashes name a text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("b"), text).alias("t2"), text.alias("text"))


def signatures(texts: DataFrame) -> DataFrame:
    """``(t1, t2, n, digest, signature, keys)`` of every text; ``digest`` tells sets apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, sets in _portions(batches):
            least = minima(sets)
            some = (sets.sizes > 0).astype(np.int64)
            columns = [held.column(c) for c in ("t1", "t2")]
            columns += [pa.array(sets.sizes.astype(np.int64)), _binaries(names(sets)), _lists(packed(least), some * SIGNATURE), _lists(band_keys(least), some * BANDS)]
            yield pa.RecordBatch.from_arrays(columns, ["t1", "t2", "n", "digest", "signature", "keys"])

    return texts.mapInArrow(run, "t1 long, t2 long, n long, digest binary, signature array<long>, keys array<long>")


def estimate(a: str = "sa", b: str = "sb") -> Column:
    """The similarity that two signatures give, without the slots that agree by chance."""
    ones = sum(1 << (BITS * k) for k in range(64 // BITS))
    differ = F.lit(0)
    for k in range(SIGNATURE):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        fold = x
        for shift in range(1, BITS):
            fold = fold.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(fold.bitwiseAND(F.lit(ones)))
    chance = 1 / 2**BITS
    return (1 - differ / F.lit(float(HASHES)) - chance) / (1 - chance)


def may_link() -> Column:
    sizes = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    return sizes & (estimate() >= FLOOR)


def with_signatures(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("name").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    right = sets.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b")


def runs_of(sets: DataFrame) -> DataFrame:
    """``(run, lead, name, several)`` of every band key that different sets have: its first set with each other one; ``several`` tells whether
    there are more than one."""
    keyed = sets.select(F.explode("keys").alias("run"), "name")
    leads = keyed.groupBy("run").agg(F.min("name").alias("lead"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(leads, "run").where("name <> lead").select("run", "lead", "name", (F.col("n") > 2).alias("several"))


def verified(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that link by their full sets ``items(name, items)``. ``a`` may have any number of partners."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"))
    left = items.join(counts, F.col("name") == F.col("a")).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.col("items").alias("ia"))
    right = items.select(F.col("name").alias("b"), F.col("items").alias("ib"))
    common = F.size(F.array_intersect("ia", "ib"))
    return dealt.join(right, "b").join(left, ["a", "chunk"]).where(100 * common >= PERCENT * (F.size("ia") + F.size("ib") - common)).select("a", "b")


class Links:
    """The links found so far, the components they give, and the full sets that were made for them."""

    def __init__(self, texts: DataFrame, sets: DataFrame):
        self.texts, self.sets = texts, sets
        self.items = self.found = self.groups = None

    def need(self, wanted: DataFrame) -> None:
        """Make the full sets of ``wanted(name)`` that there are not yet."""
        if self.items is not None:
            wanted = wanted.join(self.items.select("name"), "name", "left_anti")
        places = materialize(self.sets.join(wanted, "name").select("name", "place.*"), "bbit-wanted")
        if places.isEmpty():
            return

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, sets in _portions(batches):
                yield pa.RecordBatch.from_arrays([held.column("name"), _lists(sets.items, sets.sizes)], ["name", "items"])

        made = self.texts.join(places, ["t1", "t2"]).select("name", "text").mapInArrow(run, "name long, items array<long>")
        made = materialize(made, "bbit-items")
        self.items = made if self.items is None else self.items.unionByName(made)

    def add(self, pairs: DataFrame) -> None:
        """Decide ``pairs``, all of which are plausible, and join the components of those that link."""
        links = verified(pairs, self.items)
        links = links if self.found is None else links.unionByName(self.found)
        self.found = materialize(links, "bbit-links")
        self.groups = components(self.found)

    def labelled(self, rows: DataFrame, column: str, out: str) -> DataFrame:
        of = self.groups.select(F.col("node").alias(column), F.col("component").alias(out))
        return rows.join(of, column, "left").withColumn(out, F.coalesce(out, column))


def clusters(docs: DataFrame, kept: Buckets) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(doc_id, t1, t2)`` of all rows, ``(t1, t2, n, name)`` of all texts with words, and ``(node, component)`` of the sets that link with
    another, by their names."""
    every = texts_of(docs)
    rows = materialize(every.select("doc_id", "t1", "t2"), "bbit-rows")
    texts = kept.write(every.groupBy("t1", "t2").agg(F.first("text").alias("text")), "bbit-texts")
    found = materialize(signatures(texts), "bbit-signatures")
    sets = found.where("n > 0").groupBy("digest").agg(*[F.first(c).alias(c) for c in ("n", "signature", "keys")], F.min(F.struct("t1", "t2")).alias("place"))
    # Written once, a row's number is its name from here on: half as long as the digest.
    sets = materialize(sets.withColumn("name", F.monotonically_increasing_id()), "bbit-sets")
    runs = materialize(runs_of(sets), "bbit-runs")

    links = Links(texts, sets)
    pairs = with_signatures(runs.select(F.col("lead").alias("a"), F.col("name").alias("b")).distinct(), sets).where(may_link())
    pairs = materialize(pairs.select("a", "b", estimate().alias("estimate")), "bbit-pairs")
    if pairs.isEmpty():
        links.groups = sets.select(F.col("name").alias("node"), F.col("name").alias("component")).limit(0)
    else:
        links.need(ends(pairs))
        links.add(pairs)

    apart = still_apart(runs.where("several").select("run", "name"), links)
    if not apart.isEmpty():
        links.need(apart.select("name").distinct())
        own = own_shingles(apart.select("name").distinct(), links.items)
        # What no set of these can share with enough of a set leaves it without links.
        open_sets = materialize(sets.select("name", "n", "signature").join(own, "name").where((100 * (F.col("n") - F.col("u")) >= PERCENT * F.col("n"))), "bbit-open")
        members = materialize(with_centres(apart, open_sets), "bbit-members")
        tried = with_centre(members).unionByName(by_difference(members, links.items))
        tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        tried = materialize(with_signatures(tried, open_sets).where(may_link()).select("a", "b"), "bbit-tried")
        if not tried.isEmpty():
            links.add(tried)
    named = found.where("n > 0").select("t1", "t2", "n", "digest").join(sets.select("digest", "name"), "digest").drop("digest")
    return rows, named, links.groups


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()


def still_apart(members: DataFrame, links: Links) -> DataFrame:
    """``(run, name, component)`` of the runs whose members are in several components."""
    labelled = links.labelled(members, "name", "component")
    split = labelled.groupBy("run").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("run")
    return materialize(labelled.join(split, "run").select("run", "name", "component"), "bbit-apart")


def own_shingles(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """``(name, u)``: how many shingles no other set of ``wanted`` holds."""
    held = items.join(wanted, "name").select("name", F.explode("items").alias("item"))
    single = held.groupBy("item").agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n = 1")
    counts = single.groupBy("name").agg(F.count("*").alias("u"))
    return wanted.join(counts, "name", "left").select("name", F.coalesce("u", F.lit(0)).alias("u"))


def with_centres(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """``(centre, centre_component, name, component)``: each set of ``sets`` with the member of its runs that has the smallest share of own
    shingles."""
    held = apart.join(sets.select("name", "n", "u"), "name")
    best = held.groupBy("run").agg(F.min(F.struct((F.col("u") / F.col("n")).alias("share"), "name", "component")).alias("m"))
    best = best.select("run", F.col("m.name").alias("centre"), F.col("m.component").alias("centre_component"))
    return held.join(best, "run").select("centre", "centre_component", "name", "component").distinct()


def with_centre(members: DataFrame) -> DataFrame:
    """Each member with its centre."""
    return members.where(F.col("component") != F.col("centre_component")).select(F.col("centre").alias("a"), F.col("name").alias("b"))


def by_difference(members: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of different components that may link, from what members differ in from their centre. Pairs of which both link with the centre
    are in one component through it; so one of them, ``a``, does not."""
    near, far = 100 - PERCENT, 100 + PERCENT  # sets link when far * |x ^ y| <= near * (|x| + |y|)
    centre = items.select(F.col("name").alias("centre"), F.col("items").alias("ic"))
    both = members.join(items, "name").join(centre, "centre")
    differing = F.concat(F.array_except("items", "ic"), F.array_except("ic", "items"))
    held = both.select("centre", "name", "component", F.size("items").alias("n"), F.size("ic").alias("nc"), differing.alias("differ"))
    held = materialize(held.withColumn("d", F.size("differ")), "bbit-differences")
    each = held.select("centre", "name", F.explode("differ").alias("item"))
    counts = each.groupBy("centre", "item").agg(F.count("*").alias("df"))
    ordered = each.join(counts.where("df > 1"), ["centre", "item"]).groupBy("centre", "name").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("shared"))
    # Differences of nobody else come first and meet nobody.
    known = held.drop("differ").join(ordered, ["centre", "name"]).withColumn("alone", F.col("d") - F.size("shared"))
    linked = far * F.col("d") <= near * (F.col("n") + F.col("nc"))
    # The least number of common differences that any partner allows.
    least_linked = F.floor((far * F.col("d") + near * (F.col("nc") - F.col("n"))) / (2 * far)) + 1
    least_other = F.ceil((PERCENT * F.col("d") - near * F.col("n")) / PERCENT)
    known = known.withColumn("linked", linked)
    first = F.col("d") - F.greatest(F.when(F.col("linked"), least_linked).otherwise(least_other), F.lit(1)) + 1
    places = known.select("centre", "name", "component", "n", "d", "linked", F.posexplode("shared").alias("at", "e"), "alone", first.alias("first"))
    places = places.withColumn("at", F.col("at") + F.col("alone")).where("at < first").withColumn("item", F.col("e.item"))
    places = materialize(places.select("centre", "item", "name", "component", "n", "d", "linked", "at"), "bbit-places")
    left = places.where(~F.col("linked")).select("centre", "item", *[F.col(c).alias(f"{c}_a") for c in ("name", "component", "n", "d", "at")])
    right = places.select("centre", "item", "linked", *[F.col(c).alias(f"{c}_b") for c in ("name", "component", "n", "d", "at")])
    common = F.greatest(F.ceil((far * (F.col("d_a") + F.col("d_b")) - near * (F.col("n_a") + F.col("n_b"))) / (2 * far)), F.lit(1))
    once = F.col("linked") | (F.col("name_a") < F.col("name_b"))
    fits = (F.col("at_a") <= F.col("d_a") - common) & (F.col("at_b") <= F.col("d_b") - common) & (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    found = left.join(right, ["centre", "item"]).where(once & fits & (F.col("component_a") != F.col("component_b")))
    return found.select(F.col("name_a").alias("a"), F.col("name_b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs``."""
    kept = Buckets(docs.sparkSession, ["t1", "t2"], int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    try:
        rows, found, groups = clusters(docs, kept)
    finally:
        kept.discard_all()
    least = rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("least"))
    per_text = found.join(least, ["t1", "t2"])
    of = per_text.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    first = of.groupBy("component").agg(F.min("least").alias("component_id"))
    by_text = of.join(first, "component").select("t1", "t2", "n", "component_id")
    out = rows.join(by_text, ["t1", "t2"], "left")
    component = F.when(F.col("n").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op12_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def near_duplicates_sql(percent: int = PERCENT) -> str:
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws] ELSE list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id, min(r.c) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.doc_id = d.doc_id GROUP BY 1, 2
"""


OP12_SQL = near_duplicates_sql()
