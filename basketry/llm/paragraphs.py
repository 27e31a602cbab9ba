"""Substring dedup by paragraph MinHash banding.

* Paragraphs: a text's words are cut where the hash of two adjacent words is the smallest within ``REACH`` words on either
  side. The cuts depend on nearby words alone, so a passage of about 50 words or more has the same whole paragraphs in
  every text, wherever it stands and whatever is around it.
* Banding: a paragraph's set of five-word shingles gives ``BANDS`` keys of ``ROWS`` MinHashes. With 6 bands of 2 a pair of Jaccard
  similarity 0.75 meets with probability 0.993, equal sets always. In a run of equal keys each set is compared with the first,
  those left in different components with drawn ones, and what is still apart pair by pair where sizes and sketches allow a link.
* Pairs are verified by their exact Jaccard similarity (0.75 or more), and components of links and equal sets are the groups.
* Of every group the occurrence with the smallest ``(doc_id, position)`` stays. Other occurrences are removed where they
  stand side by side for ``MIN_WORDS`` words at least, so lines that merely are common go nowhere.

Keys travel packed by parts, as in the Jaccard join; occurrences are counted in native aggregates, so a passage that a third
of all texts share is a count and not a group.

Defined results: null, empty and blank texts have no paragraphs; a null id comes after all others; rows that repeat both id
and text are one occurrence each at the same place, so none of the copies of the first one loses anything; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.components import settled
from basketry.llm.hashing import LOWER, chunks, combined, joined, mixed, span_hashes, word_spans
from basketry.llm.parity import PACKED, PORTION, WIDTH, Sets, pack, plausible, runs_of, texts_of, undecided, verified
from basketry.session import materialize

REACH = 5
BANDS, ROWS = 6, 2
MIN_WORDS = 18
PART_KEYS = 500_000
LAST = (1 << 63) - 1


class Paragraphs:
    """Paragraphs of texts: word spans in ``buffer``, the first word of each paragraph, the text it belongs to, its set."""

    def __init__(self, texts: list[bytes]):
        self.buffer, self.places = joined([t.translate(LOWER) for t in texts])
        self.first, self.last = word_spans(self.buffer)
        words = span_hashes(self.buffer, self.first, self.last)
        owner = np.searchsorted(self.places, self.first, side="right") - 1
        n = len(words)
        pair = np.zeros(n, np.uint64)
        if n:
            pair[:-1], pair[-1] = combined(words, 2), words[-1]
        starts = np.ones(n, bool)
        starts[1:] = owner[1:] != owner[:-1]
        pair[:-1][starts[1:]] = words[:-1][starts[1:]]  # the last word of a text has no other beside it
        low = ~starts
        for k in range(1, min(REACH + 1, n)):
            same = owner[k:] == owner[:-k]
            low[k:] &= ~same | (pair[k:] < pair[:-k])
            low[:-k] &= ~same | (pair[:-k] <= pair[k:])
        # No paragraph is shorter than a shingle, unless the text is.
        begin = np.flatnonzero(starts)
        length = np.diff(np.append(begin, n))
        place = np.arange(n) - np.repeat(begin, length)
        low &= (place >= WIDTH) & (np.repeat(length, length) - place >= WIDTH)
        self.start = np.flatnonzero(starts | low)
        self.size = np.diff(np.append(self.start, n))
        self.text = owner[self.start]
        self.sets = Sets.of_words(words, np.repeat(np.arange(len(self.start)), self.size), len(self.start))
        self.names = np.where(self.size >= WIDTH, self.sets.names, 0)  # shorter ones have no shingle and take no part

    def keys(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys of the paragraphs ``rows``, and the paragraph of each."""
        items, starts = self.sets.items, self.sets.starts
        keys = []
        for band in range(BANDS if len(rows) else 0):
            key = np.full(len(rows), band + 1, np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                least = np.minimum.reduceat(mixed(items + np.uint64(0x1F123BB5 * (k + 1))), starts)[rows]
                key = mixed(key * np.uint64(0x2545F491) + least)
            keys.append(key)
        return (np.concatenate(keys), np.tile(rows, BANDS)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def portions(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Paragraphs]]:
    for batch in batches:
        raw = [t.encode() for t in batch["text"]]
        for part in chunks([len(t) for t in raw], PORTION):
            yield batch.iloc[part], Paragraphs(raw[part])


def named_paragraphs(texts: DataFrame) -> DataFrame:
    """``(row, doc_id, names)``: the names of the paragraphs of every text in turn, 0 for those that take no part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, found in portions(batches):
            ends = np.searchsorted(found.text, np.arange(len(rows)), side="right")
            yield pd.DataFrame({"row": rows["row"], "doc_id": rows["doc_id"], "names": np.split(found.names, ends[:-1]) if len(rows) else []})

    return texts.mapInPandas(run, "row long, doc_id long, names array<long>")


def band_keys(texts: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, found in portions(batches):
            _, fresh = np.unique(found.names, return_index=True)
            keys, of = found.keys(fresh[found.names[fresh] != 0])
            found.sets.names = found.names
            yield pack(keys, of, found.sets, parts)

    return texts.select("text").mapInPandas(run, PACKED)


def paragraph_texts(texts: DataFrame) -> DataFrame:
    """``(name, text)`` of all paragraphs that take part, words joined by blanks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, found in portions(batches):
            _, fresh = np.unique(found.names, return_index=True)
            fresh = fresh[found.names[fresh] != 0]
            raw = found.buffer.tobytes()
            a, b = found.first[found.start[fresh]], found.last[found.start[fresh] + found.size[fresh] - 1]
            yield pd.DataFrame({"name": found.names[fresh], "text": [raw[i:j].decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)]})

    return texts.select("text").mapInPandas(run, "name long, text string")


def sketched(given: DataFrame) -> DataFrame:
    """``(name, n, sketch)``: number of shingles and parity sketch of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode() for t in batch["text"]]
            for part in chunks([len(t) for t in raw], PORTION):
                sets = Sets(raw[part])
                yield pd.DataFrame({"name": batch["name"][part], "n": sets.sizes, "sketch": list(sets.sketches().view(np.int64))})

    return given.mapInPandas(run, "name long, n long, sketch array<long>")


def repeated(docs: DataFrame) -> DataFrame:
    """``(row, at, groups, keepers)``: positions of the paragraphs of a row that a smaller occurrence repeats, the group of each
    and the document that keeps it (``LAST`` for one without an id)."""
    texts = texts_of(docs)
    named = materialize(named_paragraphs(texts), "paragraphs")
    total = named.agg(F.sum(F.size("names"))).first()[0] or 0
    parts = max(1, -(-total * BANDS // PART_KEYS))
    runs = materialize(runs_of(band_keys(texts, parts), parts), "paragraph-runs")
    pairs = materialize(runs.select(F.col("lead").alias("a"), F.col("member").alias("b")).distinct(), "paragraph-pairs")

    # The words of the paragraphs to verify come from one row for each.
    each = named.select("row", "doc_id", F.posexplode("names").alias("pos", "name")).where("name <> 0")
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct(), "paragraph-names")
    place = each.join(wanted, "name").groupBy("name").agg(F.min("row").alias("row")).select("row").distinct()
    given = paragraph_texts(texts.join(place, "row", "left_semi"))
    given = materialize(given.join(wanted, "name", "left_semi").groupBy("name").agg(F.first("text").alias("text")), "paragraph-texts")
    sketches = materialize(sketched(given), "paragraph-sketches")
    checked = lambda pairs: verified(materialize(plausible(pairs, sketches), "paragraph-plausible"), given)
    members = runs.where("run >= 0").select("run", F.col("member").alias("name"))
    groups = settled(members, materialize(checked(pairs), "paragraph-links"), checked, lambda apart: undecided(apart, sketches))

    counts = each.groupBy("name").agg(F.count("*").alias("n"))
    groups = counts.join(groups.withColumnRenamed("node", "name"), "name", "left").where((F.col("n") > 1) | F.col("component").isNotNull())
    groups = groups.select("name", F.coalesce("component", "name").alias("component"))
    found = materialize(each.join(groups, "name").select("row", "pos", "component", F.coalesce("doc_id", F.lit(LAST)).alias("doc_id")), "paragraph-groups")
    first = found.groupBy("component").agg(F.min("doc_id").alias("keeper"))
    first = materialize(first, "paragraph-keepers")
    held = found.join(first, "component")
    row = held.where(F.col("doc_id") == F.col("keeper")).groupBy("component").agg(F.min("row").alias("row"))
    pos = held.join(row, ["component", "row"]).groupBy("component", "row").agg(F.min("pos").alias("pos"))
    gone = held.join(pos, ["component", "row", "pos"], "left_anti")
    # A row of a text that occurs several times comes with equal places: they are one.
    per_row = gone.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("pos", "component", "keeper"))).alias("g"))
    return per_row.select("row", F.col("g.pos").alias("at"), F.col("g.component").alias("groups"), F.col("g.keeper").alias("keepers"))


def spans(rows: pd.DataFrame, min_words: int) -> Iterator[tuple[int, int, int, int, int, object]]:
    """``(number of the row, start, end, words, first group, keeper)`` of what goes, places in bytes of the text. Only rows with
    places are looked at, ``PORTION`` bytes of text together."""
    at_of, groups_of, keepers_of, texts = (rows[c].to_numpy() for c in ("at", "groups", "keepers", "text"))
    held = [k for k, at in enumerate(at_of) if at is not None and len(at)]
    for part in chunks([len(texts[k].encode()) for k in held], PORTION):
        own = held[part]
        found = Paragraphs([texts[k].encode() for k in own])
        begin = np.searchsorted(found.text, np.arange(len(own)))
        for i, k in enumerate(own):
            at, groups, keepers = np.asarray(at_of[k], np.int64), groups_of[k], keepers_of[k]
            for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) != 1) + 1):
                a, b = begin[i] + at[run[0]], begin[i] + at[run[-1]]
                words = int(found.size[a : b + 1].sum())
                if words >= min_words:
                    start = int(found.first[found.start[a]] - found.places[i])
                    end = int(found.last[found.start[b] + found.size[b] - 1] - found.places[i])
                    # The keeper named is the one that holds most of the span, and enough of it to be a passage.
                    by_keeper: dict[int, int] = {}
                    for g in run.tolist():
                        if keepers[g] != LAST:
                            by_keeper[keepers[g]] = by_keeper.get(keepers[g], 0) + int(found.size[begin[i] + at[g]])
                    keeper = max(by_keeper, key=lambda d: (by_keeper[d], -d)) if by_keeper else None
                    yield k, start, end, words, groups[run[0]], keeper if keeper is not None and by_keeper[keeper] >= min_words else None


def without(text: str, places: list[tuple[int, int]]) -> str:
    """``text`` without the spans ``(start, end)`` of its bytes, which come in order."""
    raw = text.encode()
    starts, ends = [0, *[end for _, end in places]], [*[start for start, _ in places], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(starts, ends, strict=True)).decode()


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``repeated`` under names of their own."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gone = repeated(docs).select(F.col("row").alias("_row"), F.col("at").alias("_at"), F.col("groups").alias("_groups"), F.col("keepers").alias("_keepers"))
    return docs.withColumn("_row", F.xxhash64("doc_id", text)).join(gone, "_row", "left")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for every span that goes: ``doc_id``, its bytes, its words, its group, and the document that keeps the passage."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(spans(batch, min_words))
            out = pd.DataFrame(rows, columns=["k", "start", "end", "n_words", "group_id", "kept_doc_id"])
            out["doc_id"] = batch["doc_id"].to_numpy()[out["k"].to_numpy(int)] if rows else pd.Series([], dtype="int64")
            out["kept_doc_id"] = out["kept_doc_id"].astype("Int64")
            yield out[["doc_id", "start", "end", "n_words", "group_id", "kept_doc_id"]]

    rows = with_repeats(docs).where(F.col("_at").isNotNull()).select("doc_id", "text", *[F.col(f"_{c}").alias(c) for c in ("at", "groups", "keepers")])
    return rows.mapInPandas(run, "doc_id long, start long, end long, n_words long, group_id long, kept_doc_id long")


def dedup_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without its repeated passages; the other columns pass through."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, at: pd.Series, groups: pd.Series, keepers: pd.Series) -> pd.Series:
        rows = pd.DataFrame({"text": text.to_numpy(), "at": at.to_numpy(), "groups": groups.to_numpy(), "keepers": keepers.to_numpy()})
        gone: dict[int, list[tuple[int, int]]] = {}
        for k, start, end, *_ in spans(rows, min_words):
            gone.setdefault(k, []).append((start, end))
        return pd.Series([without(t, gone[k]) if k in gone else t for k, t in enumerate(rows["text"])])

    rows = with_repeats(docs)
    text = F.when(F.col("_at").isNotNull(), cut(F.coalesce(F.col("text").cast("string"), F.lit("")), "_at", "_groups", "_keepers")).otherwise(F.col("text"))
    return rows.withColumn("_text", text).withColumn("text", F.col("_text")).select(*docs.columns)


def op4_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
