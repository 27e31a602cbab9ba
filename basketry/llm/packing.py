"""Packing documents into sequences: linear grouping of large lengths, then best fit of small ones.

1. Large pieces are sorted by length and cut into groups of equal cardinality; each is rounded up to the largest length
   of its group, which leaves at most ``groups`` sizes.
2. Patterns of these few sizes are optimised: the largest size still in demand is completed by the subset of the others
   that fills the sequence best, and the pattern is used as often as the demands allow.
3. Actual pieces take the places of their group, which leaves at least the room that the rounded ones left.
4. Small pieces, largest first, go where the least room is left that holds them (best fit).

The driver only sees counts per length and per room left, at most ``capacity`` numbers each, and returns ranges:
"pieces p to q of this length go to sequences a to b of that class". Documents are numbered within their class by
sliced positions, so that no length, however common, is gathered in one task. All joins are on these numbers.

Defined results: null text is the empty text; a null id stays null; repeated rows are packed once each; an empty table
gives no rows. Only documents longer than ``capacity`` are cut.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.positions import grouped_position
from basketry.llm.bpe import portions
from basketry.llm.tokens import word_tokenizer
from basketry.session import materialize

CAPACITY = 2048
SMALL = 256  # shorter pieces are placed by best fit
GROUPS = 256
PORTION = 1_000_000  # characters tokenized at a time
SLICE = 20_000  # pieces numbered in one task, about

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: its ids and a closing id 0, cut where it is longer than a sequence."""
    size = 4 * capacity

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].array
            for part in portions(texts, PORTION):
                rows = []
                for doc_id, packed in zip(ids[part], tokenizer.encode(texts[part]), strict=True):
                    packed += b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(packed), size)):
                        piece = packed[at : at + size]
                        rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, PIECES)


def groups_of(counts: dict[int, int], groups: int) -> tuple[dict[int, int], int, list[int], list[int]]:
    """Linear grouping of large lengths: the rank at which each length begins (longest first), the cardinality of a
    group, and each group's rounded size and number of pieces."""
    start, total = {}, 0
    for length in sorted(counts, reverse=True):
        start[length] = total
        total += counts[length]
    each = max(1, -(-total // groups))
    lengths, begins = list(start), list(start.values())
    sizes, demand = [], []
    for first in range(0, total, each):
        sizes.append(lengths[int(np.searchsorted(begins, first, side="right")) - 1])
        demand.append(min(each, total - first))
    return start, each, sizes, demand


def best_patterns(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{group: pieces per sequence}`` with the number of sequences that use them; they meet all demands."""
    left, patterns = list(demand), []
    for lead in range(len(sizes)):
        while left[lead]:
            # Sums that the groups from ``lead`` on reach, as bits; one step for each further piece of a group.
            room, reach, steps = capacity - sizes[lead], 1, []
            mask = (1 << (room + 1)) - 1
            for g in range(lead, len(sizes)):
                for _ in range(min(left[g] - (g == lead), room // sizes[g])):
                    more = (reach | reach << sizes[g]) & mask
                    if more == reach:
                        break
                    steps.append((g, reach))
                    reach = more
            pattern, total = defaultdict(int, {lead: 1}), reach.bit_length() - 1
            for g, earlier in reversed(steps):
                if not earlier >> total & 1:
                    pattern[g] += 1
                    total -= sizes[g]
            times = min(left[g] // n for g, n in pattern.items())
            for g, n in pattern.items():
                left[g] -= n * times
            patterns.append((dict(pattern), times))
    return patterns


def best_fit(small: dict[int, int], room: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit, largest first, on counts alone.

    Returns ranges ``(length, first piece, pieces, class, first sequence)``, where a class is the room that a sequence
    had at the start and sequences are numbered within it, and how many new sequences are opened. New ones belong to
    the class ``capacity`` and are numbered after those that it has.
    """
    held = defaultdict(list)  # room left now: ranges of sequences (class, first, number)
    for r, n in room.items():
        if r and n:
            held[r].append((r, 0, n))
    rooms = sorted(held)
    moves, opened, old = [], 0, room.get(capacity, 0)

    def add(r: int, item: tuple[int, int, int]) -> None:
        if r:
            if not held[r]:
                insort(rooms, r)
            held[r].append(item)

    for length in sorted(small, reverse=True):
        first, left = 0, small[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                new = -(-left // (capacity // length))
                add(capacity, (capacity, old + opened, new))
                opened += new
                continue
            r = rooms[k]
            origin, start, n = held[r].pop()
            if not held[r]:
                rooms.pop(k)
            used = min(n, left)
            moves.append((length, first, used, origin, start))
            if used < n:
                add(r, (origin, start + used, n - used))
            add(r - length, (origin, start, used))
            first, left = first + used, left - used
    return moves, opened


def counted(df: DataFrame, column: str) -> dict[int, int]:
    """Rows per value of a column that has few values."""
    return {int(r[0]): r[1] for r in df.groupBy(column).count().collect()}


def numbered(df: DataFrame, group: str, tie: list[str], slices: int, out: str) -> DataFrame:
    """0-based numbers within each group, in slices dealt by hash so that no group is sorted whole."""
    placed = grouped_position(df, [group], F.pmod(F.xxhash64(*tie), F.lit(slices)), [F.col(c) for c in tie], out)
    return placed.withColumn(out, F.col(out) - 1)


def pack(pieces: DataFrame, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces; ``pieces`` is a written table, since it is read several times."""
    counts = counted(pieces, "length")
    total = sum(counts.values())
    slices = max(1, total // SLICE)
    tie = ["doc_id", "piece", "start", "ids_crc32"]
    items = materialize(numbered(pieces, "length", tie, slices, "nth"), "packing-items")

    start, each, sizes, demand = groups_of({k: n for k, n in counts.items() if small <= k < capacity}, groups)
    patterns = best_patterns(sizes, demand, capacity)
    places = defaultdict(list)  # per group: (first piece, first sequence, pieces per sequence)
    taken, sequences = [0] * len(sizes), 0
    for pattern, times in patterns:
        for g, n in pattern.items():
            places[g].append((taken[g], sequences, n))
            taken[g] += n * times
        sequences += times
    grid = {g: np.array(rows, np.int64).T for g, rows in places.items()}
    whole, full = sequences, counts.get(capacity, 0)
    sequences += full

    def substitute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, nth = batch["length"].to_numpy(), batch["nth"].to_numpy()
            out = whole + nth  # a full piece has a sequence of its own
            rank = nth + np.array([start.get(v, 0) for v in length.tolist()], np.int64)
            group = np.where(length < capacity, rank // each, -1)
            for g in np.unique(group[group >= 0]).tolist():
                rows = np.flatnonzero(group == g)
                piece = rank[rows] - g * each
                first, base, n = grid[g]
                at = np.searchsorted(first, piece, side="right") - 1
                out[rows] = base[at] + (piece - first[at]) // n[at]
            yield batch.assign(sequence_id=out)

    fields = f"{PIECES}, nth long, sequence_id long"
    large = materialize(items.where(F.col("length") >= small).select(*items.columns).mapInPandas(substitute, fields), "packing-large")
    rooms = large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room"))
    rooms = rooms.where(F.col("room") > 0)
    rooms = materialize(numbered(rooms, "room", ["sequence_id"], slices, "rank"), "packing-rooms")
    moves, _ = best_fit({k: n for k, n in counts.items() if k < small}, counted(rooms, "room"), capacity)
    by_length = defaultdict(list)
    for length, first, _, origin, at in moves:
        by_length[length].append((first, origin, at))
    ranges = {k: np.array(v, np.int64).T for k, v in by_length.items()}

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, nth = batch["length"].to_numpy(), batch["nth"].to_numpy()
            room, rank = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for v in np.unique(length).tolist():
                rows = np.flatnonzero(length == v)
                first, origin, base = ranges[v]
                at = np.searchsorted(first, nth[rows], side="right") - 1
                room[rows], rank[rows] = origin[at], base[at] + nth[rows] - first[at]
            yield batch.assign(room=room, rank=rank)

    little = items.where(F.col("length") < small).select(*items.columns)
    little = little.mapInPandas(fit, f"{PIECES}, nth long, room long, rank long")
    # A sequence that no large piece opened is new: class ``capacity``, numbered after the others.
    little = little.join(rooms, ["room", "rank"], "left").withColumn("sequence_id", F.coalesce("sequence_id", F.lit(sequences) + F.col("rank")))
    columns = [*pieces.columns, "sequence_id"]
    placed = large.select(*columns).unionByName(little.select(*columns))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *tie).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))


def op3_grouped_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = materialize(cut_documents(docs, public_tokenizers.path("word_bpe_49k.json")), "packing-pieces")
    return pack(pieces)
