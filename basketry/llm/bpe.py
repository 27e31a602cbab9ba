"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each match of the pattern is merged on its own. The leaves of a segment tree stand for byte positions; leaf ``i``
holds the rank of the pair that starts at the live symbol ``i``, and every inner node holds the smallest rank below
it, leftmost first. A merge reads the root, links the two neighbours, and updates the two or three leaves that changed,
so a match of ``n`` bytes takes ``O(n log n)`` however long it is. Nothing is shuffled: documents are encoded where
they are read, and a bounded memo per Python worker keeps the ids of short matches.

Defined results: null text is the empty text, which has no tokens; a null id stays null; repeated rows give one row each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMO_ENTRIES = 500_000  # matches remembered by a worker; it starts anew when full
MEMO_LENGTH = 64  # longer matches are not remembered
LONG = 128  # bytes from which a match is merged by itself
CELLS = 1 << 18  # byte positions merged together
PORTION = 1_000_000  # characters split at a time


class BytePairEncoder:
    """Encodes and decodes by the merge ranks of a ``tiktoken`` rank file.

    The merges run on whole sets of matches at a time: row ``r`` of every array belongs to match ``r``, and each step does
    the next merge of all matches that have one left.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.none = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # The pairs of ids that merge, and the id (which is the rank) they merge to.
        pairs = {
            ranks[token[:k]] * self.none + ranks[token[k:]]: i
            for token, i in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.memo: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.none + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], self.none)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of matches, none of them empty."""
        n_rows, none = len(pieces), self.none
        n = np.array([len(p) for p in pieces])
        width = int(n.max())
        size = 1 << max(1, (width - 1).bit_length())
        place = np.arange(width)
        live = place < n[:, None]
        symbol = np.zeros((n_rows, width + 1), np.int64)  # id of the live symbol that starts at a position
        symbol[:, :width][live] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        end = np.broadcast_to(np.arange(1, width + 2), (n_rows, width + 1)).copy()  # where that symbol ends
        before = end - 2  # where the live symbol before it starts
        tree = np.full((n_rows, 2 * size), none, np.int64)
        tree[:, size : size + width - 1] = np.where(live[:, 1:], self.rank(symbol[:, : width - 1], symbol[:, 1:width]), none)
        k = size
        while k > 1:
            tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
            k //= 2

        def put(r: np.ndarray, i: np.ndarray, rank: np.ndarray | int) -> None:
            k = size + i
            tree[r, k] = rank
            while k[0] > 1:  # all leaves are equally deep
                k = k >> 1
                tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

        r = np.flatnonzero(tree[:, 1] != none)
        while len(r):
            best, k = tree[r, 1], np.ones(len(r), np.int64)
            while k[0] < size:  # down to the leftmost leaf with the smallest rank
                k = 2 * k
                k += tree[r, k] != best
            i = k - size
            j = end[r, i]  # the right neighbour goes
            stop = end[r, j]
            symbol[r, i], end[r, i], before[r, stop] = best, stop, i
            live[r, j] = False
            put(r, j, none)
            more = stop < n[r]
            put(r, i, np.where(more, self.rank(best, symbol[r, stop]), none))
            if (first := i > 0).any():
                h = before[r[first], i[first]]
                put(r[first], h, self.rank(symbol[r[first], h], best[first]))
            r = r[tree[r, 1] != none]
        ids = symbol[:, :width][live].astype("<u4").tobytes()
        stops = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip(np.concatenate([[0], stops[:-1]]).tolist(), stops.tolist(), strict=True)]

    def merge_long(self, piece: bytes) -> bytes:
        """The same for one long match, leaf by leaf; an update stops where the smallest rank stays."""
        ranks, none, n = self.ranks, self.none, len(piece)
        size = 1 << (n - 1).bit_length()
        tree = [none] * (2 * size)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree[size : size + n - 1] = [ranks.get(piece[i : i + 2], none) for i in range(n - 1)]
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, rank: int) -> None:
            k = size + i
            while k and tree[k] != rank:
                tree[k] = rank
                k >>= 1
                rank = min(tree[2 * k], tree[2 * k + 1])

        while tree[1] != none:
            k, best = 1, tree[1]
            while k < size:
                k *= 2
                if tree[k] != best:
                    k += 1
            i = k - size
            j = end[i]
            end[i] = stop = end[j]
            put(j, none)
            if stop < n:
                before[stop] = i
                put(i, ranks.get(piece[i : end[stop]], none))
            else:
                put(i, none)
            if i:
                put(before[i], ranks.get(piece[before[i] : stop], none))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return np.array(ids, "<u4").tobytes()

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of matches that the memo lacks; matches of similar length are merged together."""
        by_size: dict[int, list[str]] = {}
        found: dict[str, bytes] = {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                found[piece] = self.merge_long(raw)
            else:
                by_size.setdefault((len(raw) - 1).bit_length(), []).append(piece)
        for bits, group in by_size.items():
            step = max(1, CELLS >> bits)
            for k in range(0, len(group), step):
                part = group[k : k + step]
                found.update(zip(part, self.merge([p.encode() for p in part]), strict=True))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.find(t) for t in texts]
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        new = self.learn(set().union(*split).difference(self.memo))
        self.memo.update(new)
        packed = [b"".join(map(self.memo.__getitem__, pieces)) for pieces in split]
        for piece in new:
            if len(piece) > MEMO_LENGTH:
                del self.memo[piece]
        return packed

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def portions(texts: list[str], chars: int) -> Iterator[slice]:
    """Consecutive slices of about so many characters, of one text at least."""
    start = total = 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= chars:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> BytePairEncoder:
    with open(path, "rb") as file:  # installed with the tokenizers on every machine
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return BytePairEncoder(ranks, pattern)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)`` of every row; ``ids`` is the packed little-endian array of unsigned 32-bit ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in portions(texts, PORTION):
                yield pd.DataFrame({"id": batch["id"][part], "ids": bpe.encode(texts[part])})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "id long, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, bytes)`` of every row of ``(id, ids)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = encoder(path).decode
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "bytes": [decode(x) for x in batch["ids"]]})

    return encoded.select(F.col(id_col).alias("id"), "ids").mapInPandas(run, "id long, bytes binary").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the bytes decoded from these ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch["text"].tolist()
            for part in portions(texts, PORTION):
                ids = bpe.encode(texts[part])
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"][part],
                        "n_tokens": [len(x) // 4 for x in ids],
                        "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                        "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
                    }
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
