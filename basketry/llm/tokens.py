"""Token ids of whole texts by a word-based public tokenizer, remembered per run of non-blank characters.

The vocabulary has word ends and drops white space, so no token, normalisation or match of its pattern crosses white
space: the ids of a text are those of its blank-free runs in turn. A Python worker looks runs up in a bounded memo. New
runs of Latin letters are split into words, and the merges of all new words are done together in numpy; any other run
goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

MEMO_ENTRIES = 500_000
MEMO_LENGTH = 64
WORD_BYTES = 64  # longer words go to the tokenizer
CELLS = 1 << 18
# Python's split() takes these for white space, the tokenizer does not.
UNLIKE = re.compile("[\x1c-\x1f]")
# Runs and texts whose normal form is their lower case, in any version of Unicode.
PLAIN = re.compile("[!-~¡-įı-ɏ]*")
PLAIN_TEXT = re.compile("[ \\t\\n\\r!-~¡-įı-ɏ]*")
# A comma or full stop that belongs to a longer run of signs.
SIGNS = re.compile(r"[\W_][.,]\s")


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:  # installed with the tokenizers on every machine
            told = json.load(file)
        vocab, merges = told["model"]["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in told["model"]["merges"]]
        self.split = regex.compile(told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        # Whether a run of letters, of all that ``PLAIN`` holds, is one word, so that it need not be split.
        letters = "".join(filter(PLAIN.fullmatch, map(chr, range(592)))).lower()
        self.letters_are_words = all(self.split(c + letter + c) == [c + letter + c] for c in "az" for letter in letters if letter.isalpha())
        suffix = told["model"]["end_of_word_suffix"]
        # The printable letter that stands for each byte: itself, or the next one from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.inside = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)
        self.n_ids = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.n_ids + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(key)
        self.pairs, self.rank_of = key[order], order.astype(np.int64)
        self.none = len(merges)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.n_ids + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank_of[at], self.none)

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words of similar length: each step does the next merge of all words that have one left."""
        n = np.array([len(w) for w in words])
        width = int(n.max())
        columns = np.arange(width)
        used = columns < n[:, None]
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = np.zeros((len(words), width), np.int64)
        symbol[used] = self.inside[raw]
        symbol[np.arange(len(words)), n - 1] = self.last[raw[np.cumsum(n) - 1]]
        rank = np.full((len(words), width), self.none, np.int64)
        rank[:, :-1] = np.where(used[:, 1:], self._rank(symbol[:, :-1], symbol[:, 1:]), self.none)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = np.arange(len(words))
        while True:
            k = rank.argmin(axis=1)
            best = rank[np.arange(len(k)), k]
            stays = best < self.none
            if not stays.all():
                done.append((rows[~stays], symbol[~stays], n[~stays]))
                rows, symbol, rank, n, k, best = rows[stays], symbol[stays], rank[stays], n[stays], k[stays], best[stays]
            if not len(rows):
                break
            # Close the gap behind the merged symbol, then rank its two pairs anew.
            take = np.minimum(columns + (columns > k[:, None]), width - 1)
            symbol, rank = np.take_along_axis(symbol, take, 1), np.take_along_axis(rank, take, 1)
            n = n - 1
            rank[:, -1] = self.none
            r = np.arange(len(rows))
            new = self.merged[best]
            symbol[r, k] = new
            rank[r, k] = np.where(k + 1 < n, self._rank(new, symbol[r, np.minimum(k + 1, width - 1)]), self.none)
            h = np.flatnonzero(k)
            rank[h, k[h] - 1] = self._rank(symbol[h, k[h] - 1], new[h])
        out: list[bytes] = [b""] * len(words)
        for at, ids, length in done:
            flat = ids[columns < length[:, None]].astype("<u4").tobytes()
            stops = (4 * np.cumsum(length)).tolist()
            for row, a, b in zip(at.tolist(), [0, *stops[:-1]], stops, strict=True):
                out[row] = flat[a:b]
        return out

    def _tokenized(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: list[str]) -> None:
        alone, plain, rest = [], [], []
        is_plain = PLAIN.fullmatch
        for run in runs:
            (rest if not is_plain(run) else alone if run.isalpha() and self.letters_are_words else plain).append(run)
        single = [r.lower() for r in alone]
        parts = [self.split(r.lower()) for r in plain]
        by_size: dict[int, list[str]] = {}
        other = []
        for word in set(single).union(*parts).difference(self.words):
            size = len(word.encode())
            if size > WORD_BYTES:
                other.append(word)
            else:
                by_size.setdefault((size + 3) // 4, []).append(word)
        for quarter, group in by_size.items():
            step = max(1, CELLS // (4 * quarter))
            for k in range(0, len(group), step):
                part = group[k : k + step]
                self.words.update(zip(part, self._merge([w.encode() for w in part]), strict=True))
        self.words.update(zip(other, self._tokenized(other), strict=True))
        known = self.words.__getitem__
        self.memo.update(zip(alone, map(known, single), strict=True))
        self.memo.update((run, b"".join(map(known, words))) for run, words in zip(plain, parts, strict=True))
        for word in other:
            del self.words[word]
        self.memo.update(zip(rest, self._tokenized(rest), strict=True))

    @staticmethod
    def _runs(text: str) -> list[str] | None:
        """Runs that have the ids of the text together; None if its white space is not Python's."""
        if not PLAIN_TEXT.fullmatch(text):
            return None if UNLIKE.search(text) else text.split()
        text = text.lower()
        if not SIGNS.search(text):  # a lone sign is a match of its own, so it may stand apart: fewer different runs
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ")
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = list(map(self._runs, texts))
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        if len(self.words) >= MEMO_ENTRIES:
            self.words.clear()
        new = list(set().union(*(s for s in split if s)).difference(self.memo))
        self._learn(new)
        packed = [self._tokenized([t])[0] if s is None else b"".join(map(self.memo.__getitem__, s)) for s, t in zip(split, texts, strict=True)]
        for run in new:
            if len(run) > MEMO_LENGTH:
                del self.memo[run]
        return packed


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
