"""Hashes of the words of many texts at once, in numpy.

A batch of texts is one buffer of bytes. Word and shingle hashes come from prefix sums of a polynomial hash, so their
cost does not depend on the number of words, and equal words get equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n, at least."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=np.uint64)
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    """The final steps of the splitmix64 generator."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes."""
    n = len(buffer)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n)[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def word_spans(buffer: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not blank."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = ~blank[buffer]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and the places where the texts start."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), np.concatenate([[0], np.cumsum(sizes)])[:-1]


def combined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive items; ``width - 1`` fewer than there are items."""
    n = len(hashes) - width + 1
    total = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(_BASE) + hashes[k : k + n]) if n > 0 else total
    return total


def chunks(sizes: list[int], limit: int) -> Iterator[slice]:
    """Consecutive slices of items whose sizes add up to about ``limit``, of one item at least."""
    start = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield slice(start, k + 1)
            start, total = k + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))
