"""Vectorised word hashing: one numpy pass over the bytes of many texts.

Words are runs of bytes other than space and 0x09-0x0D. A word's hash is a polynomial of its bytes, taken
from a prefix sum and moved to the word's start, so it does not depend on where the word stands.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Bytes hashed at once; longer runs are cut at white space.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _symbols() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = BLOCK + 1
    while size < n + 1:
        size *= 2
    return _powers(size)


class Prefix:
    """Hashes of any byte range of one block."""

    def __init__(self, data: np.ndarray):
        up, self.down = _grown(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_symbols()[data] * up[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def _cut(data: bytes) -> list[tuple[int, int]]:
    """Ranges of about a block, ending at white space (or at the end)."""
    out, start = [], 0
    while len(data) - start > BLOCK:
        end = max(data.rfind(s, start + BLOCK // 2, start + BLOCK) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if end < 0:
            later = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := data.find(s, start + BLOCK)) >= 0]
            if not later:
                break
            end = min(later)
        out.append((start, end))
        start = end
    out.append((start, len(data)))
    return out


def hash_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, number of words of each text)."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = b"\n".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.zeros(len(texts), np.int64)
    np.cumsum(lengths[:-1] + 1, out=firsts[1:])
    hashes, where = [], []
    for a, b in _cut(data):
        block = np.frombuffer(data, np.uint8, b - a, a) if b > a else np.zeros(0, np.uint8)
        starts, ends = spans(block)
        hashes.append(Prefix(block).ranges(starts, ends))
        where.append(starts + a)
    hashes, where = np.concatenate(hashes), np.concatenate(where)
    counts = np.diff(np.append(np.searchsorted(where, firsts), len(where)))
    return hashes, counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of k words, number of runs of each text).

    A text with fewer words than k, but any, has its whole sequence as its one run.
    """
    n = len(hashes)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    rolled = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        rolled += hashes[j : j + len(rolled)] * factors[j]
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    starts = np.cumsum(counts) - counts
    full = counts >= k
    at = np.repeat(starts[full], runs[full]) + ramp(runs[full])
    out = np.zeros(int(runs.sum()), np.uint64)
    is_full = np.repeat(full, runs)
    out[is_full] = rolled[at] + np.uint64(k)
    few = np.flatnonzero(~full & (counts > 0))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = counts[few] > j
            short[has] += hashes[starts[few[has]] + j] * factors[j]
        out[~is_full] = short + counts[few].astype(np.uint64)
    return mix(out), runs


def ramp(runs: np.ndarray) -> np.ndarray:
    """0, 1, .. for each run, one after the other."""
    total = int(runs.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs)


def sorted_sets(values: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values of each run in ascending order, how many each run has)."""
    owner = np.repeat(np.arange(len(runs)), runs)
    out = np.empty_like(values)
    start = 0
    for size in runs:
        out[start : start + size] = np.sort(values[start : start + size])
        start += size
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[first], np.bincount(owner[first], minlength=len(runs)).astype(np.int64)
