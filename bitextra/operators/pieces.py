"""Texts of Arrow batches, some after the other: words, characters and n-grams as numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts, or of counted terms, that a task works on at a time.
PIECE = 1 << 20


def pieces(texts: pa.Array, size: int) -> Iterator[slice]:
    """Whole rows, about `size` bytes of these texts together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield slice(lo, hi)
        lo = hi


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of texts without NULL, and where each text begins (and the last one ends) among them."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(ends, wide, len(texts) + 1, texts.offset * np.dtype(wide).itemsize).astype(np.int64)
    size = int(ends[-1] - ends[0])
    return (np.frombuffer(data, np.uint8, size, ends[0]) if size else np.zeros(0, np.uint8)), ends - ends[0]


def split_words(joined: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row and word of every word, empty ones too, of texts whose words are parted by single spaces."""
    lists = pc.split_pattern(joined, " ")
    return np.repeat(np.arange(len(joined)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)), lists.flatten()


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64: `size` numbers."""
    of = np.full(size, base, np.uint64)
    of[0] = 1
    return np.cumprod(of)


class Spans:
    """The n-grams of texts without NULL: tokens between single spaces, so an n-gram is a span of its text.

    `of(n)` gives rows, first bytes and ends; `places` numbers below 2^bits by the hashes of spans, equal for equal spans.
    """

    BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9

    def __init__(self, texts: pa.Array) -> None:
        self.data, edges = raw(texts)
        gaps = np.flatnonzero(self.data == 32)
        self.starts = np.sort(np.concatenate([edges[:-1], gaps + 1]), kind="stable")
        self.ends = np.sort(np.concatenate([gaps, edges[1:]]), kind="stable")
        tokens = np.diff(np.searchsorted(gaps, edges)) + 1
        self.row = np.repeat(np.arange(len(texts)), tokens)
        with np.errstate(over="ignore"):
            # the hash of a span: its bytes times powers of an odd number, moved back to the front
            power, self.back = (_powers(b, max(2 * PIECE, 1 << len(self.data).bit_length())) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
            self.sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=self.sums[1:])

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        last = len(self.row) - (n - 1)
        if last <= 0:
            return (np.zeros(0, np.int64),) * 3
        whole = np.flatnonzero(self.row[:last] == self.row[n - 1 :])
        return self.row[whole], self.starts[whole], self.ends[whole + (n - 1)]

    def places(self, starts: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.sums[ends] - self.sums[starts]) * self.back[starts]
            h ^= h >> np.uint64(32)
            h *= np.uint64(self.MIX)
            h ^= h >> np.uint64(29)
            h *= np.uint64(self.BASE)
            return (h >> np.uint64(64 - bits)).astype(np.int64)

    def texts(self, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        size = ends - starts
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[at])])
