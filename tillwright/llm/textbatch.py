"""Vectorised views of text columns inside Arrow batches: bytes, words, lines and their hashes.

Hashes are 64 bits wide. Two texts of one length that differ get equal hashes with a chance of
about 2**-60, so results that compare them are exact for all practical sizes; where sizes make
that doubtful, the operators say so.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that part words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, as many as the longest batch so far needs."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = n + n // 8
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up, cls.down


def release() -> None:
    """Give freed memory back to the system. Python workers live on, and their executor's limit counts it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which keeps its own account


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about ``limit`` bytes of ``column``; a longer text is a run of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    release()


@dataclass
class Texts:
    """UTF-8 bytes of all texts of a batch, one after the other; a null text is empty."""

    data: np.ndarray
    bounds: np.ndarray  # n + 1 offsets

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
        bounds = bounds.astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(raw[bounds[0]:bounds[-1]], bounds - bounds[0])

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()

    def lower(self) -> Texts:
        """A to Z in lower case, all else as it is."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(self.data + upper.astype(np.uint8) * np.uint8(32), self.bounds)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """Which text each byte position lies in."""
        return np.searchsorted(self.bounds, positions, "right") - 1

    def sums(self) -> np.ndarray:
        """Running sums from which the hash of any range follows."""
        up, _ = _Powers.of(len(self.data) + 1)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * up[:len(self.data)]
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        """Hash of each byte range; equal bytes have equal hashes wherever they stand."""
        sums = self.sums() if sums is None else sums
        _, down = _Powers.of(len(self.data) + 1)
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def word_ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of other bytes than SPACE, none of which spans two texts."""
        word = ~SPACE[self.data]
        before = np.concatenate([[False], word[:-1]])[:len(word)]
        after = np.concatenate([word[1:], [False]])[:len(word)]
        inner = self.bounds[1:-1]
        before[inner[inner < len(word)]] = False
        after[inner[inner > 0] - 1] = False
        return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


@dataclass
class Words:
    """Words of all texts of a batch, in order."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # word number at which each text begins, and the end
    hashes: np.ndarray

    @classmethod
    def of(cls, texts: Texts) -> Words:
        starts, ends = texts.word_ranges()
        bounds = np.searchsorted(starts, texts.bounds)
        return cls(texts, starts, ends, bounds, texts.hashes(starts, ends))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Word number of the start of each run of ``n`` words within a text, and the run's hash."""
        if len(self.starts) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.repeat(self.bounds[1:], self.counts)[:len(self.starts) - n + 1]
        at = np.flatnonzero(np.arange(len(last)) + n <= last)
        return at, combine([self.hashes[at + i] for i in range(n)])


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each tuple of hashes, order included."""
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        h = mix(h * np.uint64(_BASE) + part)
    return h


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of its least value, the first on a tie."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(len(values))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best[:n]
