"""Word and shingle hashes of whole Arrow text columns, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Fixed values of the hashes. Stored keys depend on them.
BASE = 0x9E3779B97F4A7C15
STEP = 0xC2B2AE3D27D4EB4F
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

#: Bytes of the white space class ``[\x20\x09-\x0D]``.
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: All ASCII bytes but letters and digits: what stands between the words of a search index.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

CHUNK_BYTES = 1 << 19


class Rows(NamedTuple):
    """Hashes of all rows in one array; those of row i are ``hashes[bounds[i]:bounds[i + 1]]``."""

    hashes: np.ndarray
    bounds: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX_1)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX_2)
    return values ^ (values >> np.uint64(31))


class Hasher:
    """Polynomial hash of every word, from running sums over the bytes of a chunk of rows."""

    def __init__(self, separators: np.ndarray):
        self.separators = separators
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        self.inverse = pow(BASE, -1, 1 << 64)
        self.powers = self.back = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            size = max(size, CHUNK_BYTES * 2)
            for name, base in (("powers", BASE), ("back", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> Rows:
        """``offsets`` are the byte offsets of the rows in ``data``, starting with 0."""
        size = len(data)
        if not size:
            return Rows(np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
        self._grow(size + 1)
        between = self.separators[data]
        first = np.zeros(size + 1, bool)
        first[offsets] = True
        open_, close = ~between, ~between
        open_[1:] &= between[:-1] | first[1:size]
        close[:-1] &= between[1:] | first[1:size]
        starts, ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:size], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.back[starts])
        return Rows(hashes, np.searchsorted(starts, offsets))

    def chunks(self, texts: pa.Array) -> Iterator[tuple[int, int, Rows]]:
        """First and last row (exclusive) and the words of each chunk of rows; null texts have no words."""
        column = texts.fill_null("").cast(pa.large_string())
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
        low = 0
        while low < len(column):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, side="right")) - 1)
            yield low, high, self.words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            low = high


def shingles(words: Rows, size: int) -> Rows:
    """Hashes of ``size`` words in a row; a shorter, not empty row is one shingle of all its words."""
    hashes, bounds = words
    counts = np.diff(bounds)
    ends = np.repeat(bounds[1:], counts)
    valid = np.arange(len(hashes)) + size <= ends
    padded = np.concatenate([hashes, np.zeros(size - 1, np.uint64)])
    joined = padded[: len(hashes)].copy()
    for step in range(1, size):
        joined = joined * np.uint64(STEP) + padded[step : step + len(hashes)]
    for length in range(1, size):
        at = bounds[:-1][counts == length]
        short = hashes[at].copy()
        for step in range(1, length):
            short = short * np.uint64(STEP) + hashes[at + step]
        joined[at], valid[at] = short, True
    totals = np.concatenate([[0], np.cumsum(valid)])
    return Rows(mix(joined[valid]), totals[bounds])
