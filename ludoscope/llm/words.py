"""Words and word windows of whole texts as 64-bit hashes, an Arrow column at a time in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Its hash is a
polynomial over random byte values modulo 2**64, taken as a difference of prefix sums, then mixed. Windows of words
are hashed in the same way over the mixed word hashes. Nothing is cut: a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE_BYTES, _BASE_WORDS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each 64-bit value over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE_BYTES))
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, factor, dtype=np.uint64)
            row[0] = 1
            both.append(np.cumprod(row, dtype=np.uint64))
        held = (both[0], both[1])
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = held
    return held


def _spans(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[begin:end] for each span, independent of where the span lies."""
    power, inverse = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    raw = (sums[end] - sums[begin]) * inverse[begin]
    return mix(raw + (end - begin).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def blank(data: np.ndarray) -> np.ndarray:
    """Which bytes part words."""
    return _BLANK[data]


def byte_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of data[begin:end] for each span."""
    return _spans(_BYTES[data], begin, end, _BASE_BYTES)


class Words:
    """The words of some texts: ``first[i]:first[i+1]`` are those of text i, with byte bounds and hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False, between: np.ndarray = _BLANK) -> None:
        """``between``: for each byte, whether it parts words."""
        self.data, self.bounds = data, bounds
        solid = np.zeros(len(data) + 2, dtype=bool)
        solid[1:-1] = ~between[data]
        before, after = solid[:-2].copy(), solid[2:].copy()
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        before[edges] = False
        after[edges - 1] = False
        self.begin = np.flatnonzero(solid[1:-1] & ~before)
        self.end = np.flatnonzero(solid[1:-1] & ~after) + 1
        self.first = np.searchsorted(self.begin, bounds)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(bounds) - 1), self.count)
        self.hash = _spans((_BYTES_LOWER if lower else _BYTES)[data], self.begin, self.end, _BASE_BYTES)
        self.memo: dict = {}

    def take(self, rows: np.ndarray) -> Words:
        """The words of some of the texts."""
        if len(rows) == len(self.count):
            return self
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        parts = [self.data[a : a + n] for a, n in zip(self.bounds[rows], sizes)]
        data = np.concatenate(parts) if parts else self.data[:0]
        return Words(data, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64))

    def prefixes(self, size: int) -> np.ndarray:
        """The hash of each word's first ``size`` bytes, or of the whole of a shorter word."""
        return byte_spans(self.data, self.begin, np.minimum(self.begin + size, self.end))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word and the hash of every window of ``size`` words within one text."""
        starts = np.arange(max(0, len(self.hash) - size + 1))
        starts = starts[self.doc[starts] == self.doc[starts + size - 1]] if len(starts) else starts
        return starts, _spans(self.hash, starts, starts + size, _BASE_WORDS)

    def whole(self, rows: np.ndarray) -> np.ndarray:
        """The hash of each of these texts' word sequences."""
        return _spans(self.hash, self.first[rows], self.first[rows + 1], _BASE_WORDS)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the bounds of its rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_chunks(texts: pa.Array, lower: bool = False) -> Iterator[tuple[int, Words]]:
    """Runs of rows of about CHUNK_BYTES, each with the index of its first row."""
    if not len(texts):
        return
    data, bounds = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, Words(data[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row], lower)
        row = stop
