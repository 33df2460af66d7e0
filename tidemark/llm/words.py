"""Words of whole Arrow batches of texts, found and hashed by numpy on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The separators of words, and for loose comparison all ASCII punctuation too.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
WHITE_AND_PUNCTUATION = WHITE + bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())

_CHUNK_BYTES = 2 << 20
_SEGMENT_BYTES = 1 << 20
_POSITIONS = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer; x is changed in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def _tables(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    odd = np.uint64(1)
    return rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + odd, rng.integers(0, 1 << 63, _POSITIONS, np.uint64) * np.uint64(2) + odd


_TABLES = {seed: _tables(seed) for seed in (1, 2)}


def binary(column: pa.Array) -> pa.Array:
    """A text column as large_binary without nulls; a null text is an empty one."""
    return column.cast(pa.large_binary()).fill_null(b"")


def chunks(batch: pa.RecordBatch, column: str, limit: int = _CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows with about limit bytes of text; a longer text is a slice of its own."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(size)
    if first < len(sizes):
        yield batch.slice(first)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def hash_pieces(data: np.ndarray, lengths: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of byte strings that stand one after the other in data."""
    values, powers = _TABLES[seed]
    out = np.zeros(len(lengths), np.uint64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        begin = int(ends[first] - lengths[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + _SEGMENT_BYTES, "right")))
        n = lengths[first:last]
        starts = ends[first:last] - n - begin
        part = data[begin : int(ends[last - 1])]
        at = np.arange(len(part)) - np.repeat(starts, n)
        terms = values[part] * powers[at & (_POSITIONS - 1)]
        if len(part) and n.max() > _POSITIONS:
            terms += mix((at >> 16).astype(np.uint64)) * (at >= _POSITIONS)
        full = n > 0
        if full.any():
            out[first:last][full] = np.add.reduceat(terms, starts[full])
        first = last
    return mix(out + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a column of texts: where each starts and ends in data, and which text it belongs to."""

    def __init__(self, column: pa.Array, lower: bool = False, separators: bytes = WHITE):
        texts = binary(column)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and len(buffer) else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.raw = data
        self.data = lower_ascii(data) if lower else data
        self.n_texts = len(texts)
        table = np.ones(256, bool)
        table[list(separators)] = False
        inside = table[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(data))]
        before[cuts] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[cuts - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self._inside = inside
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(self.n_texts), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 1) -> np.ndarray:
        return hash_pieces(self.data[self._inside], self.ends - self.starts, seed)

    def array(self) -> pa.Array:
        """The words as a large_binary array."""
        lengths = self.ends - self.starts
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.data[self._inside]))])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all sequences of n consecutive values, also of those that run from one text into the next."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    q = 0xD6E8FEB86659FD93
    power, width, done, total = hashes, 1, 0, None
    left = n
    while left:
        if left & 1:
            part = power[done : done + len(hashes) - n + 1]
            total = part.copy() if total is None else total * np.uint64(pow(q, width, 1 << 64)) + part
            done += width
        left >>= 1
        if left:
            power = power[:-width] * np.uint64(pow(q, width, 1 << 64)) + power[width:]
            width *= 2
    return mix(total)


def within(text: np.ndarray, n: int) -> np.ndarray:
    """For each sequence of n consecutive words: does it lie in one text?"""
    return text[: len(text) - n + 1] == text[n - 1 :] if len(text) >= n else np.zeros(0, bool)
