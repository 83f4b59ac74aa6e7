"""Vectorised text helpers shared by the operators: batches of whole texts as byte
buffers, word boundaries, and 64-bit content hashes of arbitrary byte ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# One multiplier for range hashes, one random value per byte value.
_BASE = U64(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(0, 2**64, 256, dtype=np.uint64)
_INV = U64(pow(int(_BASE), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}

# Whitespace of the word rule [^\x20\x09-\x0D]+ as a byte table.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# A-Z to a-z on single bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled by one round of numpy calls (a longer text is its own round).
BLOCK_BYTES = 1 << 20


def as_bytes(values) -> list[bytes]:
    """Texts as UTF-8 bytes; NULL is the empty text."""
    return [b"" if v is None else v.encode("utf-8") for v in values]


def blocks(items: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of ``items`` with about ``limit`` bytes each (at least one item)."""
    i = 0
    while i < len(items):
        j, n = i + 1, len(items[i])
        while j < len(items) and n + len(items[j]) <= limit:
            n += len(items[j])
            j += 1
        yield i, j
        i = j


def text_blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of ``batch`` with about ``limit`` bytes in its column ``text`` each (at least one
    row), and their texts: Python objects are made for one slice at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + limit, side="right")))
        part = batch.slice(i, j - i)
        yield part, as_bytes(part.column("text").to_pylist())
        i = j


def _powers(name: str, base, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, min(2 * BLOCK_BYTES, 1 << max(16, n.bit_length())))
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[name] = p
        return p
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (a bijection on 64 bits)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class RangeHash:
    """Hashes of byte ranges of one buffer: equal content gives equal hashes wherever
    it stands. A doubled range's hash follows from its halves (prefix sums)."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf] * _powers("base", _BASE, n + 1)[:n], out=self.prefix[1:])
        self.inverse = _powers("inverse", _INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every window of ``size`` bytes (empty if the buffer is shorter)."""
        n = len(self.prefix) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[size:] - self.prefix[:n]) * self.inverse[:n])


class Words:
    """Words of a block of texts: per word its text's index, start, end and hash."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            buf = LOWER[buf]
        self.buf = buf
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])  # one past the last too
        word = ~_SPACE[buf]
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            h = RangeHash(self.buf).of(self.start, self.end)
            self._hash = mix(h + (self.end - self.start).astype(np.uint64))
        return self._hash

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(text index, hash) of every run of ``size`` words inside one text."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = mix(h + self.hash[k : k + n] + U64(k + 1))
        same = self.text[:n] == self.text[size - 1 :]
        return self.text[:n][same], h[same]


def group_sums(index: np.ndarray, weights, n: int) -> np.ndarray:
    """Sum of ``weights`` per index 0..n-1."""
    return np.bincount(index, weights=weights, minlength=n)
