"""Hashes of words and word windows of whole Arrow batches with numpy, without an object for each word.

A word is read as blocks of eight bytes, each of which is mixed into the hash by a bijection of 64-bit integers, so no
algebra over the bytes makes words collide. A prefix sum of ``hash * base**place`` modulo 2**64 then gives the hash of
any short window of words by one subtraction and one product with the inverse power. Equal windows have equal hashes;
whoever acts on equal hashes must compare the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_U = np.uint64
#: The low 0 to 8 bytes of a block.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: Longer words are hashed one by one.
LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """base**i and its inverse for i from 0, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 18)
            for name, base in (("up", self.base), ("down", self.inverse)):
                x = np.full(n, base, dtype=np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))


_WORDS = _Powers(0xA0761D6478BD642F)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[start:end]``."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    found = mix((lengths.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) ^ (blocks[starts] & _LOW[np.minimum(lengths, 8)]))
    more = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD))
    at = 8
    while len(more):
        block = blocks[starts[more] + at] & _LOW[np.minimum(lengths[more] - at, 8)]
        found[more] = mix((found[more] + _U(0xD6E8FEB86659FD93)) ^ block)
        at += 8
        more = more[lengths[more] > at]
    for i in np.flatnonzero(lengths > LONG_WORD):
        found[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]], 1)
    return found


class Words:
    """Words of consecutive documents: ``row`` of each word, ``first`` and ``count`` of each row, and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        begin, end = offsets[:-1], offsets[1:]
        space = _SPACE[data]
        opens, closes = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
        if n:
            opens[0] = closes[-1] = True
            opens[1:], closes[:-1] = space[:-1], space[1:]
            opens[begin[begin < end]] = True
            closes[end[begin < end] - 1] = True
        self.starts = np.flatnonzero(opens & ~space)
        self.ends = np.flatnonzero(closes & ~space) + 1
        self.first = np.searchsorted(self.starts, begin)
        self.count = np.searchsorted(self.starts, end) - self.first
        self.row = np.repeat(np.arange(len(begin)), self.count)
        self.hash = word_hashes(data, self.starts, self.ends)
        _WORDS.grow(len(self.starts) + 1)
        self._sums = np.zeros(len(self.starts) + 1, dtype=np.uint64)
        np.cumsum(self.hash * _WORDS.up[: len(self.starts)], out=self._sums[1:])

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on, as far as the chunk goes (also across rows)."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mix((self._sums[size:] - self._sums[:n]) * _WORDS.down[:n])

    def inside(self, size: int) -> np.ndarray:
        """Which windows lie in one row."""
        n = len(self.row) - size + 1
        return self.row[:n] == self.row[size - 1 :] if n > 0 else np.empty(0, dtype=bool)


def raw_slices(texts: pa.Array) -> Iterator[memoryview]:
    """A view of the bytes of each text; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    data = memoryview(b"" if data is None else data)
    return (data[a:b] for a, b in zip(cuts, cuts[1:]))


def raw_texts(texts: pa.Array) -> list[bytes]:
    """The bytes of each text; null is empty."""
    return list(map(bytes, raw_slices(texts)))


def chunks(texts: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) for runs of rows of about ``size`` bytes; a longer row is a run of its own. Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        to = min(to, len(texts))
        yield at, to, Words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
