"""Words and word windows of Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than space, tab, LF, VT, FF and CR; UTF-8 keeps
those bytes out of longer characters.  Hashes are polynomials modulo 2**64 made
from prefix sums, so all words of a block of rows cost a few passes over its
bytes; they depend on the word alone, not on where it stands.  Two different
words or windows share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SLICE = 1 << 18

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_BYTE_VALUE = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.length = base, pow(base, -1, 2**64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.length:
            self.length = max(n, SLICE)
            self.up, self.down = (self._powers(b) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    def _powers(self, base: int) -> np.ndarray:
        factors = np.full(self.length, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Block(NamedTuple):
    """Consecutive rows: their bytes, and for each row and one more where it begins."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of a text column, in blocks of about ``most`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1)
        yield Block(row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


class Words(NamedTuple):
    """All words of a block, and for each row and one more where its words begin."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def split(block: Block, blank: np.ndarray = BLANK) -> Words:
    """The words that bytes marked in ``blank`` leave."""
    inside = ~blank[block.data]
    if not len(inside):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(block.rows + 1, np.int64))
    follows = inside.copy()  # goes on with the word of the byte before
    follows[0] = False
    follows[1:] &= inside[:-1]
    begin = block.bounds[:-1]
    follows[begin[begin < len(inside)]] = False
    starts = np.flatnonzero(inside & ~follows)
    last = inside
    last[:-1] &= ~follows[1:]
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, block.bounds))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    out, row, n = np.empty(len(words.starts), np.uint64), 0, len(words.starts)
    while row < n:
        base = words.starts[row]
        end = max(row + 1, int(np.searchsorted(words.ends, base + SLICE, "right")))
        up, down = _BYTES.upto(int(words.ends[end - 1] - base) + 1)
        sums = np.zeros(words.ends[end - 1] - base + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[base : words.ends[end - 1]]] * up[:-1], out=sums[1:])
        s, e = words.starts[row:end] - base, words.ends[row:end] - base
        out[row:end] = mix((sums[e] - sums[s]) * down[s])
        row = end
    return out


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each ``length`` consecutive words, by its first word."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for a in range(0, n, SLICE):
        part = words[a : min(n, a + SLICE) + length - 1]
        up, down = _WORDS.upto(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up, out=sums[1:])
        k = len(part) - length + 1
        out[a : a + k] = mix((sums[length:] - sums[:-length]) * down[:k] + np.uint64(length))
    return out
