"""Texts of an Arrow batch as one byte block, with vectorised words and hashes.

All helpers work on the UTF-8 bytes of a whole batch at once, so a batch costs
a handful of numpy passes instead of a Python loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the two polynomial hashes (bytes of a word, words of a window).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Word bytes of the two tokenisations: "not ASCII space" and "digit, letter or non-ASCII".
NOT_SPACE = ~ASCII_SPACE
ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo:_hi + 1] = True
#: Letters alone: ASCII letters and all non-ASCII bytes.
LETTERS = ALNUM.copy()
LETTERS[0x30:0x3A] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that every bit of a hash depends on all others."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept, as every batch needs them)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, U64)
        have[0] = 1
        done = 1
        while done < size:
            step = U64(pow(base, done, 1 << 64))
            have[done:2 * done] = have[:done] * step
            done *= 2
        _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def slices(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for many slices, from one prefix sum."""
    n = len(values)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(values.astype(U64) * powers(base, n), out=prefix[1:])
    diff = prefix[ends] - prefix[starts]
    return mix64(diff * powers(inverse(base), n + 1)[starts] + (ends - starts).astype(U64))


class Block:
    """The texts of one batch: bytes, row offsets, and which rows are null."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string())
        self.null = np.asarray(texts.is_null())
        if texts.null_count:
            texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        offs = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[offs[0]:offs[-1]]
        self.offsets = offs - offs[0]
        self.rows = len(texts)

    def words(self, word_byte: np.ndarray):
        """(starts, ends, first) of the words of all rows; ``first[r]:first[r+1]`` are row r's."""
        inside = word_byte[self.bytes]
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:n]
        starts = np.flatnonzero(start)
        return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, self.offsets)

    def word_hashes(self, word_byte: np.ndarray):
        """(hashes, starts, ends, first) of the ASCII-lower-cased words."""
        starts, ends, first = self.words(word_byte)
        return slices(LOWER[self.bytes], starts, ends, BYTE_BASE), starts, ends, first


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, given the first word of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_hashes(hashes: np.ndarray, first: np.ndarray, width: int):
    """(hashes, positions) of the windows of ``width`` words inside one row each."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    pos = np.arange(n - width + 1)
    last = np.repeat(first[1:], np.diff(first))[: len(pos)]
    pos = pos[pos + width <= last]
    return slices(hashes, pos, pos + width, WORD_BASE), pos
