"""Whole-column text work inside an Arrow task: words, lines, n-grams and their hashes as numpy arrays.

Every helper takes the UTF-8 bytes of many texts laid end to end, so that a batch costs a few array
passes and no Python step per word.  A hash of a byte range is taken in blocks of eight bytes from its start: each is
mixed with its place, which no sum of other blocks undoes, and the sum is mixed with the range's length, so it is the same number
wherever the range lies.  What a hash needs beside the bytes follows the blocks handled at once, not the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 300_000
_P = np.uint64(0x9E3779B97F4A7C1B)          # 3 mod 8, so that swapped letters always differ
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)


def table_of(byte_values) -> np.ndarray:
    """A 256-entry lookup: True at the given byte values."""
    out = np.zeros(256, bool)
    out[list(byte_values)] = True
    return out


SPACE = table_of([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Blocks that are hashed at once.
_BLOCKS = 1 << 20
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * _MIX
    h ^= h >> np.uint64(33)
    h *= _MIX2
    h ^= h >> np.uint64(33)
    return h


class Slice:
    """The bytes of texts ``first .. first + n - 1`` of a batch: ``buf`` and, per text, its bounds ``offs``."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, first: int):
        self.buf, self.offs, self.first, self.n = buf, offs, first, len(offs) - 1
        self._eights = None

    def spans(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each maximal run of word bytes; no run crosses from one text to the next."""
        inside = is_word[self.buf]
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offs] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each line (an empty text has one) and the number of lines before each text."""
        at = np.flatnonzero(self.buf == 0x0A)
        starts = np.sort(np.concatenate([self.offs[:-1], at + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.offs[1:], at]), kind="stable")
        before = np.searchsorted(at, self.offs) + np.arange(self.n + 1)
        return starts, ends, before

    def hashes(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        """64-bit hash of each byte range; another ``seed`` gives another hash."""
        if self._eights is None:
            padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
            self._eights = np.ndarray(len(self.buf) + 1, "<u8", padded, strides=(1,))       # eight bytes from every place
        size = end - start
        key = mix(np.array([2 * seed + 1], np.uint64))[0] | np.uint64(1)
        out = mix((self._eights[start] & _TAIL[np.minimum(size, 8)]) + (size.astype(np.uint64) * _P + key))
        more = np.flatnonzero(size > 8)
        if len(more):
            blocks = (size[more] - 1) >> 3                       # beyond the first
            before = np.cumsum(blocks)
            i = 0
            while i < len(more):
                done = int(before[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(before, done + _BLOCKS, "right")))
                own, n = more[i:j], blocks[i:j]
                if j > i + 1:
                    first = np.cumsum(n) - n
                    place = np.arange(int(n.sum())) - np.repeat(first, n) + 1
                    out[own] += np.add.reduceat(self._mixed(np.repeat(start[own], n), np.repeat(size[own], n), place, key), first)
                else:                                            # a range of any length, by parts
                    for k in range(1, int(n[0]) + 1, _BLOCKS):
                        place = np.arange(k, min(k + _BLOCKS, int(n[0]) + 1))
                        out[own] += self._mixed(start[own], size[own], place, key).sum(dtype=np.uint64)
                i = j
        return out

    def _mixed(self, start: np.ndarray, size: np.ndarray, place: np.ndarray, key: np.uint64) -> np.ndarray:
        """The blocks at some places of ranges, mixed with their place."""
        at = 8 * place
        return mix((self._eights[start + at] & _TAIL[np.minimum(size - at, 8)]) + (place.astype(np.uint64) + np.uint64(1)) * key)

    def counts(self, positions: np.ndarray) -> np.ndarray:
        """Number of the (ascending) positions in each text."""
        return np.diff(np.searchsorted(positions, self.offs))

    def bounds(self, starts: np.ndarray) -> np.ndarray:
        """For ascending ranges that lie inside texts: index of each text's first, and the total."""
        return np.searchsorted(starts, self.offs)


def slices(texts: pa.Array, lower: bool = False) -> Iterator[Slice]:
    """Slices of a string column in order; a null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offs = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE_BYTES, "right")) - 1)
        buf = data[offs[i]: offs[j]]
        yield Slice(LOWER[buf] if lower else buf, offs[i: j + 1] - offs[i], i)
        i = j


def windows(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k neighbouring words of one text, and the number of windows before each text."""
    count = np.maximum(np.diff(bounds) - k + 1, 0)
    before = np.r_[0, np.cumsum(count)]
    first = np.arange(before[-1]) + np.repeat(bounds[:-1] - before[:-1], count)
    out = np.zeros(len(first), np.uint64)
    for j in range(k):
        out = mix((out + np.uint64(j + 1)) * _P ^ h[first + j])
    return out, before


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i."""
    total = np.r_[0, np.cumsum(values)]
    return total[bounds[1:]] - total[bounds[:-1]]
