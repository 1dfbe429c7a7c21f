"""Words of many texts at once, as numpy arrays over the texts' UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from clonespark.llm.common import text_bytes

#: Bytes of text that are held as arrays together.
BLOCK_BYTES = 1 << 19
#: Odd multiplier of the rolling hash.
BASE = 0x9E3779B97F4A7C15
#: ASCII white space: \x20 and \x09-\x0D. Every byte of a longer UTF-8 character is a word byte.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters and digits of ASCII, and whatever isn't ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Block:
    """Texts first to last of a batch: data are their bytes, offsets where each begins and ends."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.first, self.data, self.offsets = first, data, offsets
        self.n = len(offsets) - 1

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask holds for."""
        if self.n == 1:  # a long text: no sums over each of its bytes
            return np.array([np.count_nonzero(mask)], np.int64)
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def split(self, is_word: np.ndarray = ~SPACE) -> None:
        """Find the words: runs of bytes in the table is_word that end with their text.

        Sets starts and ends of each word, text (whose it is) and counts (words of each text).
        """
        inside = is_word[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = self.offsets[1:-1]
        edges = edges[edges < len(self.data)]
        begins[edges] = inside[edges]
        self.starts = np.flatnonzero(begins)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | begins[1:]
        self.ends = np.flatnonzero(closes) + 1
        self.text = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=self.n).astype(np.int64)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes; equal words have equal hashes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        data, out = self.data if data is None else data, np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):  # words of BLOCK_BYTES together, or one that is longer
            end = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + BLOCK_BYTES, side="right")))
            out[at:end] = self._hashed(data, self.starts[at:end], self.ends[at:end])
            at = end
        return out

    @staticmethod
    def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # place within the word
        powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(sizes.max()) - 1, BASE, np.uint64))))
        values = (data[at + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)) * powers[at]
        return mix(np.add.reduceat(values, np.cumsum(sizes) - sizes))

    def same_words(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the words i and j, pair by pair, are equal byte by byte."""
        sizes = self.ends[i] - self.starts[i]
        out = sizes == self.ends[j] - self.starts[j]
        pairs, step = np.flatnonzero(out), BLOCK_BYTES // 4
        for at in range(0, len(pairs), step):
            k = pairs[at : at + step]
            n = sizes[k]
            first = np.cumsum(n) - n
            place = np.arange(n.sum()) - np.repeat(first, n)
            out[k] = ~np.logical_or.reduceat(self.data[place + np.repeat(self.starts[i[k]], n)] != self.data[place + np.repeat(self.starts[j[k]], n)], first)
        return out

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each k words in a row, and the index of the first of them; none spans two texts."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(BASE) + hashes[j : j + n]
        first = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        return mix(out[first]), first


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a fixed published finaliser)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def blocks(array: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow array in turn, so many that they reach the size."""
    data, offsets = text_bytes(array)
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        end = min(end, n)
        yield Block(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end
