"""Words of a column of texts as numpy arrays, hashed without a Python loop over words."""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True

# Odd multipliers, so that powers can be inverted modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
# Longer words are hashed one by one with a keyed digest: polynomials modulo 2**64 collide for
# some pairs of words of 1024 letters and more, whatever the base.
LONG_WORD = 1 << 6


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word (the finaliser of a public 64-bit mixer)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Word boundaries of a batch of texts; ``first[d]:first[d + 1]`` are document d's words."""

    def __init__(self, column: pa.Array, blank: np.ndarray = _IS_BLANK):
        self.data, self.offsets = text_buffer(column)
        n = len(self.data)
        inside = ~blank[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = True, ~inside[:-1]
            after[-1], after[:-1] = True, ~inside[1:]
        self.starts = np.flatnonzero(inside & (before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.cut = np.zeros(0, np.int64)
        self.inside = inside

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def _letters(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' bytes (plus one), and each one's place in its word."""
        lengths = self.ends - self.starts
        at = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(at.astype(np.int32), lengths)
        place &= LONG_WORD - 1
        if len(self.cut):
            # Words that were shortened after the blanks were found.
            keep = self.inside.copy()
            keep[self.cut] = False
            return self.data[keep].astype(U64) + U64(1), place
        return self.data[self.inside].astype(U64) + U64(1), place

    def shorten(self, which: np.ndarray) -> None:
        """Take the last byte off some words (of two bytes or more), before they are hashed."""
        self.ends = self.ends.copy()
        self.ends[which] -= 1
        self.cut = self.ends[which]

    def hashes(self, base: int = BASES[0]) -> np.ndarray:
        """A 64-bit hash per word, equal for equal words of any document; independent for another base."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, U64)
        at = np.cumsum(lengths) - lengths
        letters, place = self._letters
        table = powers(base, min(int(lengths.max()), LONG_WORD))
        out = np.add.reduceat(letters * table[place], at)
        for i in np.flatnonzero(lengths > LONG_WORD):
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            digest = hashlib.blake2b(word, digest_size=8, key=base.to_bytes(8, "little")).digest()
            out[i] = int.from_bytes(digest, "little")
        return mixed(out + lengths.astype(U64) * U64(base))


def rolling(hashes: np.ndarray, width: int, base: int = BASES[1]) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, document borders ignored."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * powers(base, len(hashes)), out=total[1:])
    inverse = pow(base, -1, 1 << 64)
    return mixed((total[width:] - total[:-width]) * powers(inverse, n))


def window_starts(first: np.ndarray, width: int, least: int = 0) -> np.ndarray:
    """Which runs of ``width`` words lie in one document (of at least ``least`` words)."""
    n = int(first[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    counts = np.diff(first)
    end = np.repeat(np.where(counts >= max(least, width), first[1:] - width + 1, 0), counts)
    return np.arange(n) < end[:n]


def pieces(batch: pa.RecordBatch, text: str, max_bytes: int = 1 << 18, max_rows: int = 128):
    """The batch in slices of bounded text, one longer text alone; arrays of numbers are far larger."""
    column = batch.column(text)
    _, offsets = text_buffer(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + max_bytes, side="right")) - 1
        end = max(begin + 1, min(end, begin + max_rows, len(column)))
        yield batch.slice(begin, end - begin)
        begin = end
