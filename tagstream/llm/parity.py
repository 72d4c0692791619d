"""Shingle sets of texts as arrays, their parity sketches and the keys of their pieces.

A set's words of ``shingle`` consecutive words are its tokens, hashed to 64 bits. A parity
sketch XORs every token into one bit, so that two sketches differ in no more bits than the sets
differ in tokens. A second, much wider sketch is never written out: its pieces are the tokens
of one range of hashes, and a piece is named by the XOR of its tokens' hashes. Two sets that
differ in at most ``d`` tokens differ in at most ``d`` pieces.

Sizes fall into bands of a factor of two; a band fixes how many pieces there are. A pair belongs
to the band of its smaller set, so a set takes part in its own band, and in the one below if
sets there can be similar to it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from tagstream.llm.words import BASES, U64, Words, mixed, powers, rolling, window_starts

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_HALF = U64(32)
_A, _B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
# More pieces than the differences a pair can have, by this share.
_SPARE_PERCENT = 40
_LEAST_BITS = 64


def most_different(a, b, percent: int):
    """How many tokens two sets of these sizes may differ in and still reach the similarity."""
    return (a + b) * (100 - percent) // (100 + percent)


def similar(sizes: tuple[int, int], shared: int, percent: int) -> bool:
    return 100 * shared >= percent * (sum(sizes) - shared)


@dataclass
class Sets:
    """Distinct tokens of every text, ascending; ``first[d]:first[d + 1]`` are those of text d."""

    tokens: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, shingle: int) -> Sets:
        """Lower-cased words; a text of fewer words than a shingle has one token, all its words."""
        words = Words(column)
        words.data = _LOWER[words.data]
        hashes, first, counts = words.hashes(BASES[0]), words.first, words.counts
        text = np.repeat(np.arange(len(counts)), counts)
        whole = window_starts(first, shingle)
        tokens, owner = [rolling(hashes, shingle)[whole]], [text[: len(whole)][whole]]
        scale = powers(BASES[1], shingle)
        for n in range(1, shingle):
            short = np.flatnonzero(counts == n)
            runs = hashes[first[short][:, None] + np.arange(n)]
            tokens.append(mixed((runs * scale[:n]).sum(axis=1, dtype=U64) + U64(n)))
            owner.append(short)
        token, owned = np.concatenate(tokens), np.concatenate(owner)
        order = np.lexsort((token, owned))
        token, owned = token[order], owned[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owned[1:] != owned[:-1])
        token, owned = token[fresh], owned[fresh]
        return cls(token, np.searchsorted(owned, np.arange(len(counts) + 1)))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def bands(self) -> np.ndarray:
        """The place of each size's highest bit; -1 for the empty set."""
        return np.array([int(n).bit_length() - 1 for n in self.sizes.tolist()], np.int64)

    def of_text(self, d: int) -> np.ndarray:
        return self.tokens[self.first[d] : self.first[d + 1]]

    def digests(self) -> list[bytes]:
        """Equal for equal sets."""
        return [
            hashlib.blake2b(self.of_text(d).tobytes(), digest_size=16).digest() for d in range(len(self.first) - 1)
        ]

    def sketches(self) -> list[bytes]:
        """Each set's parity bits, about eight for a token."""
        widths = np.where(self.bands < 0, 0, np.maximum(8 << np.maximum(self.bands, 0), _LEAST_BITS))
        begin = np.cumsum(widths) - widths
        place = (self.tokens & np.repeat(widths - 1, self.sizes).astype(U64)).astype(np.int64)
        place += np.repeat(begin, self.sizes)
        hit, times = np.unique(place, return_counts=True)
        odd = np.zeros(int(widths.sum()), bool)
        odd[hit[times % 2 == 1]] = True
        packed = np.packbits(odd, bitorder="little")
        return [packed[a // 8 : (a + w) // 8].tobytes() for a, w in zip(begin.tolist(), widths.tolist())]

    def keys(self, percent: int, every: bool = False) -> Keys:
        """Names of the pieces by which sets are to meet.

        Sets that may differ in ``d`` tokens share all but ``d`` of their pieces. In any fixed
        order of the pieces the first one they share is therefore among the first ``d + 1`` of
        either, and these suffice. The order puts pieces of more tokens first, empty ones last.
        ``every`` gives all pieces.
        """
        return Keys.united([self._keys(percent, below, every) for below in (0, 1)], len(self.first) - 1)

    def _keys(self, percent: int, below: int, every: bool) -> Keys:
        sizes, bands = self.sizes, self.bands - below
        takes_part = bands >= 0
        if below:
            # The smallest similar set must lie below this band.
            takes_part &= -(-sizes * percent // 100) < (1 << np.maximum(self.bands, 0))
        texts = np.flatnonzero(takes_part)
        sizes, bands = sizes[texts], bands[texts]
        partner = (2 << bands) - 1 if below else sizes * 100 // percent
        needed = most_different(sizes, partner, percent) + 1
        pieces = n_pieces(bands, percent)
        begin = np.cumsum(pieces) - pieces

        own = np.repeat(takes_part, self.sizes)
        tokens, at = self.tokens[own], np.repeat(np.arange(len(texts)), sizes)
        # Tokens ascend, so do the numbers of their pieces.
        slot = begin[at] + (((tokens >> _HALF) * pieces[at].astype(U64)) >> _HALF).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
        value = np.bitwise_xor.reduceat(mixed(tokens + _A), edge) if len(edge) else np.zeros(0, U64)
        held = np.diff(np.append(edge, len(slot)))
        slot = slot[edge]
        of = at[edge]

        # Empty pieces, of the sets whose other pieces do not suffice.
        lacking = np.flatnonzero((np.bincount(of, minlength=len(texts)) < needed) | every)
        if len(lacking):
            slots = np.concatenate([np.arange(begin[i], begin[i] + pieces[i]) for i in lacking.tolist()])
            empty = np.setdiff1d(slots, slot)
            of = np.concatenate([of, np.searchsorted(begin, empty, side="right") - 1])
            slot = np.concatenate([slot, empty])
            value = np.concatenate([value, np.zeros(len(empty), U64)])
            held = np.concatenate([held, np.zeros(len(empty), np.int64)])
        place = (slot - begin[of]).astype(U64)
        key = mixed(value ^ mixed(place * _A + bands[of].astype(U64) * _B + held.astype(U64)))
        order = np.lexsort((key, -held, of))
        of, key = of[order], key[order]
        if not every:
            rank = np.arange(len(of)) - np.searchsorted(of, of)
            first = rank < needed[of]
            of, key = of[first], key[first]
        return Keys(texts[of], key.view(np.int64), bands[of], needed[of])


def n_pieces(bands: np.ndarray, percent: int) -> np.ndarray:
    """Pieces of the sets that meet in a band: more than the largest pair there may differ in."""
    top = (2 << bands) - 1
    most = most_different(top, top * 100 // percent, percent)
    return most + 1 - (-most * _SPARE_PERCENT // 100)


@dataclass
class Keys:
    """A key per row: its text, the band in which it meets others, and how many keys suffice there."""

    text: np.ndarray
    key: np.ndarray
    band: np.ndarray
    needed: np.ndarray

    @classmethod
    def united(cls, parts: list[Keys], n_texts: int) -> Keys:
        text = np.concatenate([p.text for p in parts])
        order = np.argsort(text, kind="stable")
        rest = (np.concatenate([getattr(p, f) for p in parts])[order] for f in ("key", "band", "needed"))
        return cls(text[order], *rest)


def hamming(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the wider one folded to the other's width."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    x, y = folded(x, len(y)), folded(y, len(x))
    return int(np.bitwise_count(x ^ y).sum())


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """The sketch of that many bytes that the same tokens have."""
    while len(sketch) > width:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch
