"""Weighted acyclic automata of phrases, as arrays.

A ``PhraseCounts`` is a deterministic acyclic automaton unrolled by depth: the first transition
reads a language, each further one a word, and every state has a weight, the number of times
its phrase was seen. Transitions leave a state in the order of their words' codes. Automata are
built from the sorted phrases of a block of text, and united, which sums the weights of states
that read the same phrase. ``packed`` stores states of equal weight and equal ways on once.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

from tagstream.llm.words import U64, mixed

_A, _B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


class CodeCollision(ValueError):
    """Two words have one code; another seed parts them."""


@dataclass
class Level:
    """States of one depth: the label of the transition to each, the state it leaves, the weight."""

    label: np.ndarray
    above: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.label)


@dataclass
class Names:
    """What tells the words of depth 1 apart for certain: a second code each, and the word itself.

    A state that is only passed through has code zero and no word.
    """

    checks: np.ndarray
    words: pa.Array

    @classmethod
    def united(cls, parts: list[Names], weighs: np.ndarray, state: np.ndarray, n: int) -> Names:
        """Those of ``n`` united states, from the rows that weigh something; ``state`` is each row's."""
        rows = np.flatnonzero(weighs)
        one = np.full(n, -1, np.int64)
        one[state[rows]] = rows
        checks = np.concatenate([p.checks for p in parts])
        if (checks[one[state[rows]]] != checks[rows]).any():
            raise CodeCollision
        return cls(checks, pa.concat_arrays([p.words for p in parts])).taken(one)

    def taken(self, rows: np.ndarray) -> Names:
        """Those of some rows; -1 for none."""
        none = rows < 0
        checks = np.where(none, U64(0), self.checks[rows]) if len(rows) else np.zeros(0, U64)
        return Names(checks, self.words.take(pa.array(rows, pa.int64(), mask=none)).fill_null(b""))


@dataclass
class PhraseCounts:
    """``levels[0]`` are the languages, whose label is their place in ``languages``.

    The labels of words are places in ``alphabet``, the ascending codes of the words.
    """

    languages: list[str]
    alphabet: np.ndarray
    levels: list[Level]
    names: Names

    def __len__(self) -> int:
        return sum(map(len, self.levels))

    @classmethod
    def of_words(
        cls,
        languages: list[str],
        language: np.ndarray,
        alphabet: np.ndarray,
        names: Names,
        word: np.ndarray,
        joined: np.ndarray,
        longest: int,
        own: int,
    ) -> PhraseCounts:
        """All phrases of up to ``longest`` words that begin in the first ``own`` of a sequence of words.

        ``language`` and ``word`` are places in ``languages`` and ``alphabet``, whose words are
        ``names``; ``joined`` tells whether a word continues the phrase of the word before it.
        """
        kinds, state = np.unique(language[:own], return_inverse=True)
        levels = [Level(kinds, np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64))]
        start = np.arange(own)
        for length in range(longest):
            # The phrases that begin at ``start`` and have that many words already go on by one.
            if length:
                there = start + length < len(word)
                start, state = start[there], state[there]
                there = joined[start + length]
                start, state = start[there], state[there]
            level, state = _merged(state, word[start + length], None, len(alphabet))
            levels.append(level)
        return cls(languages, alphabet, levels, names.taken(levels[1].label))

    @classmethod
    def united(cls, parts: list[PhraseCounts]) -> PhraseCounts:
        """The automaton of all phrases of the parts, weights summed."""
        if len(parts) == 1:
            return parts[0]
        alphabet, place = np.unique(np.concatenate([p.alphabet for p in parts]), return_inverse=True)
        places = np.split(place, np.cumsum([len(p.alphabet) for p in parts])[:-1])
        languages = sorted({name for p in parts for name in p.languages})
        number = {name: i for i, name in enumerate(languages)}
        levels, above, names = [], [np.zeros(1, np.int64)] * len(parts), None
        for depth in range(len(parts[0].levels)):
            own = [p.levels[depth] for p in parts]
            if depth:
                labels, size = [place[level.label] for place, level in zip(places, own)], len(alphabet)
            else:
                of = [np.array([number[n] for n in p.languages], np.int64) for p in parts]
                labels, size = [n[level.label] for n, level in zip(of, own)], len(languages)
            weight = np.concatenate([level.weight for level in own])
            level, state = _merged(
                np.concatenate([a[level.above] for a, level in zip(above, own)]), np.concatenate(labels), weight, size
            )
            if depth == 1:
                names = Names.united([p.names for p in parts], weight > 0, state, len(level))
            levels.append(level)
            above = np.split(state, np.cumsum([len(level) for level in own])[:-1])
        return cls(languages, alphabet, levels, names)

    def path_codes(self) -> list[np.ndarray]:
        """A code of every state's whole phrase, by depth."""
        names = np.array([hash_text(n) for n in self.languages], U64)
        codes = [mixed(names[self.levels[0].label])]
        for level in self.levels[1:]:
            codes.append(mixed(codes[-1][level.above] * _A + self.alphabet[level.label] + _B))
        return codes

    def cut(self, prefix: int, ranges: int) -> dict[int, PhraseCounts]:
        """The automaton in parts, each of a range of the codes of the phrases' first words.

        A phrase goes where the code of its first ``prefix`` words falls, a shorter one where its
        own code falls; states that a part needs only on the way weigh nothing there.
        """
        codes = self.path_codes()
        owner = [_range_of(c, ranges) for c in codes]
        for depth in range(prefix + 1, len(self.levels)):
            owner[depth] = owner[depth - 1][self.levels[depth].above]
        out = {}
        # Each state with the part that owns it or that passes through it.
        members: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in reversed(range(len(self.levels))):
            state, part = np.arange(len(self.levels[depth])), owner[depth]
            if not depth:
                # A language weighs nothing; it is only passed through.
                state, part = state[:0], part[:0]
            if members:
                below, of = members[-1]
                # ``below`` was collected for the depth underneath.
                state = np.concatenate([state, self.levels[depth + 1].above[below]])
                part = np.concatenate([part, of])
                key = np.sort(part * np.int64(len(self.levels[depth])) + state)
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
                part, state = np.divmod(key, np.int64(len(self.levels[depth])))
            else:
                order = np.argsort(part, kind="stable")
                state, part = state[order], part[order]
            members.append((state, part))
        members.reverse()
        for part in np.unique(np.concatenate([p for _, p in members])).tolist():
            levels, new, names = [], None, None
            for depth, (state, parts) in enumerate(members):
                a, b = np.searchsorted(parts, [part, part + 1])
                own, level = state[a:b], self.levels[depth]
                above = np.zeros(len(own), np.int64) if new is None else np.searchsorted(new, level.above[own])
                weight = np.where(owner[depth][own] == part, level.weight[own], 0)
                levels.append(Level(level.label[own], above, weight))
                if depth == 1:
                    names = self.names.taken(np.where(weight > 0, own, -1))
                new = own
            used, place = np.unique(np.concatenate([level.label for level in levels[1:]]), return_inverse=True)
            at = 0
            for level in levels[1:]:
                level.label, at = place[at : at + len(level)], at + len(level)
            out[int(part)] = PhraseCounts(self.languages, self.alphabet[used], levels, names)
        return out

    def packed(self) -> bytes:
        """The automaton with equal states stored once, as bytes."""
        leaf = np.unique(self.levels[-1].weight, return_inverse=True)
        target, stored = leaf[1], [(leaf[0],)]
        for depth in reversed(range(len(self.levels))):
            level = self.levels[depth]
            # The states this depth's transitions leave, each one's ways on in order.
            n = len(self.levels[depth - 1]) if depth else 1
            counts = np.bincount(level.above, minlength=n)
            weight = self.levels[depth - 1].weight if depth else np.zeros(1, np.int64)
            first = np.cumsum(counts) - counts
            kept, number = _equal_states(weight, first, counts, level.label, target)
            ways = _ranges(first[kept], counts[kept])
            stored.append((weight[kept], counts[kept], level.label[ways], target[ways]))
            target = number
        named = np.flatnonzero(self.levels[1].weight)
        words = self.names.words.take(pa.array(named))
        state = {
            "languages": self.languages,
            "alphabet": self.alphabet,
            "checks": self.names.checks[named],
            "lengths": _small(pc.binary_length(words).to_numpy(zero_copy_only=False)),
            "words": b"".join(words.to_pylist()),
            "states": [tuple(map(_small, arrays)) for arrays in stored],
        }
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(state, protocol=5))

    @classmethod
    def unpacked(cls, data: bytes) -> PhraseCounts:
        state = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        ends = np.concatenate([[0], np.cumsum(state["lengths"], dtype=np.int64)]).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(state["words"])]
        )
        (leaf,), *stored = state["states"]
        levels, states = [], np.zeros(1, np.int64)
        for i, (_, counts, label, target) in enumerate(reversed(stored)):
            counts = counts.astype(np.int64)
            first = np.cumsum(counts) - counts
            ways = _ranges(first[states], counts[states])
            above = np.repeat(np.arange(len(states)), counts[states])
            states = target[ways].astype(np.int64)
            weight = leaf if i == len(stored) - 1 else stored[len(stored) - 2 - i][0]
            levels.append(Level(label[ways].astype(np.int64), above, weight[states].astype(np.int64)))
        rows = np.full(len(levels[1]), -1, np.int64)
        named = np.flatnonzero(levels[1].weight)
        rows[named] = np.arange(len(named))
        names = Names(np.append(state["checks"], U64(0)), words).taken(rows)
        return cls(state["languages"], state["alphabet"], levels, names)

    def phrases(self, depth: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and words (as a matrix of places in the alphabet) of states of a depth."""
        words = np.empty((len(which), depth), np.int64)
        for d in range(depth, 0, -1):
            words[:, d - 1] = self.levels[d].label[which]
            which = self.levels[d].above[which]
        return self.levels[0].label[which], words


def hash_text(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def _merged(above: np.ndarray, label: np.ndarray, weight: np.ndarray | None, size: int) -> tuple[Level, np.ndarray]:
    """One state per state above and label, in that order, weights (or rows) summed; and each row's state."""
    size = np.int64(max(size, 1))
    if len(above) and int(above.max()) > (1 << 62) // int(size):
        raise OverflowError("too many states in one automaton")
    key = above * size + label
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(fresh)
    if weight is None:
        total = np.diff(np.append(first, len(key)))
    else:
        total = np.add.reduceat(weight[order], first) if len(first) else np.zeros(0, np.int64)
    state = np.empty(len(key), np.int64)
    state[order] = np.cumsum(fresh) - 1
    merged_above, merged_label = np.divmod(key[first], size)
    return Level(merged_label, merged_above, total.astype(np.int64)), state


def _range_of(codes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges of 32 bits the codes' high halves fall into."""
    return ((codes >> U64(32)).astype(np.int64) * ranges) >> 32


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[0]``, ``first[0] + 1`` and so on, as many as counted, then those of ``first[1]``."""
    total = np.cumsum(counts)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(first - (total - counts), counts)


def _equal_states(
    weight: np.ndarray, first: np.ndarray, counts: np.ndarray, label: np.ndarray, target: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """One of the states of equal weight and equal ways on, and each state's number among those kept."""
    sums = []
    for base in (_A, _B):
        ways = np.concatenate([[U64(0)], np.cumsum(mixed(label.astype(U64) * base + mixed(target.astype(U64) + base)))])
        sums.append(mixed((ways[first + counts] - ways[first]) * base + weight.astype(U64)))
    order = np.lexsort(sums)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sums[0][order][1:] != sums[0][order][:-1]) | (sums[1][order][1:] != sums[1][order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    kept = order[fresh]
    # What two sums of 64 bits hold to be equal is compared.
    of = kept[number]
    same = (weight[of] == weight) & (counts[of] == counts)
    if same.all():
        own, other = _ranges(first, counts), _ranges(first[of], counts)
        if (label[own] == label[other]).all() and (target[own] == target[other]).all():
            return kept, number
    return np.arange(len(weight)), np.arange(len(weight))


def _small(numbers: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type that holds them."""
    numbers = np.asarray(numbers)
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))
