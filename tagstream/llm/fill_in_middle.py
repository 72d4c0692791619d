"""Fill-in-the-middle rearrangement of whole texts.

A text is a sequence of units: a word with the blanks before it, or the blanks that end the
text. To cut it after a number of units, fixed blocks of its bytes are counted once: how many
units end in each, and how many code points it holds. A Fenwick tree per text stores these
counts; a binary-lifting descent finds the block of a cut, and only that block is searched for
the boundary. Beside the text this takes a few bytes per block, however long the text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagstream.llm.runtime import documents
from tagstream.llm.words import _IS_BLANK, pieces, text_buffer

SEED = 42
BLOCK_BYTES = 512
REARRANGED_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Bytes looked at together while blocks are counted.
_SWEEP = 1 << 20
_RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class BlockCounts:
    """A Fenwick tree per text over its blocks: ends of units, and code points.

    ``data`` holds the texts' bytes one after the other, ``offsets`` where each begins.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK_BYTES):
        self.data, self.offsets, self.block = data, offsets, block
        lengths = np.diff(offsets)
        self.blocks = -(-lengths // block)
        self.first = np.cumsum(self.blocks) - self.blocks
        place = np.arange(int(self.blocks.sum())) - np.repeat(self.first, self.blocks)
        self.starts = np.repeat(offsets[:-1], self.blocks) + place * block
        # The last byte of every text that has one.
        self.last = offsets[1:][lengths > 0] - 1
        self.units, self.points = self._counted()
        self._grow(place + 1)

    def _unit_ends(self, a: int, b: int) -> np.ndarray:
        """Which of the bytes ``a`` to ``b`` end a unit: a word's last byte, and a text's."""
        blank = _IS_BLANK[self.data[a : b + 1]]
        ends = ~blank[: b - a]
        ends[: len(blank) - 1] &= blank[1:]
        ends[self.last[np.searchsorted(self.last, a) : np.searchsorted(self.last, b)] - a] = True
        return ends

    def _counted(self) -> tuple[np.ndarray, np.ndarray]:
        units, points = np.zeros(len(self.starts), np.int64), np.zeros(len(self.starts), np.int64)
        step = max(1, _SWEEP // self.block)
        for i in range(0, len(self.starts), step):
            some = self.starts[i : i + step]
            a = int(some[0])
            b = int(self.starts[i + step]) if i + step < len(self.starts) else len(self.data)
            units[i : i + step] = np.add.reduceat(self._unit_ends(a, b), some - a, dtype=np.int64)
            points[i : i + step] = np.add.reduceat(_leads(self.data[a:b]), some - a, dtype=np.int64)
        return units, points

    def _grow(self, place: np.ndarray) -> None:
        """From counts to trees: node ``i`` takes in the half before it, level by level."""
        step = 1
        while 2 * step <= self.blocks.max(initial=0):
            nodes = np.flatnonzero(place % (2 * step) == 0)
            for tree in (self.units, self.points):
                tree[nodes] += tree[nodes - step]
            step *= 2

    def totals(self) -> np.ndarray:
        """Units of every text."""
        total, at = np.zeros(len(self.blocks), np.int64), self.blocks.copy()
        while (some := np.flatnonzero(at)).size:
            total[some] += self.units[self.first[some] + at[some] - 1]
            at[some] &= at[some] - 1
        return total

    def cut(self, texts: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the first ``units`` units of each of the ``texts`` end: bytes and code points."""
        at, wanted, points = np.zeros(len(texts), np.int64), units.copy(), np.zeros(len(texts), np.int64)
        first, blocks = self.first[texts], self.blocks[texts]
        step = 1 << (int(blocks.max(initial=0)).bit_length())
        while step:
            there = np.flatnonzero((at + step <= blocks) & (wanted > 0))
            node = first[there] + at[there] + step - 1
            down = self.units[node] < wanted[there]
            there, node = there[down], node[down]
            wanted[there] -= self.units[node]
            points[there] += self.points[node]
            at[there] += step
            step //= 2
        bytes_ = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(wanted > 0).tolist():
            text = texts[i]
            a = int(self.offsets[text] + at[i] * self.block)
            b = min(a + self.block, int(self.offsets[text + 1]))
            end = a + int(np.flatnonzero(self._unit_ends(a, b))[wanted[i] - 1]) + 1
            bytes_[i] = end - self.offsets[text]
            points[i] += np.count_nonzero(_leads(self.data[a:end]))
        return bytes_, points


def _leads(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a code point."""
    return (data & 0xC0) != 0x80


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the seed and the identifier alone."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    rearranged_percent: int = REARRANGED_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n`` (units), ``form, prefix_chars, middle_chars`` and the ``output`` per row.

    ``markers`` stand before prefix, suffix and middle. The numbers that decide the form and
    the two cuts depend on the seed and the identifier alone, so rows that repeat an identifier
    share them; a null identifier counts as an empty one. A null text is empty. Empty texts, and
    texts that hold a marker already, stay plain, with null lengths; an empty prefix, middle or
    suffix is allowed. Repeated rows give a row each; an empty table gives none. Very long texts
    need their own size a few times over, for the batch, the output and one block at a time.
    """
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    if any(lead[0] in m[1:] for lead in markers for m in markers):
        # Else a marker could arise where a text and a marker meet.
        raise ValueError("a character that begins a marker must not stand elsewhere in one")
    if block_bytes < 1:
        raise ValueError("a block needs a byte")
    marks = [m.encode() for m in markers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", _SWEEP, len(batch)):
                yield _rearranged(piece, seed, rearranged_percent, suffix_first_percent, marks, block_bytes)

    return documents(docs, doc_id, text).mapInArrow(run, _RESULT)


def _rearranged(
    piece: pa.RecordBatch, seed: int, rearranged: int, suffix_first: int, marks: list[bytes], block: int
) -> pa.RecordBatch:
    data, offsets = text_buffer(piece.column("text"))
    counts = BlockCounts(data, offsets, block)
    n = counts.totals()
    drawn = np.array([draws(seed, i) for i in piece.column("doc_id").to_pylist()], np.int64).reshape(-1, 4)
    chosen = (n > 0) & (drawn[:, 2] % 100 < rearranged)
    texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    chosen[[i for i in np.flatnonzero(chosen).tolist() if any(m in texts[i] for m in marks)]] = False
    which = np.flatnonzero(chosen)
    cuts = np.sort(drawn[which, :2] % (n[which, None] + 1), axis=1)
    (first, before), (second, until) = (counts.cut(which, cuts[:, side]) for side in (0, 1))
    suffix_leads = drawn[which, 3] % 100 < suffix_first
    form = [PLAIN] * len(texts)
    prefix_mark, suffix_mark, middle_mark = marks
    for i, a, b, leads in zip(which.tolist(), first.tolist(), second.tolist(), suffix_leads.tolist()):
        prefix, middle, suffix = texts[i][:a], texts[i][a:b], texts[i][b:]
        if leads:
            form[i], parts = SPM, (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
        else:
            form[i], parts = PSM, (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
        texts[i] = b"".join(parts)
    prefix_chars, middle_chars = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    prefix_chars[which], middle_chars[which] = before, until - before
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc_id"),
            pa.array(n, pa.int64()),
            pa.array(form, pa.string()),
            pa.array(prefix_chars, pa.int64(), mask=~chosen),
            pa.array(middle_chars, pa.int64(), mask=~chosen),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def restored(
    output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)
) -> Column:
    """The text, rebuilt from what ``fill_in_middle`` made of it and the form alone."""
    prefix_mark, suffix_mark, middle_mark = markers
    head, middle = F.substring_index(output, middle_mark, 1), F.substring_index(output, middle_mark, -1)

    def parts(lead: str, inner: str) -> tuple[Column, Column]:
        whole = F.substring_index(head, inner, 1)
        return F.substr(whole, F.lit(len(lead) + 1)), F.substring_index(head, inner, -1)

    suffix_of_spm, prefix_of_spm = parts(suffix_mark, prefix_mark)
    prefix_of_psm, suffix_of_psm = parts(prefix_mark, suffix_mark)
    return (
        F.when(form == SPM, F.concat(prefix_of_spm, middle, suffix_of_spm))
        .when(form == PSM, F.concat(prefix_of_psm, middle, suffix_of_psm))
        .otherwise(output)
    )
