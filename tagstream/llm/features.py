"""Hashed n-gram counts of a batch of texts as one dense matrix, and their corpus frequencies."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagstream.llm.words import _IS_BLANK as _BLANKS
from tagstream.llm.words import BASES, U64, Words, pieces, text_buffer

Counts = Callable[[pa.Array], np.ndarray]

_MULTIPLIER = U64(0xFF51AFD7ED558CCD)
_BLANK = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Shape of a word that repeats another; no byte of UTF-8.
_REPEATED = 255
# A longer text is counted in blocks, each with so many words before it, so that no n-gram and no
# repeated word is lost between them; words longer than the second bound lose their beginning there.
BLOCK_BYTES = 1 << 20
_CONTEXT_WORDS = 16
_CONTEXT_BYTES = 1 << 16


def _gram_counts(codes: np.ndarray, first: np.ndarray, orders: range, size: int) -> np.ndarray:
    """Counts of the n-grams within each document; ``size`` is a power of two."""
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    shift = U64(64 - size.bit_length() + 1)
    rolled = codes.astype(U64) + U64(1)
    cells, gram = [], rolled
    for n in range(1, max(orders) + 1):
        if n > 1:
            gram = gram[:-1] * U64(0x1000193) + rolled[n - 1 :]
        if n in orders and len(gram):
            feature = ((gram * _MULTIPLIER * U64(2 * n + 1)) >> shift).astype(np.int64)
            whole = doc[: len(gram)] == doc[n - 1 :]
            cells.append((feature + doc[: len(gram)] * size)[whole])
    if not cells:
        return np.zeros((n_docs, size), np.float32)
    counted = np.bincount(np.concatenate(cells), minlength=n_docs * size)
    return counted.reshape(n_docs, size).astype(np.float32)


def _by_blocks(counts: Counts) -> Counts:
    """The same counts, with memory for a block of a very long text and not for all of it."""

    def run(column: pa.Array) -> np.ndarray:
        data, offsets = text_buffer(column)
        long = np.flatnonzero(np.diff(offsets) > BLOCK_BYTES)
        if not len(long):
            return counts(column)
        short = np.ones(len(column), bool)
        short[long] = False
        out = counts(pc.if_else(pa.array(short), column, None))
        for i in long.tolist():
            out[i] = _long_counts(counts, data[offsets[i] : offsets[i + 1]])
        return out

    return run


def _long_counts(counts: Counts, text: np.ndarray) -> np.ndarray:
    total, at, context = None, 0, b""
    while at < len(text):
        end = _end_of_block(text, at)
        block = context + text[at:end].tobytes()
        one = counts(pa.array([block.decode(errors="replace")]))[0].astype(np.float64)
        if context:
            # What lies within the words before was counted with them.
            one -= counts(pa.array([context.decode(errors="replace")]))[0]
        total = one if total is None else total + one
        head = block.rsplit(None, _CONTEXT_WORDS)
        context = block[len(head[0]) :] if len(head) > _CONTEXT_WORDS else block
        context = _from_a_letter(context[-_CONTEXT_BYTES:])
        at = end
    return total.astype(np.float32)


def _end_of_block(text: np.ndarray, at: int) -> int:
    """Before the block's last blank, or within a word that fills it."""
    end = at + BLOCK_BYTES
    if end >= len(text):
        return len(text)
    blanks = np.flatnonzero(_BLANKS[text[at + 1 : end]])
    if len(blanks):
        return at + 1 + int(blanks[-1])
    while end > at + 1 and text[end] & 0xC0 == 0x80:
        end -= 1
    return end


def _from_a_letter(data: bytes) -> bytes:
    """Without the end of a character whose beginning is missing."""
    begin = 0
    while begin < min(4, len(data)) and data[begin] & 0xC0 == 0x80:
        begin += 1
    return data[begin:]


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def character_counts(size: int, orders: range = range(1, 4)) -> Counts:
    """Counts of lower-cased character n-grams; whatever is no letter is one blank."""

    def run(column: pa.Array) -> np.ndarray:
        texts = [f" {(t or '').lower()} " for t in column.to_pylist()]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").copy()
        codes[~_letters()[codes]] = _BLANK
        first = np.cumsum([0] + [len(t) for t in texts])
        return _gram_counts(*_collapsed(codes, first, codes == _BLANK), orders, size)

    return _by_blocks(run)


def _collapsed(codes: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one code shortened to one where ``which`` holds."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != codes[:-1]) | ~which[1:]
    keep[first[:-1][first[:-1] < len(codes)]] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def _shapes() -> np.ndarray:
    """Each byte's shape: small letter (and any byte beyond ASCII), capital, digit, blank, or itself."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = table[128:] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[[9, 11, 12, 13]] = _BLANK
    return table


_SHAPES = _shapes()


def shape_counts(size: int, orders: range = range(1, 5)) -> Counts:
    """Counts of n-grams of character shapes; a word like one of the two before it is a shape of its own."""

    def run(column: pa.Array) -> np.ndarray:
        words = Words(column)
        codes, first = _SHAPES[words.data], words.offsets
        hashes, doc = words.hashes(BASES[0]), np.repeat(np.arange(len(first) - 1), words.counts)
        again = np.zeros(len(hashes), bool)
        for back in (1, 2):
            again[back:] |= (hashes[back:] == hashes[:-back]) & (doc[back:] == doc[:-back])
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[words.starts[again]] = 1
        inside[words.ends[again]] -= 1
        codes[np.cumsum(inside[:-1], dtype=np.int8) > 0] = _REPEATED
        return _gram_counts(*_collapsed(codes, first, np.ones(len(codes), bool)), orders, size)

    return _by_blocks(run)


def word_counts(size: int) -> Counts:
    """Counts of lower-cased (A-Z) words by a hash; ``size`` is a power of two."""
    shift = U64(64 - size.bit_length() + 1)

    def run(column: pa.Array) -> np.ndarray:
        words = Words(column)
        words.data = _LOWER[words.data]
        doc = np.repeat(np.arange(len(column)), words.counts)
        cells = (words.hashes(BASES[0]) >> shift).astype(np.int64) + doc * size
        counted = np.bincount(cells, minlength=len(column) * size)
        return counted.reshape(len(column), size).astype(np.float32)

    return _by_blocks(run)


def document_frequencies(rows: DataFrame, counts: Counts, size: int) -> tuple[np.ndarray, int]:
    """In how many of all texts each feature occurs, and the number of texts.

    Each task sums its own documents; ``size`` sums at most come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total[:size] += (counts(piece.column("text")) > 0).sum(axis=0)
                total[size] += len(piece)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["feature", "n"]
        )

    sums = rows.select("text").mapInArrow(run, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    total = np.zeros(size + 1, np.int64)
    for feature, n in sums.collect():
        total[feature] = n
    return total[:size], int(total[size])


def inverse_frequencies(frequencies: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic counts by inverse frequency, each row of length one (or zero)."""
    out = np.log1p(counts) * idf
    length = np.sqrt(np.einsum("ij,ij->i", out, out))
    out /= np.where(length > 0, length, 1)[:, None]
    return out
