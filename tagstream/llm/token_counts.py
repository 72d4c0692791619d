"""Token counts by a whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, by encoding each. A
pre-token that is such a string counts one; only the rest goes through the merges. Results
per blank-separated piece of text are remembered in each worker, up to a bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tagstream.llm.runtime import documents

REMEMBERED = 400_000
LONG_PIECE = 64
# The library does not count these as blanks, Python does.
_ODD_BLANKS = re.compile("[\x1c-\x1f]")
_RESULT = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: itself if printable, else from 256 up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def prove_whole_tokens(path: str) -> dict[str, str]:
    """Vocabulary strings that encode alone as exactly their one token: text to byte-level spelling."""
    tokenizer = Tokenizer.from_file(path)
    byte_of = {letter: byte for byte, letter in byte_letters().items()}
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    texts, spelled, ids = [], [], []
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        word = entry[: len(entry) - len(suffix)]
        if not entry.endswith(suffix) or not word or not all(c in byte_of for c in word):
            continue
        try:
            texts.append(bytes(byte_of[c] for c in word).decode())
        except UnicodeDecodeError:
            continue
        spelled.append(word)
        ids.append(number)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return {
        text: word
        for text, word, number, result in zip(texts, spelled, ids, encoded)
        if result.ids == [number]
    }


class PieceCounts(dict):
    """Tokens per piece of text between blanks; starts from the proven whole tokens."""

    def __init__(self, path: str, whole: dict[str, str]):
        super().__init__({text: 1 for text in whole if len(text.split()) == 1 and text == text.strip()})
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.whole = set(whole.values())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> int:
        pre_tokens = self.tokenizer.pre_tokenizer.pre_tokenize_str(
            self.tokenizer.normalizer.normalize_str(piece) if self.tokenizer.normalizer else piece
        )
        n = sum(1 if p in self.whole else len(self.model.tokenize(p)) for p, _ in pre_tokens)
        if len(self) < REMEMBERED and len(piece) <= LONG_PIECE:
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if any(s in text for s in self.special) or _ODD_BLANKS.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, text.split()))


_counts: dict[str, PieceCounts] = {}


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` per row, as the library counts whole texts.

    Holds for vocabularies whose pre-tokens end at blanks and which drop the blanks. A null
    text counts as empty; a null identifier is carried through; repeated rows count each; an empty table
    gives no rows. A very long text is taken apart at its blanks, piece by piece.
    """
    rows = documents(docs, doc_id, text)
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts.get(tokenizer)
        if counts is None:
            counts = _counts[tokenizer] = PieceCounts(tokenizer, whole.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([counts.count(t) for t in texts], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(run, _RESULT)
